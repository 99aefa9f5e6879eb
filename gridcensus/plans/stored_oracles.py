"""The questions of ``stored_queries`` in plain SQL."""

from __future__ import annotations

from gridcensus.plans.oracles import BRIDGE, FINAL, LATTICE, MASK, POP

ORACLES: dict[str, str] = {}


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = f"WITH {ctes}\n" + select


add("stored_population", POP, """SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS half,
  label, count(*) AS row_count, CAST(sum(s) AS BIGINT) AS residents, label = '2024-12-31' AS kept
  FROM pop, (VALUES ('2024-12-31'), ('2025-12-31')) AS l(label)
  WHERE label = '2024-12-31' OR CAST(plr_id AS BIGINT) % 3 = 0 GROUP BY ALL""")

add("stored_zones", """z AS (SELECT c_custkey % 19 IN (1, 2, 3, 4, 5, 6, 7, 8, 9) AS bad,
  c_custkey % 400 = 10 AS moved, CASE c_custkey % 3 WHEN 0 THEN 16000000.0 WHEN 1 THEN 14500000.0
    ELSE 12000000.0 END AS area FROM customer)""", """SELECT count(*) FILTER (moved OR NOT bad) AS zone_count,
  round(CAST(sum(CASE WHEN moved THEN 10000.0 ELSE area END) FILTER (moved OR NOT bad) AS DOUBLE), 1) AS area_m2,
  count(*) FILTER (bad) AS rejected_count, CAST(0 AS BIGINT) AS kept_of_updated,
  CAST(0 AS BIGINT) AS lost_of_others FROM z""")

add("stored_cells", LATTICE, """SELECT count(*) FILTER (d NOT IN (1, 2, 3, 4)) AS cell_count,
  CAST(sum(round(abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2))
    FILTER (d NOT IN (1, 2, 3, 4)) AS BIGINT) AS area_m2,
  count(*) FILTER (d IN (1, 2, 3, 4) AND cell % 400 IN (2, 24)) AS rejected_count,
  CAST(0 AS BIGINT) AS lost_of_others FROM planar""")

add("stored_bridge", BRIDGE, """SELECT label, count(*) AS row_count, count(DISTINCT plr_id) AS zone_count,
  round(sum(a), 1) AS area_m2, label = '2023-01-01' AS kept
  FROM bridge, (VALUES ('2023-01-01'), ('2024-01-01')) AS l(label)
  WHERE label = '2023-01-01' OR CAST(plr_id AS BIGINT) % 2 = 0 GROUP BY label""")

add("stored_mask", MASK + """,
narrow AS (SELECT cell FROM reach WHERE d2 <= 4000000.0 UNION SELECT cell FROM hit
  UNION SELECT cell FROM holds)""", """SELECT '5000' AS label, count(*) AS row_count,
  CAST(sum(cell) AS BIGINT) AS index_sum, true AS kept FROM masked
UNION ALL SELECT '2000', count(*), CAST(sum(cell) AS BIGINT), false FROM narrow""")

add("stored_exposure", FINAL, """SELECT strftime(run, '%Y%m%dT%H%M') AS label, count(*) AS row_count,
  count(t) AS temperature_count, round(sum(t + CASE WHEN run = (SELECT max(run) FROM runs) THEN 1 ELSE 0 END), 4)
    AS temperature_sum, count(total) AS population_count, run <> (SELECT max(run) FROM runs) AS kept
  FROM final GROUP BY run""")
