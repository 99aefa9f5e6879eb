"""The same questions in plain SQL, written from the definitions of the data model.

Shared CTEs rebuild the lenses; geometry is answered by closed forms for rectangles and
right triangles, distances by edge pairs, so the SQL does not repeat the library's method.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

EV = """ev AS (
  SELECT event_id, ts, user_id, value, event_type,
         CASE event_type WHEN 'click' THEN 'T_2M' WHEN 'error' THEN 'RELHUM_2M'
              WHEN 'purchase' THEN 'TD_2M' WHEN 'signup' THEN 'U_10M' ELSE 'V_10M' END AS indicator,
         CASE event_id % 6 WHEN 0 THEN 'PT000H00M' WHEN 1 THEN 'PT001H00M' WHEN 2 THEN 'PT002H00M'
              WHEN 3 THEN 'PT006H00M' WHEN 4 THEN 'PT012H00M' ELSE 'PT024H00M' END AS lead_time,
         CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 6
              WHEN 4 THEN 12 ELSE 24 END AS lead_hours
  FROM events),
names(indicator) AS (VALUES ('T_2M'), ('RELHUM_2M'), ('TD_2M'), ('U_10M'), ('V_10M')),
leads(lead_order, lead_time) AS (VALUES (0, 'PT000H00M'), (1, 'PT001H00M'), (2, 'PT002H00M'),
  (3, 'PT006H00M'), (4, 'PT012H00M'), (5, 'PT024H00M'))"""

FIELD = EV + """,
seen AS (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS run, user_id AS cell, indicator,
                max(value) AS v FROM ev GROUP BY ALL),
runs AS (SELECT DISTINCT CAST(date_trunc('week', ts) AS TIMESTAMP) AS run FROM ev),
mesh AS (SELECT unnest(range(0, (SELECT max(user_id) + 1 FROM events))) AS cell),
field AS (SELECT run, cell, indicator, v FROM (SELECT * FROM runs, mesh, names) AS g
          LEFT JOIN seen USING (run, cell, indicator)),
wide AS (SELECT run, cell, max(v) FILTER (indicator = 'T_2M') - 273.15 AS t,
                max(v) FILTER (indicator = 'RELHUM_2M') AS rh,
                max(v) FILTER (indicator = 'TD_2M') - 273.15 AS td,
                max(v) FILTER (indicator = 'U_10M') AS u, max(v) FILTER (indicator = 'V_10M') AS w
         FROM field GROUP BY ALL),
speedy AS (SELECT *, sqrt(u * u + w * w) AS ws FROM wide)"""

SPARSE = EV + """,
sparse AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run, lead_time,
       CAST(date_trunc('day', ts) AS TIMESTAMP) + to_hours(lead_hours) AS valid, indicator,
       user_id AS cell, max(value) AS v,
       min(CASE WHEN event_id % 1000 = 7 THEN 'other' ELSE 'unit' END) AS unit
     FROM ev GROUP BY ALL)"""

MASKED = FIELD + """,
mask AS (SELECT DISTINCT user_id AS cell FROM events
         WHERE event_type = 'purchase' AND value >= 50)"""

LINKS = """links AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS plr_id,
         (c_custkey * 7 + k * 13) % (SELECT max(user_id) + 1 FROM events) AS cell,
         1 + (c_custkey * 7 + k * 3) % 5 AS w
  FROM customer, (VALUES (0), (1), (2), (3)) AS ks(k)),
weights AS (SELECT plr_id, cell, w, w / sum(w) OVER (PARTITION BY plr_id) AS f FROM links)"""

POP = """raw AS (
  SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS plr_id, c_custkey % 17 AS d,
         CAST(floor(abs(c_acctbal)) AS BIGINT) + 1 AS base FROM customer),
texts AS (SELECT c_custkey, plr_id,
    CASE d WHEN 1 THEN NULL WHEN 2 THEN '   ' WHEN 3 THEN 'n/a' WHEN 4 THEN '0' WHEN 5 THEN '-5'
           ELSE CAST(base AS VARCHAR) END AS tt,
    CASE d WHEN 7 THEN NULL WHEN 8 THEN 'x1' WHEN 9 THEN '-1'
           ELSE CAST(base * 15 // 100 AS VARCHAR) END AS mt,
    CASE d WHEN 10 THEN '' WHEN 11 THEN '1.5' WHEN 12 THEN CAST(base + 1 AS VARCHAR)
           ELSE CAST(base * 5 // 100 AS VARCHAR) END AS ot FROM raw),
nums AS (SELECT *, trim(coalesce(tt, '')) = '' AS t_blank, trim(coalesce(mt, '')) = '' AS m_blank,
    trim(coalesce(ot, '')) = '' AS o_blank,
    CASE WHEN regexp_full_match(trim(tt), '-?[0-9]+') THEN TRY_CAST(trim(tt) AS BIGINT) END AS t,
    CASE WHEN regexp_full_match(trim(mt), '-?[0-9]+') THEN TRY_CAST(trim(mt) AS BIGINT) END AS m,
    CASE WHEN regexp_full_match(trim(ot), '-?[0-9]+') THEN TRY_CAST(trim(ot) AS BIGINT) END AS o
  FROM texts),
pop AS (SELECT plr_id, t, m, o, m + o AS s, CASE
    WHEN t_blank THEN 'missing_population_total'
    WHEN t IS NULL THEN 'invalid_population_total'
    WHEN m_blank OR o_blank THEN 'missing_population_65plus_component'
    WHEN m IS NULL OR o IS NULL THEN 'invalid_population_65plus_component'
    WHEN t < 0 THEN 'negative_population_total'
    WHEN t = 0 THEN 'zero_population_total'
    WHEN m < 0 OR o < 0 OR m + o < 0 OR m > t OR o > t OR m + o > t
      THEN 'invalid_population_65plus' END AS reason FROM nums),
loose AS (SELECT plr_id, TRY_CAST(nullif(trim(tt), '') AS DOUBLE) AS t,
    TRY_CAST(nullif(trim(mt), '') AS DOUBLE) AS m, TRY_CAST(nullif(trim(ot), '') AS DOUBLE) AS o
  FROM texts),
lenient AS (SELECT *, m + o AS s, (m + o) / nullif(t, 0) AS share, CASE
    WHEN t IS NULL THEN 'missing_population_total'
    WHEN m IS NULL OR o IS NULL THEN 'missing_population_65plus_component'
    WHEN t < 0 THEN 'negative_population_total'
    WHEN m + o < 0 OR m + o > t THEN 'invalid_population_65plus' END AS reason FROM loose)"""


def _mean(column: str) -> str:
    return (f"CASE WHEN count(*) FILTER ({column} IS NULL) = 0 "
            f"THEN sum({column} * f) / sum(f) END")


ZONED = FIELD + ",\n" + LINKS + f""",
zoned AS (SELECT plr_id, run, {_mean('t')} AS t, {_mean('rh')} AS rh, {_mean('td')} AS td,
    {_mean('u')} AS u, {_mean('w')} AS v, {_mean('ws')} AS ws
  FROM (SELECT l.plr_id, l.f, s.* FROM weights l JOIN speedy s USING (cell)) AS j
  GROUP BY plr_id, run)"""

FINAL = ZONED + ",\n" + POP + """,
final AS (SELECT z.*, p.reason, CASE WHEN p.reason IS NULL THEN p.t END AS total,
    CASE WHEN p.reason IS NULL THEN p.s END AS senior,
    CASE WHEN p.reason IS NULL THEN p.s / p.t END AS share,
    CASE WHEN p.reason IS NULL THEN 'available' ELSE 'rejected_source_record' END AS status
  FROM zoned z JOIN pop p USING (plr_id))"""

_VALUES = """round(t, 6) AS temperature_c, round(rh, 6) AS relative_humidity_percent,
  round(td, 6) AS dew_point_temperature_c, round(u, 6) AS wind_u_10m_ms,
  round(v, 6) AS wind_v_10m_ms, round(ws, 6) AS wind_speed_10m_ms"""
_IDENTITY = "run AS run_time_utc, 'PT000H00M' AS lead_time, run AS valid_time_utc"
_POPULATION = """total AS population_total, senior AS population_65plus,
  round(share, 6) AS share_65plus, status AS population_status,
  reason AS population_rejection_reason"""

# Zone rectangles: a full square minus a hole or corner (bx0..by1), and mesh triangles:
# lower (half 0) and upper (half 1) of squares of 7 km.
SHAPES = """zone AS (
  SELECT c_custkey AS id, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS plr_id, c_custkey % 3 AS kind,
         370000.0::DOUBLE + c_custkey % 8 * 4000 AS x, 5800000.0::DOUBLE + c_custkey // 8 * 4000 AS y
  FROM customer),
cut AS (SELECT *, x + CASE kind WHEN 1 THEN 1000 ELSE 2000 END AS bx0,
    y + CASE kind WHEN 1 THEN 1000 ELSE 2000 END AS by0,
    x + CASE kind WHEN 1 THEN 2000 WHEN 2 THEN 4000 ELSE 2000 END AS bx1,
    y + CASE kind WHEN 1 THEN 2500 WHEN 2 THEN 4000 ELSE 2000 END AS by1,
    CASE kind WHEN 1 THEN 14500000.0 WHEN 2 THEN 12000000.0 ELSE 16000000.0 END::DOUBLE AS area,
    CASE kind WHEN 0 THEN x + 2000 WHEN 1 THEN x + (16e6 * 2000 - 1.5e6 * 1500) / 14.5e6
      ELSE x + (16e6 * 2000 - 4e6 * 3000) / 12e6 END AS cx,
    CASE kind WHEN 0 THEN y + 2000 WHEN 1 THEN y + (16e6 * 2000 - 1.5e6 * 1750) / 14.5e6
      ELSE y + (16e6 * 2000 - 4e6 * 3000) / 12e6 END AS cy
  FROM zone),
tri AS (SELECT p_partkey AS cell, p_partkey % 2 AS half,
    367000.0::DOUBLE + (p_partkey // 2) % 6 * 7000 AS x,
    5797000.0::DOUBLE + (p_partkey // 2) // 6 * 7000 AS y FROM part),
centre AS (SELECT cell, round(x + CASE half WHEN 0 THEN 14000 ELSE 7000 END / 3.0) AS x,
    round(y + CASE half WHEN 0 THEN 7000 ELSE 14000 END / 3.0) AS y FROM tri)"""


def _below(x0: str, y0: str, x1: str, y1: str) -> str:
    """Area of a rectangle's part under the diagonal of the triangle's square."""
    height = f"greatest(0, least({y1}, y + 7000) - greatest({y0}, y))"
    low, high = f"greatest({x0}, x)", f"least({x1}, x + 7000)"
    lift = f"(x + greatest({y0}, y) - y)"

    def primitive(u: str) -> str:
        v = f"({u} - {lift})"
        return (f"CASE WHEN {v} <= 0 THEN 0 WHEN {v} <= {height} THEN {v} * {v} / 2 "
                f"ELSE {height} * {height} / 2 + {height} * ({v} - {height}) END")

    return (f"CASE WHEN {high} > {low} AND {height} > 0 "
            f"THEN ({primitive(high)}) - ({primitive(low)}) ELSE 0 END")


def _inside(x0: str, y0: str, x1: str, y1: str) -> str:
    whole = (f"greatest(0, least({x1}, x + 7000) - greatest({x0}, x)) "
             f"* greatest(0, least({y1}, y + 7000) - greatest({y0}, y))")
    below = _below(x0, y0, x1, y1)
    return f"CASE half WHEN 0 THEN {below} ELSE {whole} - ({below}) END"


BRIDGE = SHAPES + f""",
pairs AS (SELECT z.plr_id, z.area, z.kind, z.x AS zx, z.y AS zy, z.bx0, z.by0, z.bx1, z.by1, t.*
  FROM cut z JOIN tri t ON z.x < t.x + 7000 AND t.x < z.x + 4000
    AND z.y < t.y + 7000 AND t.y < z.y + 4000),
shared AS (SELECT plr_id, cell, area, ({_inside('zx', 'zy', '(zx + 4000)', '(zy + 4000)')})
    - CASE kind WHEN 0 THEN 0 ELSE {_inside('bx0', 'by0', 'bx1', 'by1')} END AS a FROM pairs),
bridge AS (SELECT plr_id, cell, area, a, a / area AS f, a / 24500000.0 AS g
  FROM shared WHERE a > 0.001)"""

# Distances through edge pairs.
MASK = SHAPES + """,
rings(kind, n, px, py) AS (VALUES
  (0, 0, 0, 0), (0, 1, 4000, 0), (0, 2, 4000, 4000), (0, 3, 0, 4000), (0, 4, 0, 0),
  (1, 0, 0, 0), (1, 1, 4000, 0), (1, 2, 4000, 4000), (1, 3, 0, 4000), (1, 4, 0, 0),
  (2, 0, 0, 0), (2, 1, 4000, 0), (2, 2, 4000, 2000), (2, 3, 2000, 2000), (2, 4, 2000, 4000),
  (2, 5, 0, 4000), (2, 6, 0, 0)),
sides AS (SELECT a.kind, a.px AS ax, a.py AS ay, b.px AS bx, b.py AS b_y
  FROM rings a JOIN rings b ON a.kind = b.kind AND b.n = a.n + 1),
corners(half, n, px, py) AS (VALUES (0, 0, 0, 0), (0, 1, 7000, 0), (0, 2, 7000, 7000), (0, 3, 0, 0),
  (1, 0, 0, 0), (1, 1, 7000, 7000), (1, 2, 0, 7000), (1, 3, 0, 0)),
legs AS (SELECT a.half, a.px AS cx, a.py AS cy, b.px AS dx, b.py AS dy
  FROM corners a JOIN corners b ON a.half = b.half AND b.n = a.n + 1),
near AS (SELECT z.id, z.kind, z.x AS zx, z.y AS zy, t.cell, t.half, t.x AS tx, t.y AS ty
  FROM zone z JOIN tri t ON z.x <= t.x + 12000 AND t.x <= z.x + 9000
    AND z.y <= t.y + 12000 AND t.y <= z.y + 9000),
seg AS (SELECT n.id, n.cell, zx + ax AS ax, zy + ay AS ay, zx + bx AS bx, zy + b_y AS b_y,
    tx + cx AS cx, ty + cy AS cy, tx + dx AS dx, ty + dy AS dy
  FROM near n JOIN sides s USING (kind) JOIN legs l USING (half)),
foot AS (SELECT *, px - qx AS ux, py - qy AS uy, rx - qx AS vx, ry - qy AS vy FROM (
    SELECT id, cell, ax AS px, ay AS py, cx AS qx, cy AS qy, dx AS rx, dy AS ry FROM seg UNION ALL
    SELECT id, cell, bx, b_y, cx, cy, dx, dy FROM seg UNION ALL
    SELECT id, cell, cx, cy, ax, ay, bx, b_y FROM seg UNION ALL
    SELECT id, cell, dx, dy, ax, ay, bx, b_y FROM seg)),
reach AS (SELECT id, cell, pow(ux - k * vx, 2) + pow(uy - k * vy, 2) AS d2 FROM (
    SELECT *, greatest(0, least(1, (ux * vx + uy * vy) / (vx * vx + vy * vy))) AS k FROM foot)),
hit AS (SELECT id, cell FROM seg WHERE
    ((bx-ax)*(cy-ay)-(b_y-ay)*(cx-ax)) * ((bx-ax)*(dy-ay)-(b_y-ay)*(dx-ax)) < 0
    AND ((dx-cx)*(ay-cy)-(dy-cy)*(ax-cx)) * ((dx-cx)*(b_y-cy)-(dy-cy)*(bx-cx)) < 0),
holds AS (SELECT id, n.cell FROM near n WHERE zx >= tx AND zx <= tx + 7000 AND zy >= ty
    AND zy <= ty + 7000 AND CASE half WHEN 0 THEN zy - ty <= zx - tx ELSE zy - ty >= zx - tx END),
masked AS (SELECT cell FROM reach WHERE d2 <= 25000000.0 UNION SELECT cell FROM hit
  UNION SELECT cell FROM holds)"""

# Transverse Mercator on GRS80, third flattening n.
_N = "0.0016792203946287445"


def _krueger(lon: str, lat: str) -> tuple[str, str]:
    e = f"(2 * sqrt({_N}) / (1 + {_N}))"
    t = f"sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat}))))"
    lam = f"radians({lon} - 15.0)"
    return f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + pow({t}, 2)))"


_A = f"(0.9996 * 6378137.0 / (1 + {_N}) * (1 + pow({_N}, 2) / 4 + pow({_N}, 4) / 64))"
_ALPHA = (
    f"({_N} / 2 - 2 * pow({_N}, 2) / 3 + 5 * pow({_N}, 3) / 16 + 41 * pow({_N}, 4) / 180)",
    f"(13 * pow({_N}, 2) / 48 - 3 * pow({_N}, 3) / 5 + 557 * pow({_N}, 4) / 1440)",
    f"(61 * pow({_N}, 3) / 240 - 103 * pow({_N}, 4) / 140)", f"(49561 * pow({_N}, 4) / 161280)")


def _easting(xi: str = "xi", eta: str = "eta") -> str:
    terms = " + ".join(f"{a} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
                       for j, a in enumerate(_ALPHA, start=1))
    return f"(500000 + {_A} * ({eta} + {terms}))"


def _northing(xi: str = "xi", eta: str = "eta") -> str:
    terms = " + ".join(f"{a} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
                       for j, a in enumerate(_ALPHA, start=1))
    return f"({_A} * ({xi} + {terms}))"


LATTICE = f"""part_cells AS (SELECT p_partkey AS cell, p_partkey % 23 AS d, p_partkey % 2 AS half,
    (p_partkey // 2) % 6 AS c, (p_partkey // 2) // 6 AS r FROM part),
places AS (SELECT cell, d, n, 13.0::DOUBLE + cc * 0.1 AS lon, 52.0::DOUBLE + rr % 15000 * 0.002 AS lat FROM (
    SELECT cell, d, 0 AS n, c AS cc, r AS rr FROM part_cells UNION ALL
    SELECT cell, d, 1, c + 1, r + 1 FROM part_cells UNION ALL
    SELECT cell, d, 2, CASE half WHEN 0 THEN c + 1 ELSE c END, CASE half WHEN 0 THEN r ELSE r + 1 END
      FROM part_cells)),
angles AS (SELECT cell, d, n, {_krueger('lon', 'lat')[0]} AS xi, {_krueger('lon', 'lat')[1]} AS eta
  FROM places),
planar AS (SELECT cell, d, max({_easting()}) FILTER (n = 0) AS x0, max({_northing()}) FILTER (n = 0) AS y0,
    max({_easting()}) FILTER (n = 1) AS x1, max({_northing()}) FILTER (n = 1) AS y1,
    max({_easting()}) FILTER (n = 2) AS x2, max({_northing()}) FILTER (n = 2) AS y2
  FROM angles GROUP BY cell, d)"""


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + select


add("field_explode", "", """SELECT vec_id, unnest(range(0, len(embedding))) AS cell_index,
  round(CAST(unnest(embedding) AS DOUBLE), 6) AS source_value FROM embeddings""")

add("bitmap_missing", """v AS (SELECT vec_id, vec_id % 3 AS h, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings)""", """SELECT vec_id, count(*) FILTER (x > CAST(0.2 AS FLOAT)) AS marker_count,
  CAST(CASE h WHEN 0 THEN 0 ELSE 1 END AS BIGINT) AS missing_count,
  CAST(CASE h WHEN 2 THEN 0 ELSE 1 END AS BIGINT) AS bitmap_present,
  CASE h WHEN 0 THEN true WHEN 1 THEN count(*) FILTER (x > CAST(0.2 AS FLOAT)) = 1 ELSE false END AS passed,
  CASE h WHEN 1 THEN count(*) FILTER (NOT x > CAST(0.2 AS FLOAT)) ELSE count(*) END AS kept_count
  FROM v GROUP BY vec_id, h""")

add("field_masked_manifest", MASKED, """SELECT run AS run_time_utc, 'PT000H00M' AS lead_time, indicator,
  count(*) AS source_point_count, count(*) FILTER (v IS NULL) AS source_missing_value_count,
  count(*) FILTER (k.cell IS NOT NULL) AS retained_point_count,
  nullif(count(*) FILTER (k.cell IS NOT NULL), 0) AS masked_rows,
  round(sum(v) FILTER (k.cell IS NOT NULL), 4) AS masked_sum
  FROM field f LEFT JOIN mask k USING (cell) GROUP BY run, indicator""")

add("combine_fields", FIELD, f"""SELECT cell AS cell_index, {_IDENTITY}, round(t, 6) AS temperature_c,
  round(rh, 6) AS relative_humidity_percent, round(td, 6) AS dew_point_temperature_c,
  round(u, 6) AS wind_u_10m_ms, round(w, 6) AS wind_v_10m_ms, round(ws, 6) AS wind_speed_10m_ms
  FROM speedy""")

add("field_identity", SPARSE + """,
c AS (SELECT run, lead_time, valid, cell, count(*) AS n,
  count(*) FILTER (indicator = 'T_2M') AS first FROM sparse GROUP BY ALL)""",
    """SELECT run AS run_time_utc, lead_time, valid AS valid_time_utc,
  CAST(sum(first) AS BIGINT) AS expected_rows, count(*) FILTER (n = 5) AS combined_rows,
  CAST(0 AS BIGINT) AS repeated_cells, count(*) FILTER (n = 5) = sum(first) AS passed
  FROM c GROUP BY ALL""")

add("contract_units", "", """SELECT event_id, CASE event_id % 11 WHEN 10 THEN 'unsupported_indicator'
  WHEN 1 THEN 'wrong_edition' WHEN 2 THEN 'wrong_parameter_number' WHEN 3 THEN 'wrong_surface_value'
  WHEN 4 THEN 'unexpected_units' WHEN 5 THEN 'wrong_point_count' WHEN 6 THEN 'missing_without_bitmap'
  WHEN 7 THEN 'missing_run_time' WHEN 8 THEN 'valid_time_mismatch' ELSE 'accepted' END AS outcome
  FROM events""")

TEMP = """temp AS (SELECT event_id, user_id, CAST(date_trunc('week', ts) AS TIMESTAMP) AS run, event_id % 101 AS d,
  CASE WHEN event_id % 101 IN (1, 2) THEN 9999.0::DOUBLE ELSE value / 10 + 270 END AS k,
  CASE WHEN event_id % 101 IN (1, 3) THEN 9725.85::DOUBLE WHEN event_id % 101 = 4 THEN value / 10
       ELSE value / 10 + 270 - 273.15 END AS c FROM events)"""

add("sentinel_audit", """b AS (SELECT *, CAST(date_trunc('week', ts) AS TIMESTAMP) AS batch,
  CASE WHEN week(date_trunc('week', ts)) % 3 = 1 THEN 0 ELSE event_id % 101 END AS d FROM events),
t AS (SELECT batch, d, CASE WHEN d <> 7 THEN event_id END AS cell,
  CASE WHEN d = 11 THEN batch - INTERVAL 1 HOUR ELSE batch END AS run,
  CASE WHEN d = 9 THEN batch + INTERVAL 1 HOUR WHEN d <> 8 THEN batch END AS valid,
  CASE WHEN d NOT IN (1, 2, 10) THEN value / 10 + 270 END AS k,
  CASE WHEN d IN (1, 3) THEN 9725.85::DOUBLE WHEN d = 4 THEN value / 10
       WHEN d <> 10 THEN value / 10 + 270 - 273.15 END AS c FROM b),
n AS (SELECT batch, count(*) AS row_count, count(*) FILTER (cell IS NULL) AS null_cell_count,
  count(DISTINCT cell) AS distinct_cell_count, count(*) FILTER (run IS NULL OR valid IS NULL) AS null_time_count,
  count(DISTINCT run) AS run_time_count, count(DISTINCT valid) AS valid_time_count,
  count(*) FILTER (d IN (2, 3)) AS half_missing_count, count(*) FILTER (d = 1) AS missing_count,
  count(*) FILTER (d = 10) AS non_finite_count,
  count(*) FILTER (d NOT IN (1, 10) AND abs(c - (coalesce(k, 9999) - 273.15)) > 1e-6) AS inconsistent_count,
  round(min(CASE d WHEN 2 THEN 9999 ELSE k END), 6) AS min_k,
  round(max(CASE d WHEN 2 THEN 9999 ELSE k END), 6) AS max_k FROM t GROUP BY batch)""",
    """SELECT *, null_cell_count = 0 AND distinct_cell_count + null_cell_count = row_count
  AND null_time_count = 0 AND run_time_count = 1 AND valid_time_count = 1 AND half_missing_count = 0
  AND non_finite_count = 0 AND inconsistent_count = 0 AND coalesce(min_k >= 253, true)
  AND coalesce(max_k <= 313, true) AS passed FROM n""")

add("temperature_profile", TEMP + ",\n" + LINKS + """,
wanted AS (SELECT DISTINCT cell FROM links),
kept AS (SELECT * FROM temp WHERE event_id IN (SELECT cell FROM wanted))""",
    """SELECT (SELECT count(*) FROM temp) AS row_count,
  (SELECT count(DISTINCT event_id) FROM temp) AS distinct_cell_count,
  (SELECT count(*) - count(DISTINCT event_id) FROM temp) AS duplicate_cell_index_count,
  (SELECT count(*) FILTER (d = 1) FROM temp) AS missing_row_count,
  (SELECT count(DISTINCT run) FROM temp) AS distinct_run_time_count,
  (SELECT round(avg(CASE WHEN d = 1 THEN 1 ELSE 0 END), 6) FROM temp) AS missing_share,
  (SELECT count(*) FROM wanted) AS expected_relevant_cell_count,
  (SELECT count(DISTINCT event_id) FROM kept) AS matched_cell_count,
  (SELECT count(*) FROM wanted) - (SELECT count(DISTINCT event_id) FROM kept) AS missing_relevant_cell_count,
  (SELECT count(*) FILTER (d = 1) FROM kept) AS missing_temperature_row_count,
  (SELECT round(avg(c) FILTER (d <> 1), 6) FROM kept) AS mean_c""")


def _described(column: str, expr: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", count(x) AS value_count, round(min(x), 4) AS "min",
  round(median(x), 4) AS median, round(avg(x), 4) AS mean, round(max(x), 4) AS "max",
  round(sum(x), 4) AS "sum", round(stddev_samp(x), 4) AS std
  FROM (SELECT {expr} AS x FROM {source}) AS s"""


add("observed_temperature", TEMP, "\nUNION ALL\n".join((
    _described("temperature_k", "k", "temp WHERE d <> 1"),
    _described("temperature_c", "c", "temp WHERE d <> 1"))))

add("text_parse_flags", POP, """SELECT plr_id, o AS strict, NOT o_blank AND o IS NULL AS unparsable,
  TRY_CAST(nullif(trim(ot), '') AS DOUBLE) AS lenient FROM nums""")

add("reference_month_end", "", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 50 <> 0 THEN last_day(o_orderdate) END AS month_end,
  o_orderkey % 50 <> 0 AS is_code FROM orders""")

add("lead_time_parse", """m AS (SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS run,
    CAST(event_id * 7 % 70000 AS INTEGER) AS n FROM events),
l AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'PT012H99M' WHEN n > 59999 THEN '12h'
    ELSE printf('PT%03dH%02dM', n // 60, n % 60) END AS label FROM m),
k AS (SELECT *, CASE WHEN event_id % 97 <> 0 AND n <= 59999 THEN n END AS minutes FROM l)""",
    """SELECT event_id, label, CAST(minutes AS BIGINT) AS minutes,
  run + to_minutes(minutes) AS valid_time_utc,
  label || '|' || strftime(run, '%Y%m%dT%H%M') AS key,
  CASE WHEN minutes IS NOT NULL THEN label END AS key_lead,
  CASE WHEN minutes IS NOT NULL THEN run END AS key_run FROM k""")

add("source_urls", SPARSE, """SELECT indicator, run AS run_time_utc, lead_time, cell AS cell_index,
  'https://example.org/p/' || indicator || '/r/' || strftime(run, '%Y-%m-%dT%H:%M') || '/s/'
    || lead_time || '.grib2' AS address,
  CASE WHEN lead_time <> 'PT006H00M' THEN run + to_hours(CAST(cell % 24 AS INTEGER)) END AS header_time,
  lower(indicator) AS directory FROM sparse""")

add("polling_window", "", """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
  count(*) FILTER (minute(ts) >= 30) AS open_count, count(*) AS event_count FROM events GROUP BY 1""")

add("population_gate", POP, """SELECT plr_id, t AS population_total, m AS population_65_79,
  o AS population_80plus, s AS population_65plus,
  CASE WHEN reason IS NULL THEN round(s / t, 6) END AS share_65plus, reason AS rejection_reason,
  DATE '2025-12-31' AS reference_date FROM pop""")

add("population_gate_lenient", POP, """SELECT plr_id, t AS population_total, s AS population_65plus,
  round(share, 6) AS share_65plus, reason AS rejection_reason FROM lenient""")

add("population_reasons", POP, """SELECT reason AS rejection_reason, count(*) AS reason_count
  FROM pop WHERE reason IS NOT NULL GROUP BY reason""")

add("population_accounting", POP, """SELECT count(*) > 0 AS passed, count(*) AS source_row_count,
  count(*) FILTER (reason IS NULL) AS accepted_row_count,
  count(*) FILTER (reason IS NOT NULL) AS rejected_row_count,
  (SELECT count(*) FROM (SELECT plr_id FROM pop WHERE reason IS NULL
    INTERSECT SELECT plr_id FROM pop WHERE reason IS NOT NULL)) AS accepted_rejected_overlap,
  count(DISTINCT plr_id) = count(*) AS preconditions_passed,
  count(DISTINCT plr_id) AS distinct_plr_count, count(*) - count(nullif(trim(plr_id), '')) AS blank_plr_count,
  CAST(1 AS BIGINT) AS reference_code_count,
  (SELECT count(*) FROM (SELECT plr_id FROM raw EXCEPT SELECT plr_id FROM pop)) AS key_difference_count
  FROM pop""")

add("population_contract", POP + """,
strict AS (SELECT *, CASE WHEN CAST(plr_id AS BIGINT) % 43 <> 1 THEN plr_id END AS id,
  CASE CAST(plr_id AS BIGINT) % 47 WHEN 2 THEN '202412' WHEN 3 THEN NULL ELSE '202512' END AS code
  FROM lenient),
twice AS (SELECT count(*) AS n FROM lenient WHERE reason IS NULL AND CAST(plr_id AS BIGINT) % 53 = 4),
n AS (SELECT count(*) AS row_count, count(*) - count(id) AS blank_id_count,
  count(DISTINCT id) AS distinct_id_count, count(*) - count(code) AS null_code_count,
  count(DISTINCT code) AS code_count, min(code) AS code,
  count(*) FILTER (t IS NULL) AS missing_total_count, count(*) FILTER (t < 0) AS negative_total_count,
  count(*) FILTER (m < 0 OR o < 0) AS negative_component_count,
  count(*) FILTER (m > t OR o > t) AS component_exceeds_count,
  count(*) FILTER (s > t) AS sum_exceeds_count,
  count(*) FILTER (share < 0 OR share > 1) AS share_range_count,
  count(*) FILTER (reason IS NULL AND (t IS NULL OR s IS NULL OR share IS NULL)) AS accepted_missing_count
  FROM strict)""", """SELECT n.* EXCLUDE (code), code = '202512' AND code_count = 1
    AND distinct_id_count + blank_id_count = row_count AND blank_id_count = 0 AND null_code_count = 0
    AND missing_total_count = 0 AND negative_total_count = 0 AND negative_component_count = 0
    AND component_exceeds_count = 0 AND sum_exceeds_count = 0 AND share_range_count = 0 AS passed,
  accepted_missing_count = 0 AND twice.n = 0 AS artefact_passed, twice.n AS overlap_count,
  row_count + twice.n AS artefact_rows FROM n, twice""")

add("population_profile", POP, """SELECT count(*) AS row_count, count(DISTINCT plr_id) AS distinct_id_count,
  CAST(0 AS BIGINT) AS null_id_count, CAST(1 AS BIGINT) AS reference_code_count,
  '202512' AS first_reference_code, '202512' AS last_reference_code,
  count(*) - count(t) AS population_total_null_count, count(*) - count(m) AS population_65_79_null_count,
  count(*) - count(o) AS population_80plus_null_count, count(*) - count(s) AS population_65plus_null_count,
  count(*) - count(share) AS share_65plus_null_count,
  count(*) - count(DISTINCT plr_id) AS duplicate_id_count FROM lenient""")

add("cardinality_audit", "", """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
  GROUP BY ALL HAVING count(*) > 1""")

add("duplicate_flags", """n AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""",
    """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(sum(n) AS BIGINT) AS row_count,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows FROM n GROUP BY 1""")

add("constraint_audit", "", """SELECT 'not_null:l_partkey' AS "constraint",
  count(*) FILTER (l_partkey IS NULL) AS violation_count FROM lineitem
UNION ALL SELECT 'not_null:l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
UNION ALL SELECT 'check:quantity_range', count(*) FILTER (NOT l_quantity BETWEEN 2 AND 49) FROM lineitem
UNION ALL SELECT 'check:flag_enum', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'check:discount', count(*) FILTER (NOT l_discount <= 0.09) FROM lineitem
UNION ALL SELECT 'primary_key', (SELECT count(*) FROM lineitem)
  - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
UNION ALL SELECT 'foreign_key:order', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'foreign_key:supplier', count(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")

add("orphan_rows", "", """SELECT l_orderkey AS o_orderkey, count(*) AS row_count FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o_orderstatus = 'O')
  GROUP BY 1""")

add("key_differences", """a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error'),
b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')""",
    """SELECT user_id, 'missing_right' AS difference FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT user_id, 'missing_left' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")

add("numeric_describe", "", "\nUNION ALL\n".join(
    [_described(c, c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    + [_described("value", "value", "events")]))

add("null_and_value_counts", POP, """SELECT coalesce(CASE WHEN length(ot) = 2 THEN ot END, '<NULL>')
  AS population_80plus_source, count(*) AS row_count FROM texts GROUP BY 1""")

add("latest_source", "", """SELECT * FROM (SELECT 'latest' AS kind, o_orderpriority AS label,
  max(o_orderdate) AS stamp FROM orders GROUP BY o_orderpriority ORDER BY stamp DESC, label LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'current', o_orderstatus AS label,
  max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END) AS stamp FROM orders GROUP BY o_orderstatus
  ORDER BY stamp DESC NULLS LAST, label DESC LIMIT 1)""")

add("plr_weather", ZONED, f"SELECT plr_id, {_IDENTITY}, {_VALUES} FROM zoned")

add("plr_temperature", FIELD + ",\n" + LINKS, """SELECT plr_id, run AS run_time_utc, run AS valid_time_utc,
  round(sum(t * f), 6) AS temperature_c, round(sum((t + 273.15) * f), 6) AS temperature_k,
  count(DISTINCT cell) AS icon_cells_used, round(sum(f), 6) AS weight_sum
  FROM weights JOIN wide USING (cell) GROUP BY plr_id, run""")

add("bridge_coverage", SPARSE + ",\n" + LINKS + """,
wanted AS (SELECT DISTINCT cell FROM links),
got AS (SELECT run, lead_time, valid, count(DISTINCT CASE WHEN cell IN (SELECT cell FROM wanted)
  THEN cell END) AS n FROM sparse GROUP BY ALL)""",
    """SELECT run AS run_time_utc, lead_time, valid AS valid_time_utc, n AS matched_cell_count,
  (SELECT count(*) FROM wanted) - n AS missing_cell_count, (SELECT count(*) FROM wanted) = n AS passed
  FROM got""")

add("plr_weather_population", FINAL,
    f"SELECT plr_id, {_IDENTITY}, {_VALUES}, {_POPULATION} FROM final")

add("partition_summary", FINAL, f"""SELECT {_IDENTITY}, count(*) AS row_count,
  count(DISTINCT plr_id) AS plr_count, count(*) - count(t) AS temperature_c_null_count,
  count(*) - count(rh) AS relative_humidity_percent_null_count,
  count(*) - count(td) AS dew_point_temperature_c_null_count,
  count(*) - count(u) AS wind_u_10m_ms_null_count, count(*) - count(v) AS wind_v_10m_ms_null_count,
  count(*) - count(ws) AS wind_speed_10m_ms_null_count,
  count(*) FILTER (status = 'available') AS available_count,
  count(*) FILTER (status = 'rejected_source_record') AS rejected_source_record_count
  FROM final GROUP BY run""")

add("current_exposure", FINAL, f"""SELECT plr_id, {_IDENTITY}, {_VALUES}, {_POPULATION} FROM final
  WHERE run = (SELECT max(run) FROM final)""")

add("hottest_zones", FINAL, """SELECT row_number() OVER (ORDER BY round(t, 6) DESC NULLS LAST, plr_id) AS rank,
  plr_id, run AS run_time_utc, 'PT000H00M' AS lead_time, round(t, 6) AS temperature_c,
  round(rh, 6) AS relative_humidity_percent, total AS population_total, senior AS population_65plus,
  round(share, 6) AS share_65plus, status AS population_status FROM final
  WHERE run = (SELECT max(run) FROM final) ORDER BY rank LIMIT 10""")

add("status_reason_counts", FINAL, """SELECT 'status' AS kind, status AS label, count(*) AS row_count
  FROM final GROUP BY status UNION ALL
  SELECT 'reason', reason, count(*) FROM final WHERE reason IS NOT NULL GROUP BY reason""")

add("final_checks", FINAL + """,
zones AS (SELECT count(*) AS c FROM customer),
per AS (SELECT run, count(*) AS n, count(DISTINCT plr_id) AS d, count(*) - count(plr_id) AS blank
  FROM final GROUP BY run),
refused AS (SELECT DISTINCT plr_id FROM final WHERE status = 'rejected_source_record'),
registry AS (SELECT plr_id FROM pop WHERE reason IS NOT NULL),
n AS (SELECT count(DISTINCT run) AS forecast_count, count(*) AS row_count,
  count(*) FILTER (status = 'available') AS available_count,
  count(*) FILTER (status = 'rejected_source_record') AS final_rejected_count,
  count(*) FILTER (status IS NULL OR status NOT IN ('available', 'rejected_source_record')) AS bad_status_count,
  count(*) FILTER (status = 'available' AND (total IS NULL OR senior IS NULL OR share IS NULL))
    AS available_incomplete_count,
  count(*) FILTER (status = 'rejected_source_record'
    AND (total IS NOT NULL OR senior IS NOT NULL OR share IS NOT NULL)) AS rejected_with_metrics_count,
  count(*) FILTER (status = 'rejected_source_record' AND reason IS NULL) AS rejected_without_reason_count,
  (SELECT count(*) FROM registry) AS registry_rejected_count,
  (SELECT count(*) FROM refused WHERE plr_id NOT IN (SELECT plr_id FROM registry))
    + (SELECT count(*) FROM registry WHERE plr_id NOT IN (SELECT plr_id FROM refused)) AS registry_difference_count,
  count(DISTINCT CASE WHEN plr_id NOT IN (SELECT plr_id FROM pop WHERE reason IS NULL) THEN plr_id END)
    AS unmatched_key_count,
  count(DISTINCT CASE WHEN plr_id NOT IN (SELECT plr_id FROM pop) THEN plr_id END) AS unexplained_key_count,
  (SELECT count(*) FROM registry WHERE plr_id NOT IN (SELECT plr_id FROM final)) AS unused_registry_key_count
  FROM final)""", """SELECT n.*, CAST((SELECT sum(blank) FROM per) AS BIGINT) AS missing_plr_ids,
  (SELECT bool_and(n = c AND d = c AND blank = 0) FROM per, zones) AS coverage_passed,
  bad_status_count + available_incomplete_count + rejected_with_metrics_count
    + rejected_without_reason_count + registry_difference_count = 0 AS passed,
  unexplained_key_count + unused_registry_key_count = 0 AS explained_passed,
  (SELECT bool_and(run = strptime(strftime(run, '%Y%m%dT%H%M'), '%Y%m%dT%H%M')) FROM final) AS identity_passed
  FROM n""")

_ROWS = ", ".join(f"coalesce(max(n) FILTER (indicator = '{i}'), 0) AS rows_{i.lower()}"
                  for i in ("T_2M", "RELHUM_2M", "TD_2M", "U_10M", "V_10M"))

add("partition_complete_full", SPARSE + """,
size AS (SELECT max(user_id) + 1 AS s FROM events),
spoiled AS (SELECT run, lead_time, unit, cell % 89 = 7 AS late, cell % 83 = 11 AS bad,
  cell % 79 = 3 OR v IS NULL AS empty,
  CASE WHEN cell % 97 = 13 AND indicator = 'U_10M' THEN 'PMSL' ELSE indicator END AS indicator FROM sparse),
per AS (SELECT run, lead_time, indicator, indicator <> 'PMSL' AS known, count(*) AS n,
  min(unit) = max(unit) AS same, count(*) FILTER (late) AS late, count(*) FILTER (bad) AS bad,
  count(*) FILTER (empty) AS empty FROM spoiled GROUP BY ALL)""", f"""SELECT run AS run_time_utc, lead_time,
  CAST(sum(n) AS BIGINT) AS total_row_count, 5 * (SELECT s FROM size) AS expected_row_count,
  count(*) AS indicator_count, 5 - count(*) FILTER (known) AS missing_indicator_count,
  count(*) FILTER (NOT known) AS unexpected_indicator_count,
  5 - count(*) FILTER (known AND n = (SELECT s FROM size)) AS wrong_row_count_indicator_count,
  CAST(sum(late) AS BIGINT) AS wrong_valid_time_row_count,
  CAST(sum(bad) AS BIGINT) AS invalid_cell_index_row_count,
  count(*) FILTER (NOT same) AS inconsistent_source_metadata_indicator_count,
  CAST(sum(empty) AS BIGINT) AS null_source_value_count, {_ROWS},
  sum(n) = 5 * (SELECT s FROM size) AND count(*) = 5 AND count(*) FILTER (NOT same) = 0
    AND count(*) FILTER (known AND n = (SELECT s FROM size)) = 5 AND sum(late) = 0 AND sum(bad) = 0
    AS passed FROM per GROUP BY run, lead_time""")

add("partition_complete_scoped", MASKED + """,
m AS (SELECT count(*) AS m FROM mask),
bound AS (SELECT min(run) AS a, max(run) AS b FROM runs),
kept AS (SELECT run, indicator, cell, v, cell IN (SELECT cell FROM mask) AS held FROM field
  WHERE cell IN (SELECT cell FROM mask)
    OR (run = (SELECT a FROM bound) AND indicator = 'T_2M')),
per AS (SELECT run, indicator, count(*) AS n, count(*) FILTER (NOT held) AS stray,
  count(*) FILTER (v IS NULL) AS nulls FROM kept GROUP BY ALL)""", f"""SELECT run AS run_time_utc,
  'PT000H00M' AS lead_time, CASE WHEN run = (SELECT b FROM bound) THEN 4 ELSE 5 END::BIGINT AS source_indicator_count,
  count(*) AS field_indicator_count, CAST(sum(n) AS BIGINT) AS total_retained_row_count,
  5 * (SELECT m FROM m) AS expected_retained_row_count, (SELECT m FROM m) AS mask_cell_count,
  (CASE WHEN run = (SELECT b FROM bound) THEN 1 ELSE 0 END
    + CASE week(run) % 5 WHEN 1 THEN 1 ELSE 0 END)::BIGINT AS missing_indicator_count,
  CASE week(run) % 5 WHEN 1 THEN 1 ELSE 0 END::BIGINT AS unexpected_indicator_count,
  CASE week(run) % 5 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS wrong_source_point_count_indicator_count,
  5 - count(*) FILTER (n = (SELECT m FROM m)) AS wrong_retained_row_count_indicator_count,
  CASE week(run) % 5 WHEN 3 THEN 1 ELSE 0 END::BIGINT AS wrong_valid_time_indicator_count,
  CASE WHEN week(run) % 5 = 4 AND run <> (SELECT b FROM bound) THEN 1 ELSE 0 END::BIGINT
    AS inconsistent_scope_count,
  CAST(sum(stray) AS BIGINT) AS outside_mask_row_count,
  CAST(sum(nulls) AS BIGINT) AS null_retained_value_count, {_ROWS},
  run <> (SELECT b FROM bound) AND week(run) % 5 = 0 AND sum(stray) = 0 AND count(*) = 5
    AND sum(n) = 5 * (SELECT m FROM m) AS passed FROM per GROUP BY run""")

add("missing_indicators", EV + """,
seen AS (SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS run, lead_time, indicator FROM ev),
cal AS (SELECT run, lead_time FROM (SELECT unnest(range((SELECT min(run) FROM seen),
  (SELECT max(run) FROM seen), INTERVAL 1 HOUR)) AS run), leads),
want(o, indicator) AS (VALUES (0, 'T_2M'), (1, 'RELHUM_2M'), (2, 'TD_2M'), (3, 'U_10M'), (4, 'V_10M')),
gap AS (SELECT run, lead_time, o, indicator FROM cal, want
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.run = cal.run AND s.lead_time = cal.lead_time
    AND s.indicator = want.indicator))""",
    """SELECT c.run AS run_time_utc, c.lead_time,
  coalesce(string_agg(g.indicator, ',' ORDER BY o), '') AS missing_indicators,
  count(g.o) = 0 AS complete FROM cal c LEFT JOIN gap g USING (run, lead_time) GROUP BY ALL""")

PENDING = EV + """,
win AS (SELECT DISTINCT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run FROM ev
  WHERE ts >= TIMESTAMP '2024-01-05' ORDER BY run DESC LIMIT 6),
cand AS (SELECT run, lead_order, lead_time FROM win, leads),
seen AS (SELECT DISTINCT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run, lead_time, indicator FROM ev
  WHERE NOT (lead_time = 'PT002H00M' AND indicator = 'U_10M')),
fin AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run, lead_time FROM ev WHERE value > 60
  GROUP BY ALL HAVING count(DISTINCT indicator) = 5),
want(o, indicator) AS (VALUES (0, 'T_2M'), (1, 'RELHUM_2M'), (2, 'TD_2M'), (3, 'U_10M'), (4, 'V_10M')),
gap AS (SELECT run, lead_time, string_agg(indicator, ',' ORDER BY o) AS miss FROM cand, want
  WHERE (run, lead_time, indicator) NOT IN (SELECT (run, lead_time, indicator) FROM seen) GROUP BY ALL),
pend AS (SELECT c.run, c.lead_order, c.lead_time, coalesce(g.miss, '') AS miss,
  CASE WHEN f.run IS NOT NULL THEN 'already_complete' WHEN g.miss IS NULL THEN 'ready'
       ELSE 'incomplete' END AS state
  FROM cand c LEFT JOIN gap g USING (run, lead_time) LEFT JOIN fin f USING (run, lead_time))"""

add("ready_partitions", PENDING, """SELECT run AS run_time_utc, CAST(lead_order AS BIGINT) AS lead_order,
  lead_time, state, miss AS missing_indicators FROM pend""")

add("readiness_decision", PENDING + """,
n AS (SELECT count(*) FILTER (state = 'ready') AS r, count(*) FILTER (state <> 'already_complete') AS c,
  count(*) FILTER (state = 'already_complete') AS a FROM pend),
i AS (SELECT * FROM pend WHERE state = 'incomplete' ORDER BY run DESC, lead_order LIMIT 1)""",
    """SELECT r AS ready_forecasts, c AS checked_forecasts, a AS already_complete_forecasts,
  i.run AS latest_incomplete_run, i.lead_time AS latest_incomplete_lead,
  i.miss AS latest_missing_indicators,
  CASE WHEN r > 0 THEN NULL WHEN i.run IS NOT NULL THEN 'latest incomplete candidate: '
    || strftime(i.run, '%Y%m%dT%H%M') || ' x ' || i.lead_time || '; missing: ' || replace(i.miss, ',', ', ')
    WHEN a > 0 THEN 'checked candidates are already complete'
    ELSE 'no eligible forecast candidate' END AS skip_reason FROM n LEFT JOIN i ON true""")

add("retry_eligible", """leads(l, lead_time) AS (VALUES (0, 'PT000H00M'), (1, 'PT001H00M'), (2, 'PT002H00M'),
  (3, 'PT006H00M'), (4, 'PT012H00M'), (5, 'PT024H00M')),
log AS (SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS run, lead_time, o_orderkey, o_orderdate,
  CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS' ELSE 'CANCELED' END AS status
  FROM orders JOIN leads ON l = o_custkey % 6),
days AS (SELECT DISTINCT run FROM log),
tried AS (SELECT run, lead_time, count(*) AS n, arg_max(status, (o_orderdate, o_orderkey)) AS last
  FROM log GROUP BY ALL)""", """SELECT run AS run_time_utc, lead_time, last AS last_status,
  coalesce(n, 0) + 1 AS attempt, 'weather:' || strftime(run, '%Y%m%dT%H%M') || ':' || lead_time
    || ':attempt_' || (coalesce(n, 0) + 1) AS run_key,
  lead_time || '|' || strftime(run, '%Y%m%dT%H%M') AS partition_key
  FROM (SELECT run, lead_time FROM days, leads) LEFT JOIN tried USING (run, lead_time)
  WHERE last IS NULL OR (last <> 'SUCCESS' AND n + 1 <= 5)""")

add("stream_completion", EV, """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run_time_utc, lead_time
  FROM ev GROUP BY ALL HAVING count(DISTINCT indicator) = 5""")

add("zone_area_bbox", SHAPES, """SELECT plr_id, area AS area_m2, x AS minx, y AS miny, x + 4000 AS maxx,
  y + 4000 AS maxy, round(cx, 3) AS cx, round(cy, 3) AS cy FROM cut""")

add("zone_area_profile", SHAPES, """SELECT count(*) AS zone_count, min(x) AS minx, min(y) AS miny,
  max(x) + 4000 AS maxx, max(y) + 4000 AS maxy, min(area) AS area_min, median(area) AS area_median,
  max(area) AS area_max, sum(area) AS area_sum FROM cut""")

add("triangle_build", LATTICE, """SELECT cell AS cell_index, CASE d WHEN 1 THEN 'invalid_vertex_count'
  WHEN 2 THEN 'repeated_vertex' WHEN 3 THEN 'missing_vertex_coordinate'
  WHEN 4 THEN 'invalid_vertex_coordinate' END AS rejection_reason,
  CASE WHEN d NOT IN (1, 2, 3, 4) THEN round(abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2) END
  AS area_m2 FROM planar""")

add("mesh_profile", """c AS (SELECT p_partkey AS k, p_partkey % 23 AS d, p_partkey % 2 AS half,
    (p_partkey // 2) // 6 * 7 + (p_partkey // 2) % 6 AS b FROM part),
corner AS (SELECT k, b AS v FROM c UNION ALL SELECT k, b + 8 FROM c UNION ALL
  SELECT k, CASE d WHEN 2 THEN b WHEN 3 THEN k * 2 + 100000000 WHEN 4 THEN k * 2 + 100000001
    ELSE CASE half WHEN 0 THEN b + 1 ELSE b + 7 END END FROM c WHERE d <> 1),
vertex AS (SELECT DISTINCT v, 13.0::DOUBLE + v % 7 * 0.1 AS lon, 52.0::DOUBLE + v // 7 % 15000 * 0.002 AS lat FROM (
    SELECT b AS v FROM c UNION SELECT b + 1 FROM c UNION SELECT b + 7 FROM c UNION SELECT b + 8 FROM c)
  UNION ALL SELECT k, CASE d WHEN 4 THEN 13.0 END, 95.0 FROM c WHERE d IN (3, 4)),
n AS (SELECT k, count(*) AS n FROM corner GROUP BY k)""", """SELECT (SELECT count(*) FROM n) AS cell_count,
  (SELECT min(n) FROM n) AS min_vertices_per_cell, (SELECT max(n) FROM n) AS max_vertices_per_cell,
  (SELECT count(DISTINCT v) FROM corner) AS unique_vertices_referenced, count(*) AS vertex_count,
  round(min(lon), 6) AS min_longitude, round(max(lon), 6) AS max_longitude,
  round(min(lat), 6) AS min_latitude, round(max(lat), 6) AS max_latitude,
  count(*) FILTER (lon IS NULL) AS missing_coordinate_count FROM vertex""")

add("area_bridge", BRIDGE, """SELECT plr_id, cell AS cell_index, round(a, 3) AS intersection_area_m2,
  round(f, 6) AS fraction_of_plr, round(g, 6) AS fraction_of_icon_cell FROM bridge""")

add("bridge_quality", BRIDGE + """,
sums AS (SELECT plr_id, sum(f) AS s FROM bridge GROUP BY plr_id),
n AS (SELECT count(*) AS bridge_row_count,
  count(DISTINCT plr_id) AS represented_plr_count, count(DISTINCT cell) AS represented_icon_cell_count,
  (SELECT count(*) FROM customer) AS source_plr_count,
  (SELECT count(*) FROM customer) - count(DISTINCT plr_id) AS missing_plr_count,
  count(*) FILTER (plr_id NOT IN (SELECT plr_id FROM zone)) AS orphan_plr_count,
  count(*) FILTER (cell NOT IN (SELECT cell FROM tri)) AS orphan_icon_cell_count,
  count(*) FILTER (a <= 0) AS nonpositive_area_count,
  count(*) FILTER (f > 1.000001 OR g > 1.000001) AS invalid_fraction_count,
  (SELECT count(*) FROM sums WHERE abs(s - 1) > 1e-6) AS plr_weight_failure_count,
  (SELECT round(max(abs(s - 1)), 6) FROM sums) AS max_plr_weight_error FROM bridge)""",
    """SELECT *, missing_plr_count + orphan_plr_count + orphan_icon_cell_count + nonpositive_area_count
  + invalid_fraction_count + plr_weight_failure_count = 0 AS passed FROM n""")

add("bridge_profile", BRIDGE, """SELECT plr_id, count(DISTINCT cell) AS icon_cells_used,
  round(sum(f), 6) AS weight_sum, round(sum(a), 3) AS intersection_area_sum_m2,
  max(area) AS plr_area_m2, round(sum(a) / max(area), 3) AS coverage_ratio FROM bridge GROUP BY plr_id""")

add("bridge_references", LINKS + """,
c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS plr_id, c_acctbal, c_nationkey FROM customer),
b AS (SELECT DISTINCT plr_id, cell FROM links JOIN c USING (plr_id) WHERE c_nationkey <> 3),
z AS (SELECT plr_id FROM c WHERE c_acctbal > 0)""",
    """SELECT 'zone' AS kind, plr_id AS id, 'missing_from_bridge' AS difference FROM z
  WHERE plr_id NOT IN (SELECT plr_id FROM b)
UNION ALL SELECT DISTINCT 'zone', plr_id, 'unexpected_in_bridge' FROM b
  WHERE plr_id NOT IN (SELECT plr_id FROM z)
UNION ALL SELECT DISTINCT 'cell', CAST(cell AS VARCHAR), 'missing_from_source' FROM b
  WHERE cell NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")

add("reproject", f"""p AS (SELECT s_suppkey, 12.0::DOUBLE + s_suppkey % 50 * 0.1 AS lon,
    48.0::DOUBLE + s_suppkey // 50 % 800 * 0.05 AS lat FROM supplier),
a AS (SELECT *, {_krueger('lon', 'lat')[0]} AS xi, {_krueger('lon', 'lat')[1]} AS eta FROM p)""",
    f"""SELECT s_suppkey, round({_easting()}, 3) AS x, round({_northing()}, 3) AS y,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM a""")

NEAREST = SHAPES + """,
spot AS (SELECT plr_id, CASE WHEN id % 37 <> 5 THEN round(cx) END AS px, round(cy) AS py FROM cut),
gap AS (SELECT plr_id, cell, sqrt(pow(px - x, 2) + pow(py - y, 2)) AS d FROM spot, centre
  WHERE px IS NOT NULL),
best AS (SELECT plr_id, cell, d FROM gap QUALIFY rank() OVER (PARTITION BY plr_id ORDER BY d) = 1)"""

add("nearest_cell", NEAREST, """SELECT plr_id, cell AS cell_index, round(d, 3) AS distance_m
  FROM spot LEFT JOIN best USING (plr_id)""")

add("nearest_summary", NEAREST + """,
load AS (SELECT cell, count(*) AS n FROM best GROUP BY cell)""", """SELECT count(*) AS mapped_count,
  round(avg(d), 3) AS mean_distance_m, round(median(d), 3) AS median_distance_m,
  round(max(d), 3) AS max_distance_m, (SELECT count(*) FROM load) AS cells_used,
  (SELECT round(CAST(min(n) AS DOUBLE), 3) FROM load) AS min_zones_per_cell,
  (SELECT round(median(n), 3) FROM load) AS median_zones_per_cell,
  (SELECT round(avg(n), 3) FROM load) AS mean_zones_per_cell,
  (SELECT round(CAST(max(n) AS DOUBLE), 3) FROM load) AS max_zones_per_cell FROM best""")

add("cells_in_union", SHAPES, """SELECT cell AS cell_index, x, y FROM centre p WHERE EXISTS (
  SELECT 1 FROM cut z WHERE p.x BETWEEN z.x AND z.x + 4000 AND p.y BETWEEN z.y AND z.y + 4000
    AND NOT (kind = 1 AND p.x > bx0 AND p.x < bx1 AND p.y > by0 AND p.y < by1)
    AND NOT (kind = 2 AND p.x > bx0 AND p.y > by0))""")

add("union_outline", """z AS (SELECT c_custkey % 3 AS kind, CAST(c_custkey % 8 * 4000 AS BIGINT) AS x,
    CAST(c_custkey // 8 * 4000 AS BIGINT) AS y FROM customer),
r(kind, ax, ay, bx, b_y) AS (VALUES
  (0, 0, 0, 4000, 0), (0, 4000, 0, 4000, 4000), (0, 0, 4000, 4000, 4000), (0, 0, 0, 0, 4000),
  (1, 0, 0, 4000, 0), (1, 4000, 0, 4000, 4000), (1, 0, 4000, 4000, 4000), (1, 0, 0, 0, 4000),
  (1, 1000, 1000, 2000, 1000), (1, 2000, 1000, 2000, 2500), (1, 1000, 2500, 2000, 2500),
  (1, 1000, 1000, 1000, 2500),
  (2, 0, 0, 4000, 0), (2, 4000, 0, 4000, 2000), (2, 2000, 2000, 4000, 2000),
  (2, 2000, 2000, 2000, 4000), (2, 0, 4000, 2000, 4000), (2, 0, 0, 0, 4000)),
e AS (SELECT x + ax AS ax, y + ay AS ay, x + bx AS bx, y + b_y AS b_y FROM z JOIN r USING (kind)),
o AS (SELECT * FROM e GROUP BY ALL HAVING count(*) = 1)""", """SELECT CASE WHEN ax = bx THEN 'vertical' ELSE 'horizontal' END AS direction,
  count(*) AS edge_count, round(CAST(sum(bx - ax + b_y - ay) AS DOUBLE), 3) AS length_m FROM o GROUP BY 1""")

add("weather_mask", MASK, """SELECT '2023-01-01' AS geography_version, 'G1' AS source_grid_id,
  CAST(5000 AS BIGINT) AS mask_buffer_m, cell AS cell_index FROM masked""")

add("mask_quality", MASK + BRIDGE[len(SHAPES):] + """,
n AS (SELECT (SELECT count(*) FROM customer) AS source_plr_count, (SELECT count(*) FROM masked) AS mask_cell_count,
  (SELECT count(DISTINCT cell) FROM bridge) AS bridge_cell_count,
  (SELECT count(DISTINCT cell) FROM bridge WHERE cell NOT IN (SELECT cell FROM masked))
    AS missing_bridge_cell_count,
  (SELECT count(*) FROM masked WHERE cell NOT IN (SELECT cell FROM tri)) AS orphan_mask_cell_count)""",
    """SELECT *, mask_cell_count > 0 AND missing_bridge_cell_count = 0 AND orphan_mask_cell_count = 0 AS passed
  FROM n""")

add("zone_gate", "", """SELECT c_custkey AS source_row_id, CASE c_custkey % 19 WHEN 1 THEN NULL
    WHEN 3 THEN 'DUP00001' ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS plr_id,
  CASE c_custkey % 19 WHEN 1 THEN 'missing_plr_id' WHEN 2 THEN 'missing_geography_version'
    WHEN 3 THEN 'duplicate_plr_id' WHEN 4 THEN 'missing_geometry' WHEN 5 THEN 'empty_geometry'
    WHEN 6 THEN 'missing_srid' WHEN 7 THEN 'non_polygonal_geometry' WHEN 8 THEN 'invalid_geometry'
    WHEN 9 THEN 'invalid_geometry' END AS rejection_reason,
  CASE WHEN c_custkey % 19 NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9) THEN CASE c_custkey % 3
    WHEN 0 THEN 16000000.0 WHEN 1 THEN 14500000.0 ELSE 12000000.0 END END::DOUBLE AS area_m2
  FROM customer""")

add("slice_replace", "", """SELECT o_orderpriority, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT'
  THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice FROM orders""")

add("upsert", """n AS (SELECT o_custkey AS key, max(o_totalprice) AS amount FROM orders
  WHERE o_orderstatus = 'F' GROUP BY 1)""", """SELECT coalesce(n.key, c.c_custkey) AS key,
  CASE WHEN n.key IS NULL THEN c_acctbal ELSE n.amount END AS amount
  FROM customer c FULL JOIN n ON n.key = c.c_custkey""")

add("content_hash", "", """SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes,
  CASE WHEN text = '' THEN 'empty_payload' WHEN regexp_matches(lower(text), '^\\s*(<html|<!doctype html)')
    THEN 'html_payload' END AS payload_problem,
  CASE WHEN lang = 'fr' THEN 'missing' WHEN n_chars > 2000 THEN 'replace' ELSE 'reuse' END AS decision
  FROM documents""")

add("page_payloads", """p AS (SELECT CASE WHEN html = '' THEN 'empty_payload'
  WHEN regexp_matches(lower(html), '^\\s*(<html|<!doctype html)') THEN 'html_payload' END AS payload_problem,
  strlen(html) AS n FROM pages)""", """SELECT payload_problem, count(*) AS page_count,
  CAST(sum(n) AS BIGINT) AS size_bytes FROM p GROUP BY 1""")

add("listing_scan", """t AS (SELECT html || '<a href="2026-08-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || 'T'
    || lpad(CAST(page_id * 5 % 24 AS VARCHAR), 2, '0') || CASE page_id % 2 WHEN 0 THEN '%3A' ELSE ':' END
    || '00/">' AS html FROM pages),
x AS (SELECT DISTINCT unnest(regexp_extract_all(replace(html, '%3A', ':'),
  '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}')) AS run_text FROM t)""",
    """SELECT run_text, strptime(run_text, '%Y-%m-%dT%H:%M') AS run_time_utc FROM x""")

add("alias_match", """layer AS (SELECT DISTINCT 'ns:' || p_name AS name, p_type AS title FROM part),
alias(target, a) AS (VALUES ('gear', 'gear'), ('gear', 'large gear'), ('gear', 'cog'), ('plate', 'plate'),
  ('plate', 'new plate'), ('bolt', 'bolt'), ('bolt', 'red bolt'), ('bolt', 'screw')),
s AS (SELECT target, name, title, sum(CASE
    WHEN regexp_matches(lower(name || ' ' || title), '(^|[^a-z0-9])' || a || '([^a-z0-9]|$)') THEN 10
    WHEN contains(lower(name || ' ' || title), a) THEN 3 ELSE 0 END
    + CASE WHEN split_part(lower(name), ':', -1) = a THEN 10 ELSE 0 END) AS score
  FROM layer, alias GROUP BY ALL HAVING score > 0),
best AS (SELECT target, max(score) AS score FROM s GROUP BY target),
pick AS (SELECT target, score, count(*) AS tied, min(name) AS name FROM s JOIN best USING (target, score)
  GROUP BY ALL),
uses AS (SELECT name, count(*) AS u FROM pick GROUP BY name)""", """SELECT target, name, CAST(score AS BIGINT) AS score, tied AS tied_layers,
  tied = 1 AND u = 1 AS passed FROM pick JOIN uses USING (name)""")
