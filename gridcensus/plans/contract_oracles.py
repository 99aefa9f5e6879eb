"""The questions of ``contracts`` in plain SQL; every counter is computed from the tables."""

from __future__ import annotations

from gridcensus.plans.oracles import (_easting, _krueger, _northing, EV, FINAL, LINKS, POP, SHAPES, SPARSE, ZONED)

ORACLES: dict[str, str] = {}


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + select


add("population_source", POP, """SELECT plr_id AS plr_id_source,
  nullif(trim(tt), '') AS population_total_source, nullif(trim(mt), '') AS population_65_79_source,
  nullif(trim(ot), '') AS population_80plus_source, '202512' AS reference_code_source,
  DATE '2025-12-31' AS reference_date, DATE '2026-04-02' AS publication_date,
  'p.csv' AS source_path, repeat('a', 64) AS source_sha256, CAST(NULL AS VARCHAR) AS source_url,
  CAST(NULL AS VARCHAR) AS publisher FROM texts""")

add("zone_source", SHAPES, """SELECT CASE WHEN id % 19 <> 1 THEN plr_id END AS plr_id_source,
  CASE WHEN id % 19 = 7 THEN 'Point' WHEN id % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END
    AS geometry_type, CAST(4326 AS BIGINT) AS srid, 'EPSG:4326' AS source_crs,
  '2023-01-01' AS geography_version, DATE '2023-01-01' AS reference_date,
  CASE WHEN id % 19 <> 7 THEN 1 END::BIGINT AS part_count,
  CASE WHEN id % 19 <> 7 THEN CASE kind WHEN 1 THEN 2 ELSE 1 END END::BIGINT AS ring_count,
  CASE WHEN id % 19 <> 7 THEN 'SRID=4326;POINT(' || printf('%.0f', x) || ' ' || printf('%.0f', y) || ')'
    END AS lower_corner, count(*) AS feature_count,
  CAST(sum(CASE WHEN id % 19 <> 7 THEN CASE kind WHEN 0 THEN 5 WHEN 1 THEN 10 ELSE 7 END END) AS BIGINT)
    AS point_count FROM cut GROUP BY ALL""")

add("mesh_source", """v AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, len(embedding) AS n,
    CAST(unnest(embedding) AS DOUBLE) * CASE vec_id % 2 WHEN 0 THEN 1.0 ELSE 100.0 END AS lon
  FROM embeddings),
w AS (SELECT vec_id, n, lon, CASE WHEN vec_id % 7 <> 0 OR i < n THEN lon / 2 END AS lat FROM v),
s AS (SELECT vec_id, max(abs(lon)) <= 2 * pi() + 0.1 AS turn_lon,
    max(abs(lat)) <= 2 * pi() + 0.1 AS turn_lat FROM w GROUP BY vec_id)""",
    """SELECT vec_id AS source_grid_id, max(n)::BIGINT AS longitude_count,
  (max(n) - CASE WHEN vec_id % 7 = 0 THEN 1 ELSE 0 END)::BIGINT AS latitude_count,
  vec_id % 7 <> 0 AS passed, count(*) AS vertex_count, count(lat) AS latitude_rows,
  round(sum(CASE WHEN turn_lon THEN degrees(lon) ELSE lon END), 6) AS longitude_sum,
  round(min(CASE WHEN turn_lat THEN degrees(lat) ELSE lat END), 6) AS min_latitude,
  round(max(CASE WHEN turn_lat THEN degrees(lat) ELSE lat END), 6) AS max_latitude
  FROM w JOIN s USING (vec_id) GROUP BY vec_id""")

add("mesh_topology", """e AS (SELECT 'E' || vec_id AS g, r, i, i + r + vec_id % 3 AS v, len(embedding) AS known,
    len(embedding) AS width FROM (SELECT *, unnest(range(0, len(embedding))) AS i FROM embeddings),
    (VALUES (0), (1), (2)) AS rs(r)),
c AS (SELECT 'C' || c_nationkey AS g, c_custkey AS r, i, c_custkey * 7 % 10 + c_nationkey % 3 + i AS v,
    0 AS known, 3 AS width FROM customer, (VALUES (0), (1), (2)) AS js(i)),
m AS (SELECT * FROM e UNION ALL SELECT * FROM c),
f AS (SELECT g, count(DISTINCT r) AS row_count, min(width) AS min_width, max(width) AS max_width,
    min(v) AS low, max(v) AS high, max(known) AS known FROM m GROUP BY g),
t AS (SELECT g, CASE WHEN row_count = 3 THEN i ELSE r END AS cell, CASE WHEN row_count = 3 THEN r ELSE i END
    AS ord, v - CASE WHEN low = 1 THEN 1 ELSE 0 END AS vertex, f.known FROM m JOIN f USING (g))""",
    """SELECT g AS source_grid_id, row_count, min_width::BIGINT AS min_width,
  max_width::BIGINT AS max_width, low::BIGINT AS min_index, high::BIGINT AS max_index,
  min_width = max_width AND (row_count = 3 OR max_width = 3) AND low IN (0, 1)
    AND high - CASE WHEN low = 1 THEN 1 ELSE 0 END < 66 AS passed,
  count(*) AS corner_count, sum(cell)::BIGINT AS cell_sum, sum(ord)::BIGINT AS order_sum,
  sum(vertex)::BIGINT AS vertex_sum, count(*) FILTER (vertex >= t.known) AS dangling_count
  FROM t JOIN f USING (g) GROUP BY ALL""")

add("partition_store", SPARSE, """SELECT strftime(run, '%Y%m%dT%H%M') AS run_label, lead_time AS lead_label,
  count(*) AS row_count, round(sum(v * CASE WHEN run = (SELECT max(run) FROM sparse) THEN 2 ELSE 1 END), 4)
    AS value_sum, max(valid) AS valid_time_utc FROM sparse
  WHERE lead_time IN ('PT000H00M', 'PT006H00M') GROUP BY ALL""")

add("snapshot_reload", "", """SELECT sha256(o_orderpriority) AS source_sha256, count(*) AS order_count,
  round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice * 2, 2) ELSE o_totalprice END), 2)
    AS price_sum, (SELECT count(*) FROM orders) AS written_rows FROM orders GROUP BY 1""")

add("column_upsert", """n AS (SELECT o_custkey * 2 AS key, max(o_totalprice) AS amount FROM orders
  WHERE o_orderstatus = 'F' GROUP BY 1)""", """SELECT coalesce(n.key, c.c_custkey) AS key,
  CASE WHEN n.key IS NULL THEN c_acctbal ELSE n.amount END AS amount, c_name AS name
  FROM customer c FULL JOIN n ON n.key = c.c_custkey""")

add("summary_lines", """n AS (SELECT c_nationkey, count(*) AS n, sum(CAST(floor(c_acctbal) AS BIGINT)) AS b,
  min(c_acctbal) AS low, avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END) AS share FROM customer GROUP BY 1)""",
    """SELECT CAST(json_object('balance', format('{:,}', CAST(b AS BIGINT)), 'customers', n,
  'lowest', printf('%.2f', low), 'nation', c_nationkey, 'share',
  CASE WHEN c_nationkey % 5 <> 0 THEN printf('%.8f', share * 100) || '%' ELSE 'NA' END) AS VARCHAR) AS line FROM n""")

add("mandatory_columns", POP, "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) - count({column}) AS null_count, "
    f"count(*) = count({column}) AS passed FROM texts" for name, column in (
        ("plr_id_source", "plr_id"), ("population_total_source", "tt"),
        ("population_65_79_source", "mt"), ("population_80plus_source", "ot"))))

add("additive_columns", "", """SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS DOUBLE) AS amount FROM supplier
  UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer""")

add("zone_contract", """z AS (SELECT CASE c_custkey % 19 WHEN 1 THEN 'missing_plr_id'
    WHEN 2 THEN 'missing_geography_version' WHEN 3 THEN 'duplicate_plr_id' WHEN 4 THEN 'missing_geometry'
    WHEN 5 THEN 'empty_geometry' WHEN 6 THEN 'missing_srid' WHEN 7 THEN 'non_polygonal_geometry'
    WHEN 8 THEN 'invalid_geometry' WHEN 9 THEN 'invalid_geometry' END AS reason,
    CASE WHEN c_custkey % 19 <> 2 THEN '2023-01-01' END AS version, c_custkey AS k FROM customer),
r AS (SELECT reason, count(*) AS n FROM z WHERE reason IS NOT NULL GROUP BY reason)""",
    """SELECT count(reason) + count(*) FILTER (reason IS NULL AND (k % 29 = 0 OR k % 31 = 0)) = 0 AS passed,
  count(*) AS source_row_count, min(version) AS geography_version,
  count(*) FILTER (reason IS NULL) AS normalized_row_count,
  count(*) FILTER (reason IS NULL AND k % 29 = 0) AS invalid_normalized_geometry_count,
  count(*) FILTER (reason IS NULL AND k % 31 = 0) AS wrong_srid_count,
  count(reason) AS rejected_row_count,
  (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM r) AS rejection_reasons FROM z""")

add("cell_contract", """c AS (SELECT p_partkey AS k, p_partkey % 23 AS d, (p_partkey // 2) // 6 * 7 + (p_partkey // 2) % 6 AS b
  FROM part),
q AS (SELECT k, CASE d WHEN 1 THEN 'invalid_vertex_count' WHEN 2 THEN 'repeated_vertex'
    WHEN 3 THEN 'missing_vertex_coordinate' WHEN 4 THEN 'invalid_vertex_coordinate' END AS reason,
    CASE d WHEN 1 THEN 2 ELSE 3 END AS corners FROM c),
r AS (SELECT reason, count(*) AS n FROM q WHERE reason IS NOT NULL GROUP BY reason),
v AS (SELECT count(*) AS n FROM (SELECT b AS v FROM c UNION SELECT b + 1 FROM c UNION SELECT b + 7 FROM c
  UNION SELECT b + 8 FROM c)),
x AS (SELECT (SELECT n FROM v) + count(*) FILTER (d IN (3, 4)) AS vertices FROM c)""",
    """SELECT (SELECT vertices FROM x) = count(*) AND sum(corners) = 3 * count(*) AND count(reason) = 0
    AND count(*) FILTER (reason IS NULL AND (k % 29 IN (0, 5) OR k % 31 = 0)) = 0 AS passed,
  (SELECT vertices FROM x) AS raw_vertex_count, count(*) AS raw_cell_count,
  sum(corners)::BIGINT AS topology_row_count, count(*) FILTER (reason IS NULL) AS normalized_cell_count,
  count(*) FILTER (reason IS NULL AND k % 29 = 0) AS invalid_normalized_geometry_count,
  count(*) FILTER (reason IS NULL AND k % 31 = 0) AS wrong_srid_count,
  count(*) FILTER (reason IS NULL AND k % 29 IN (0, 5)) AS non_triangle_count, count(reason) AS rejected_cell_count,
  (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM r) AS rejection_reasons FROM q""")

WEIGHTS = LINKS + """,
total AS (SELECT plr_id, sum(w) AS total FROM links GROUP BY plr_id),
rows AS (SELECT plr_id, cell, w * 100.0 AS inter, total * 100.0 AS area, w / total AS f, w / 100.0 AS g,
  CAST(plr_id AS BIGINT) % 13 AS d FROM links JOIN total USING (plr_id))"""

add("bridge_contract", WEIGHTS + """,
once AS (SELECT plr_id, d, CASE WHEN d <> 1 THEN cell END AS cell,
  CASE d WHEN 2 THEN 'infinity'::DOUBLE WHEN 3 THEN NULL ELSE inter END AS inter,
  CASE d WHEN 4 THEN -1 ELSE area END AS area, CASE d WHEN 5 THEN 1.5 ELSE f END AS f, g FROM rows),
b AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE d = 6),
sums AS (SELECT plr_id, sum(f) AS s FROM b GROUP BY plr_id),
bad AS (SELECT count(*) FILTER (abs(s - 1) > 1e-5) AS failures, max(abs(s - 1)) AS worst FROM sums),
n AS (SELECT count(*) AS bridge_row_count, count(DISTINCT plr_id) AS plr_count,
  count(DISTINCT cell) AS icon_cell_count, count(*) FILTER (cell IS NULL) AS null_key_count,
  count(*) FILTER (inter IS NULL OR isinf(inter)) AS non_finite_count,
  count(*) FILTER (inter <= 0 OR area <= 0 OR f <= 0 OR g <= 0) AS nonpositive_count,
  count(*) FILTER (f > 1.00001 OR g > 1.00001) AS above_one_count,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT plr_id, cell FROM b)) AS duplicate_pair_count FROM b)""",
    """SELECT bridge_row_count > 0 AND plr_count = (SELECT count(*) FROM customer) AND null_key_count = 0
    AND non_finite_count = 0 AND nonpositive_count = 0 AND above_one_count = 0
    AND duplicate_pair_count = 0 AND failures = 0 AS passed, n.*, failures AS weight_failure_count,
  round(worst, 6) AS max_weight_error FROM n, bad""")


def _described(column: str, expr: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", count(x) AS value_count, round(min(x), 4) AS "min",
  round(median(x), 4) AS median, round(avg(x), 4) AS mean, round(max(x), 4) AS "max",
  round(sum(x), 4) AS "sum", round(stddev_samp(x), 4) AS std
  FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {source}) AS s"""


add("bridge_distribution", WEIGHTS + """,
zone AS (SELECT plr_id, count(DISTINCT cell) AS n, sum(f) AS s, sum(inter) / max(area) AS c
  FROM rows GROUP BY plr_id)""", "\nUNION ALL\n".join(_described(*x) for x in (
    ("intersection_area_m2", "inter", "rows"), ("fraction_of_plr", "f", "rows"),
    ("fraction_of_icon_cell", "g", "rows"), ("icon_cells_used", "n", "zone"),
    ("weight_sum", "s", "zone"), ("coverage_ratio", "c", "zone"))))

add("population_distribution", POP, "\nUNION ALL\n".join(_described(*x, "lenient") for x in (
    ("population_total", "t"), ("population_65_79", "m"), ("population_80plus", "o"),
    ("population_65plus", "s"), ("share_65plus", "share"))))

add("incomplete_population", POP, """SELECT plr_id, m AS population_65_79, o AS population_80plus
  FROM lenient WHERE s IS NULL""")

add("zone_profile", """z AS (SELECT c_custkey % 19 AS d, CASE c_custkey % 19 WHEN 1 THEN '  ' WHEN 3 THEN 'DUP00001'
    ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer)""",
    """SELECT count(*) AS input_feature_count, count(DISTINCT id) AS distinct_plr_id_count,
  count(*) - count(id) AS null_plr_id_count, min(CASE d WHEN 6 THEN 0 ELSE 25833 END)::BIGINT AS first_srid,
  max(CASE d WHEN 6 THEN 0 ELSE 25833 END)::BIGINT AS last_srid,
  count(*) FILTER (d = 4) AS null_geometry_count, count(*) FILTER (d = 5) AS empty_geometry_count,
  count(*) FILTER (d IN (8, 9)) AS invalid_geometry_count,
  count(*) - count(DISTINCT id) AS duplicate_plr_id_count FROM z""")

add("zone_types", "", """SELECT CASE WHEN c_custkey % 19 = 7 THEN 'LINESTRING' ELSE 'MULTIPOLYGON' END
  AS geometry_type, count(*) AS row_count FROM customer GROUP BY 1""")

add("union_share", SHAPES, """SELECT count(*) FILTER (held) AS inside_cell_count, count(*) AS grid_cell_count,
  round(count(*) FILTER (held) / count(*), 6) AS grid_share FROM (SELECT EXISTS (
  SELECT 1 FROM cut z WHERE p.x BETWEEN z.x AND z.x + 4000 AND p.y BETWEEN z.y AND z.y + 4000
    AND NOT (kind = 1 AND p.x > bx0 AND p.x < bx1 AND p.y > by0 AND p.y < by1)
    AND NOT (kind = 2 AND p.x > bx0 AND p.y > by0)) AS held FROM centre p)""")

add("checked_lookup", "", """SELECT o_orderpriority, count(*) AS line_count, round(sum(l_quantity), 2) AS quantity
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")

add("expected_counts", "", """SELECT CAST(n_nationkey AS BIGINT) AS nation, count(s_suppkey) AS supplier_count
  FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 6000 GROUP BY 1""")

add("label_offenders", SPARSE, """SELECT run AS run_time_utc, lead_time, indicator, cell AS cell_index,
  valid AS valid_time_utc FROM sparse WHERE unit <> 'unit'
  ORDER BY run, lead_time, indicator, cell LIMIT 10""")

add("uncovered_bridge_cells", SPARSE + ",\n" + LINKS, """SELECT DISTINCT cell AS cell_index FROM links WHERE cell NOT IN (
  SELECT cell FROM sparse WHERE indicator = 'T_2M' AND v > 90) ORDER BY cell LIMIT 10""")

add("temperature_audit", SPARSE + ",\n" + LINKS + """,
t AS (SELECT run, lead_time, valid, cell, CASE WHEN cell % 11 <> 0 THEN v END AS c,
  CASE WHEN cell % 10 = 0 THEN 2 ELSE 1 END AS copies FROM sparse WHERE indicator = 'T_2M'),
needed AS (SELECT DISTINCT cell FROM links),
held AS (SELECT run, lead_time, valid, count(*) FILTER (copies > 1) AS twice, count(*) AS n,
  sum(copies) FILTER (c IS NULL) AS gaps FROM t WHERE cell IN (SELECT cell FROM needed) GROUP BY ALL),
sums AS (SELECT run, lead_time, valid, plr_id, sum(f * copies) AS s FROM t JOIN weights USING (cell) GROUP BY ALL),
bad AS (SELECT run, lead_time, valid, count(*) FILTER (abs(s - 1) > 1e-6) AS bad FROM sums GROUP BY ALL),
a AS (SELECT run, lead_time, valid, coalesce(twice, 0)::BIGINT AS duplicate_cell_count,
  ((SELECT count(*) FROM needed) - coalesce(n, 0))::BIGINT AS missing_cell_count,
  coalesce(gaps, 0)::BIGINT AS missing_value_count, coalesce(bad, 0)::BIGINT AS bad_weight_count
  FROM (SELECT DISTINCT run, lead_time, valid FROM t) LEFT JOIN held USING (run, lead_time, valid)
  LEFT JOIN bad USING (run, lead_time, valid))""",
    """SELECT run AS run_time_utc, lead_time, valid AS valid_time_utc, duplicate_cell_count, missing_cell_count,
  missing_value_count, bad_weight_count, duplicate_cell_count = 0 AND missing_cell_count = 0
    AND missing_value_count = 0 AND bad_weight_count = 0 AS passed FROM a""")

add("current_mask", "", """SELECT '2023-01-01' AS geography_version, 'G1' AS source_grid_id,
  CAST(5000 AS BIGINT) AS mask_buffer_m, p_partkey AS cell_index FROM part
  WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0""")

CURRENT = FINAL + """,
current AS (SELECT * FROM final WHERE run = (SELECT max(run) FROM final))"""

add("exposure_header", CURRENT, """SELECT count(*) AS row_count, count(DISTINCT plr_id) AS unique_plr_count,
  count(*) FILTER (status = 'available') AS available_count,
  count(*) FILTER (status = 'rejected_source_record') AS rejected_count,
  strftime(min(run), '%Y-%m-%d %H:%M') AS run_time_utc, strftime(min(run), '%Y-%m-%d %H:%M') AS valid_time_utc,
  'PT000H00M' AS lead_time, count(DISTINCT run) = 1 AS passed FROM current""")

add("exposure_exceptions", CURRENT, """SELECT plr_id, status AS population_status,
  reason AS population_rejection_reason FROM current WHERE status <> 'available'""")

add("exposure_table", CURRENT, """SELECT row_number() OVER (ORDER BY round(t, 6) DESC NULLS LAST, plr_id) AS rank, plr_id,
  coalesce(printf('%.1f', round(t, 6)), 'NA') AS temperature_c, coalesce(printf('%.1f', rh), 'NA') AS relative_humidity_percent,
  coalesce(format('{:,}', CAST(total AS BIGINT)), 'NA') AS population_total,
  coalesce(format('{:,}', CAST(senior AS BIGINT)), 'NA') AS population_65plus,
  coalesce(printf('%.1f', share * 100) || '%', 'NA') AS share_65plus, status AS population_status
  FROM current ORDER BY rank LIMIT 10""")

add("seeded_exposure_checks", CURRENT + """,
s AS (SELECT plr_id, CAST(plr_id AS BIGINT) % 29 AS d, senior, share,
    CASE CAST(plr_id AS BIGINT) % 29 WHEN 2 THEN 'unknown' ELSE status END AS status,
    CASE WHEN CAST(plr_id AS BIGINT) % 29 <> 3 THEN reason END AS reason,
    CASE CAST(plr_id AS BIGINT) % 29 WHEN 4 THEN 1 WHEN 5 THEN NULL ELSE total END AS total
  FROM current WHERE CAST(plr_id AS BIGINT) % 29 <> 1),
registry AS (SELECT plr_id, CAST(plr_id AS BIGINT) % 29 AS d FROM pop WHERE reason IS NOT NULL),
accepted AS (SELECT plr_id FROM pop WHERE reason IS NULL AND CAST(plr_id AS BIGINT) % 29 <> 7),
known AS (SELECT plr_id FROM registry WHERE d <> 8),
unmatched AS (SELECT DISTINCT plr_id FROM s WHERE plr_id NOT IN (SELECT plr_id FROM accepted)),
refused AS (SELECT DISTINCT plr_id FROM s WHERE status = 'rejected_source_record'),
c AS (SELECT count(*) AS row_count, count(*) - count(plr_id) AS missing_plr_ids,
  count(*) FILTER (status = 'available') AS available_count,
  count(*) FILTER (status = 'rejected_source_record') AS final_rejected_count,
  count(*) FILTER (status NOT IN ('available', 'rejected_source_record')) AS bad_status_count,
  count(*) FILTER (status = 'available' AND (total IS NULL OR senior IS NULL OR share IS NULL))
    AS available_incomplete_count,
  count(*) FILTER (status = 'rejected_source_record' AND (total IS NOT NULL OR senior IS NOT NULL
    OR share IS NOT NULL)) AS rejected_with_metrics_count,
  count(*) FILTER (status = 'rejected_source_record' AND reason IS NULL) AS rejected_without_reason_count,
  (SELECT count(*) FROM registry) AS registry_rejected_count,
  (SELECT count(*) FROM refused WHERE plr_id NOT IN (SELECT plr_id FROM registry))
    + (SELECT count(*) FROM registry WHERE plr_id NOT IN (SELECT plr_id FROM refused))
    AS registry_difference_count,
  (SELECT count(*) FROM unmatched) AS unmatched_key_count,
  (SELECT count(*) FROM unmatched WHERE plr_id NOT IN (SELECT plr_id FROM known)) AS unexplained_key_count,
  (SELECT count(*) FROM known WHERE plr_id NOT IN (SELECT plr_id FROM unmatched)) AS unused_registry_key_count,
  count(DISTINCT d = 6) AS identity_groups, count(*) FILTER (d = 6) = 0 AS identity_passed FROM s)""",
    """SELECT c.*, row_count = (SELECT count(*) FROM customer) AND missing_plr_ids = 0 AS coverage_passed,
  bad_status_count = 0 AND available_incomplete_count = 0 AND rejected_with_metrics_count = 0
    AND rejected_without_reason_count = 0 AND registry_difference_count = 0 AS passed,
  unexplained_key_count = 0 AND unused_registry_key_count = 0 AS explained_passed FROM c""")

add("seeded_bridge_check", WEIGHTS + """,
two AS (SELECT '2021-01-01' AS version, plr_id, cell, inter, area, f, g FROM rows UNION ALL
  SELECT '2023-01-01', CASE d WHEN 4 THEN 'X' || plr_id ELSE plr_id END,
    CASE d WHEN 5 THEN cell + 1000000000 ELSE cell END, CASE d WHEN 6 THEN 0 ELSE inter END, area,
    CASE d WHEN 2 THEN f / 2 WHEN 3 THEN -0.5 ELSE f END, g FROM rows WHERE d <> 1),
ids AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS plr_id FROM customer),
sums AS (SELECT version, plr_id, sum(f) AS s FROM two GROUP BY ALL),
off AS (SELECT version, count(*) FILTER (abs(s - 1) > 1e-6) AS plr_weight_failure_count,
  round(max(abs(s - 1)), 6) AS max_plr_weight_error FROM sums GROUP BY version),
lost AS (SELECT version, count(*) AS n FROM (SELECT DISTINCT version FROM two), ids
  WHERE (version, plr_id) NOT IN (SELECT version, plr_id FROM two) GROUP BY version),
c AS (SELECT version, count(*) AS bridge_row_count, count(DISTINCT plr_id) AS represented_plr_count,
  count(DISTINCT cell) AS represented_icon_cell_count, (SELECT count(*) FROM ids) AS source_plr_count,
  count(*) FILTER (plr_id NOT IN (SELECT plr_id FROM ids)) AS orphan_plr_count,
  count(*) FILTER (cell > (SELECT max(user_id) FROM events)) AS orphan_icon_cell_count,
  count(*) FILTER (inter <= 0 OR area <= 0) AS nonpositive_area_count,
  count(*) FILTER (f <= 0 OR f > 1.000001 OR g <= 0 OR g > 1.000001) AS invalid_fraction_count
  FROM two GROUP BY version)""", """SELECT c.* EXCLUDE (version), version AS geography_version,
  coalesce(n, 0) AS missing_plr_count, plr_weight_failure_count, max_plr_weight_error,
  coalesce(n, 0) = 0 AND orphan_plr_count = 0 AND orphan_icon_cell_count = 0 AND nonpositive_area_count = 0
    AND invalid_fraction_count = 0 AND plr_weight_failure_count = 0
    AND represented_plr_count = source_plr_count AS passed
  FROM c JOIN off USING (version) LEFT JOIN lost USING (version)""")

add("seeded_mask_check", LINKS + """,
grid AS (SELECT unnest(range(0, (SELECT max(user_id) + 1 FROM events))) AS cell),
masks AS (SELECT 5000 AS buffer, cell FROM grid UNION ALL SELECT 3000, cell FROM grid WHERE cell % 9 <> 0
  UNION ALL SELECT 3000, -1 - cell FROM grid WHERE cell % 4 = 1),
needed AS (SELECT DISTINCT cell FROM links),
c AS (SELECT buffer, count(*) AS mask_cell_count, (SELECT count(*) FROM customer) AS source_plr_count,
  (SELECT count(*) FROM needed) AS bridge_cell_count,
  (SELECT count(*) FROM needed) - count(*) FILTER (cell IN (SELECT cell FROM needed)) AS missing_bridge_cell_count,
  count(*) FILTER (cell NOT IN (SELECT cell FROM grid)) AS orphan_mask_cell_count FROM masks GROUP BY buffer)""",
    """SELECT c.* EXCLUDE (buffer), CAST(buffer AS BIGINT) AS mask_buffer_m,
  mask_cell_count >= bridge_cell_count AND missing_bridge_cell_count = 0 AND orphan_mask_cell_count = 0 AS passed
  FROM c""")

add("seeded_accounting", POP + """,
s AS (SELECT plr_id, reason, CAST(plr_id AS BIGINT) % 23 AS d FROM pop),
yes AS (SELECT plr_id FROM s WHERE reason IS NULL AND d <> 1),
no AS (SELECT plr_id FROM s WHERE reason IS NOT NULL OR d = 2 UNION ALL
  SELECT 'X' || plr_id FROM s WHERE reason IS NULL AND d = 3),
c AS (SELECT (SELECT count(*) FROM s) AS source_row_count, (SELECT count(*) FROM yes) AS accepted_row_count,
  (SELECT count(*) FROM no) AS rejected_row_count,
  (SELECT count(*) FROM (SELECT plr_id FROM yes INTERSECT SELECT plr_id FROM no)) AS accepted_rejected_overlap,
  (SELECT count(*) FROM s WHERE plr_id NOT IN (SELECT plr_id FROM yes UNION ALL SELECT plr_id FROM no))
    + (SELECT count(*) FROM no WHERE plr_id NOT IN (SELECT plr_id FROM s)) AS key_difference_count)""",
    """SELECT c.*, source_row_count = accepted_row_count + rejected_row_count AND accepted_rejected_overlap = 0
    AND key_difference_count = 0 AND source_row_count > 0 AS passed FROM c""")

_KNOWN = """CASE WHEN run = (SELECT min(run) FROM runs) OR run = (SELECT max(run) FROM runs)
  AND plr_id IN (SELECT plr_id FROM links WHERE cell % 50 = 3) THEN NULL ELSE {} END"""

add("incomplete_forecasts", ZONED, "SELECT plr_id, run AS run_time_utc, 'PT000H00M' AS lead_time, "
    "run AS valid_time_utc, " + ", ".join(
        f"round({_KNOWN.format(short)}, 6) AS {name}" for short, name in (
            ("t", "temperature_c"), ("rh", "relative_humidity_percent"),
            ("td", "dew_point_temperature_c"), ("u", "wind_u_10m_ms"), ("v", "wind_v_10m_ms"),
            ("ws", "wind_speed_10m_ms"))) + " FROM zoned")

add("sql_functions", SPARSE + ",\n" + LINKS + ",\n" + POP + """,
z AS (SELECT plr_id, count(DISTINCT cell) AS n FROM links GROUP BY plr_id),
f AS (SELECT run, lead_time, count(*) AS n, count(DISTINCT indicator) AS kinds FROM sparse GROUP BY ALL)""",
    """SELECT 'population' AS kind, reason AS label, count(*) AS row_count FROM pop
  WHERE reason IN ('zero_population_total', 'invalid_population_65plus') GROUP BY reason
UNION ALL SELECT 'bridge', CAST(n AS VARCHAR), count(*) FROM z WHERE n >= 2 GROUP BY n
UNION ALL SELECT 'forecast', lead_time, CAST(sum(n) AS BIGINT) FROM f WHERE lead_time = 'PT002H00M' GROUP BY 2
UNION ALL SELECT 'lacking', lead_time, count(*) FROM f WHERE lead_time = 'PT006H00M' AND kinds < 5 GROUP BY 2""")

add("stream_outcomes", EV + """,
came AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS run, lead_time, indicator,
    ts + to_hours(CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 30 + event_id % 40 END AS INTEGER)) AS arrived
  FROM ev WHERE value > 20),
expected AS (SELECT DISTINCT run, l.lead_time FROM came, leads l),
mark AS (SELECT least(max(run), max(arrived)) - INTERVAL 30 MINUTE AS w FROM came),
want(o, indicator) AS (VALUES (0, 'T_2M'), (1, 'RELHUM_2M'), (2, 'TD_2M'), (3, 'U_10M'), (4, 'V_10M')),
seen AS (SELECT DISTINCT run, lead_time, indicator FROM came
  WHERE arrived >= run AND arrived <= run + INTERVAL 48 HOUR),
judged AS (SELECT e.run, e.lead_time, string_agg(w.indicator, ',' ORDER BY o) FILTER (s.indicator IS NULL) AS miss
  FROM expected e CROSS JOIN want w LEFT JOIN seen s
    ON s.run = e.run AND s.lead_time = e.lead_time AND s.indicator = w.indicator GROUP BY ALL)""",
    """SELECT run AS run_time_utc, lead_time, coalesce(miss, '') AS missing_indicators, miss IS NULL AS complete
  FROM judged, mark WHERE miss IS NULL OR run + INTERVAL 48 HOUR < w""")

add("zone_interiors", """rings(kind, ring, points) AS (VALUES
  (0, 's', ['l']), (0, 'a', ['l']), (1, 's', ['l', 'r']), (1, 'a', ['l', 'r']),
  (2, 's', ['l', 'r']), (2, 'a', ['l', 'm']), (2, 'b', ['m', 'r']),
  (3, 's', ['l']), (3, 'a', ['l', 'm']), (3, 'b', ['m'])),
ends AS (SELECT kind, ring, unnest(points) AS point FROM rings),
graph AS (SELECT kind, count(*) AS ends, count(DISTINCT ring) + count(DISTINCT point) AS corners
  FROM ends GROUP BY kind)""", """SELECT c_custkey, coalesce(ends >= corners, false) AS is_invalid
  FROM customer LEFT JOIN graph ON kind = c_custkey % 5""")

add("zone_neighbours", SHAPES, """SELECT a.plr_id, count(b.id) AS neighbour_count FROM zone a LEFT JOIN zone b
  ON a.id <> b.id AND abs(a.x - b.x) <= 4000 AND abs(a.y - b.y) <= 4000
    AND NOT (a.kind = 2 AND b.x > a.x AND b.y > a.y) AND NOT (b.kind = 2 AND a.x > b.x AND a.y > b.y)
  GROUP BY a.plr_id""")

add("zone_documents", SHAPES, """SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'urn:ogc:def:crs:EPSG::25833'
    ELSE 'EPSG:4326' END AS source_crs,
  CASE WHEN c_nationkey % 2 = 0 THEN 25833 ELSE 4326 END::BIGINT AS srid, 'MultiPolygon' AS geometry_type,
  count(*) AS feature_count, count(DISTINCT plr_id) AS zone_count, round(sum(area), 1) AS area_m2
  FROM cut JOIN customer ON c_custkey = id GROUP BY ALL""")

add("lenient_preconditions", POP + """,
n AS (SELECT count(*) AS source_row_count, count(DISTINCT id) AS distinct_plr_count,
  count(*) - count(id) AS blank_plr_count,
  count(*) FILTER (reason IS NULL AND (t IS NULL OR s IS NULL OR share IS NULL)) AS accepted_missing_count
  FROM (SELECT *, CASE WHEN CAST(plr_id AS BIGINT) % 41 = 0 THEN '7'
    WHEN CAST(plr_id AS BIGINT) % 43 <> 1 THEN plr_id END AS id FROM lenient))""",
    """SELECT *, blank_plr_count = 0 AND accepted_missing_count = 0
  AND distinct_plr_count + blank_plr_count = source_row_count AS passed FROM n""")

add("bridge_counters", LINKS + """,
b AS (SELECT plr_id, CAST(plr_id AS BIGINT) % 13 AS d, CASE WHEN CAST(plr_id AS BIGINT) % 13 <> 1 THEN cell END
    AS cell, w, sum(w) OVER (PARTITION BY plr_id) AS total FROM links),
x AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE d = 6),
r AS (SELECT plr_id, sum(CASE d WHEN 5 THEN 1.5 ELSE 1.0 END * w / total) AS weight,
  sum(w) / max(CASE WHEN d <> 2 THEN total END) AS cover FROM x GROUP BY plr_id)""",
    """SELECT count(*) AS row_count, count(DISTINCT plr_id) AS distinct_plr_count,
  count(DISTINCT cell) AS distinct_icon_cell_count, count(*) - count(plr_id) AS plr_id_null_count,
  count(*) - count(cell) AS cell_index_null_count, count(*) - count(w) AS intersection_area_m2_null_count,
  count(*) FILTER (d = 2) AS plr_area_m2_null_count, count(*) - count(w) AS icon_cell_area_m2_null_count,
  count(*) - count(w) AS fraction_of_plr_null_count, count(*) - count(w) AS fraction_of_icon_cell_null_count,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT plr_id, cell FROM x)) AS duplicate_plr_cell_pair_count,
  (SELECT round(max(abs(weight - 1)), 6) FROM r) AS max_weight_error,
  (SELECT round(max(abs(cover - 1)), 6) FROM r) AS max_coverage_error FROM x""")

add("binary_manifest", """f AS (SELECT doc_id // 500 AS file, string_agg(
    CASE WHEN doc_id // 500 % 5 = 3 THEN 'x' ELSE '' END || coalesce(text, '') || chr(10), ''
    ORDER BY doc_id) AS content FROM documents GROUP BY 1)""", """SELECT file, strlen(content) AS size_bytes,
  sha256(content) AS sha256, file % 5 = 3 AS rehashed,
  CASE WHEN file % 5 = 3 THEN 'replace' ELSE 'reuse' END AS decision FROM f""")

add("reproject_systems", f"""p AS (SELECT s_suppkey, 12.0::DOUBLE + s_suppkey % 50 * 0.05 AS lon,
    (s_suppkey // 50 % 400 * 0.05 + 1.0::DOUBLE) * CASE s_suppkey % 4 WHEN 0 THEN 1 ELSE -1 END AS lat
  FROM supplier),
a AS (SELECT *, {_krueger('lon', 'lat')[0]} AS xi, {_krueger('lon', 'lat')[1]} AS eta FROM p)""",
    f"""SELECT s_suppkey, [3857, 32733, 32734, 2056][s_suppkey % 4 + 1]::BIGINT AS srid, s_suppkey % 4 <> 3 AS is_supported,
  CASE WHEN s_suppkey % 4 <> 3 THEN round({_easting()}, 3) END AS x,
  CASE WHEN s_suppkey % 4 <> 3 THEN round({_northing()}, 3) END AS y FROM a""")
