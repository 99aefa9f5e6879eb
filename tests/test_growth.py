"""Steps whose work must grow no faster than their tables."""

import contextlib
import io

from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.llm import line_dedup
from gridcensus.operators import skew, spatial, tiling
from gridcensus.plans import contracts, lenses
from gridcensus.session import stored_paths
from gridcensus.sources import zones as zone_files


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Physical Plan ==")[1]


def test_salted_join_computes_its_left_side_once(spark):
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    once = skew.salted_join(left, right, ["k"], "left", ["n"], rows_per_task=50)
    assert "Range" not in plan_of(once)
    twice = skew.salted_join(once, right.withColumnRenamed("v", "w"), ["k"], "left", ["n"])
    assert "Range" not in plan_of(twice)
    counted = {(r["v"], r["w"]): r["n"] for r in twice.groupBy("v", "w").agg(
        F.count("*").alias("n")).collect()}
    assert counted == {("a", "a"): 334, ("b", "b"): 333, (None, None): 333}


def test_lens_rows_are_dealt_over_all_tasks(spark, tmp_path):
    spark.range(40).select(F.col("id").alias("c_custkey"), F.lit(1.5).alias("c_acctbal")).coalesce(
        1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(40).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(
        str(tmp_path / "part.parquet"))
    for lens in (lenses.zones, lenses.raw_population, lenses.raw_zones, lenses.cells):
        found = lens(spark, str(tmp_path))
        assert "REPARTITION_BY_NUM" in plan_of(found), lens.__name__
        assert found.count() == 40


def test_work_on_spread_rows_stays_behind_the_shuffle(spark):
    rows = skew.spread(spark.range(100).select("id"), "id")
    long = rows.withColumn("n", F.length(F.repeat(F.lit("x"), F.col("id").cast("int")))).where("n > 90")
    above, below = plan_of(long).split("REPARTITION_BY_NUM")
    assert "repeat" in above and "repeat" not in below
    assert long.count() == 9


def test_rows_cut_from_geometries_are_not_broadcast(spark):
    f = F.col("id") * 100.0
    square = geom.promote(geom.polygon(geom.rectangle(f, F.lit(0.0), f + 100, F.lit(100.0))))
    zones = spark.range(3).select(F.format_string("%08d", "id").alias("plr_id"),
                                  F.lit("v").alias("geography_version"), square.alias("geometry"))
    cells = spark.range(9).select(F.lit("G").alias("source_grid_id"), F.col("id").cast("int").alias(
        "cell_index"), square.alias("geometry"), F.lit(10000.0).alias("icon_cell_area_m2"))
    mask = spatial.weather_mask(zones, cells, 150, 100.0)
    assert "Broadcast" not in plan_of(mask)
    assert sorted(r["cell_index"] for r in mask.collect()) == [0, 1, 2, 3, 4]
    key = ["plr_id", "geography_version"], ["source_grid_id", "cell_index"]
    assert "Broadcast" not in plan_of(spatial.slab_pairs(zones, cells, *key, 100.0))


def test_a_mask_sends_its_cells_once_and_edges_as_four_numbers(spark):
    def frame(*rings):
        rows = [(f"{i:08d}", "v", [[[(float(x), float(y)) for x, y in ring]]]) for i, ring in enumerate(rings)]
        return spark.createDataFrame(
            rows, "plr_id string, geography_version string, geometry array<array<array<struct<x:double,y:double>>>>")

    # Zones inside a cell and far from its edges, the second without area or outline; one over many
    # cells; none near the last cell.
    zones = frame([(510, 520), (512, 520), (512, 523), (510, 520)], [(1510, 520), (1512, 523), (1510, 520)],
                  [(9000, 0), (13000, 0), (13000, 1000), (9000, 1000), (9000, 0)])
    f = F.col("id") * 1000.0
    cells = spark.range(20).select(F.lit("G").alias("source_grid_id"), F.col("id").cast("int").alias(
        "cell_index"), geom.promote(geom.polygon(geom.rectangle(f, F.lit(0.0), f + 1000, F.lit(1000.0)))
                                    ).alias("geometry"))
    mask = spatial.weather_mask(zones, cells, 100, 1000.0)
    assert plan_of(mask).count("SortMergeJoin") == 2
    assert sorted(r["cell_index"] for r in mask.collect()) == [0, 1, *range(8, 14)]
    index = tiling.tile_index(zones, ["plr_id"], 6000.0)
    assert index.schema["edges"].dataType.elementType.fieldNames() == ["px", "py", "qx", "qy"]


def test_line_dedup_moves_texts_the_same_way_at_every_size(spark):
    run = "\n".join(f"line {i} " + "word " * 12 for i in range(6))
    docs = spark.createDataFrame([(1, run), (2, "other\n" + run), (3, None)], "doc_id long, text string")
    out = line_dedup.cleaned(docs)
    assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {1: 0, 2: 6, 3: 0}


def test_nation_with_many_zones_has_several_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contracts, "DOCUMENT_ZONES", 20)
    spark.range(100).select(F.col("id").alias("c_custkey"), (F.col("id") % 2).alias("c_nationkey")
                            ).write.parquet(str(tmp_path / "customer.parquet"))
    found = contracts.zone_documents(spark, str(tmp_path))
    path = stored_paths()[-1]
    assert sorted(r["feature_count"] for r in found.collect()) == [50, 50]
    documents = spark.read.text(path).groupBy("c_nationkey").count().collect()
    assert all(r["count"] == 5 for r in documents) and len(documents) == 2
    (tmp_path / "bom.geojson").write_bytes(b"\xef\xbb\xbf" + b'{"type":"FeatureCollection",\n"features":'
        b'[{"type":"Feature","properties":{"PLR_ID":"7"},"geometry":{"type":"Polygon",'
        b'"coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    (tmp_path / "broken.geojson").write_text('{"features": [')
    assert zone_files.read_features(spark, str(tmp_path / "broken.geojson")).count() == 0
    feature, = zone_files.read_features(spark, str(tmp_path / "bom.geojson")).collect()
    assert feature["properties"] == {"PLR_ID": "7"} and len(feature["geometry"][0][0]) == 4
