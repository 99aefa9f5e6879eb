import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.operators.verdict import CheckFailed, enforce
from gridcensus.sources import catalogue, manifests, mesh, population, tables, zones


def test_population_file(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_bytes("﻿ZEIT;RAUMID;E_E;E_E65U80;E_E80U110;X\n"
                     "202512;01100101; 100 ;15;;q\n202512;\t;200;20;10;q\n".encode())
    df = population.read_population(spark, str(path))
    rows = df.collect()
    assert df.columns == ["RAUMID", "E_E", "E_E65U80", "E_E80U110", "ZEIT"]
    assert tuple(rows[0]) == ("01100101", "100", "15", None, "202512") and rows[1]["RAUMID"] is None
    raw = population.raw_population(df, "abc", str(path), "2026-04-02", publisher="office")
    assert str(raw.first()["reference_date"]) == "2025-12-31"
    bad = tmp_path / "bad.csv"
    bad.write_text("RAUMID;E_E\nA;1\n")
    with pytest.raises(ValueError, match="missing required columns"):
        population.read_population(spark, str(bad))


def collection(features, crs=None):
    doc = {"type": "FeatureCollection", "features": features}
    if crs:
        doc["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps(doc)


def feature(properties, geometry):
    return {"type": "Feature", "properties": properties, "geometry": geometry}


RING = [[0, 0], [4, 0], [4, 4.5], [0, 0]]


def test_zone_file(spark, tmp_path):
    path = tmp_path / "z.geojson"
    path.write_text(collection([
        feature({"RAUMID": "x", "PLR_ID": " 01 "}, {"type": "Polygon", "coordinates": [RING]}),
        feature({"RAUMID": "y", "PLR_ID": "02"}, {"type": "MultiPolygon", "coordinates": [[RING], [RING]]}),
        feature({"RAUMID": "z", "PLR_ID": "03"}, None),
        feature({"RAUMID": "w", "PLR_ID": "04"}, {"type": "Point", "coordinates": [1, 2]}),
    ], "urn:ogc:def:crs:EPSG::25833"))
    df = zones.read_zones(spark, str(path), "2023-01-01", "sha", "2023-01-01")
    got = {r["plr_id_source"]: r for r in df.withColumn("a", geom.area("geometry")).collect()}
    assert (got["01"]["a"], got["02"]["a"], got["01"]["srid"]) == (9.0, 18.0, 25833)
    assert got["03"]["geometry"] is None and got["04"]["geometry_type"] == "Point"
    assert df.select("source_row_id").distinct().count() == 4
    lines = tmp_path / "z.jsonl"
    lines.write_text("\n".join(json.dumps(feature({"plr": str(i)}, {
        "type": "Polygon", "coordinates": [RING]})) for i in range(3)))
    by_line = zones.read_zones(spark, str(lines), "v", "s", line_delimited=True)
    assert by_line.count() == 3 and by_line.first()["srid"] == 4326


def test_id_column_preference():
    assert zones.find_id_column(["RAUMID", "plr_id"]) == "plr_id"
    with pytest.raises(ValueError):
        zones.find_id_column(["name"])


def matrix(spark, rows):
    return spark.createDataFrame([("G", i, r) for i, r in enumerate(rows)],
                                 "source_grid_id string, row int, indexes array<int>")


def test_connectivity(spark):
    topology, verdict = mesh.topology_rows(matrix(spark, [[1, 2], [2, 4], [3, 3]]), 4)
    enforce(verdict)
    rows = topology.groupBy("cell_index").agg(F.array_sort(F.collect_list(
        F.struct("vertex_order", "vertex_index"))).alias("v")).orderBy("cell_index").collect()
    assert [[p["vertex_index"] for p in r["v"]] for r in rows] == [[0, 1, 2], [1, 3, 2]]
    flat, verdict = mesh.topology_rows(matrix(spark, [[0, 1, 2], [1, 3, 2], [0, 1, 3], [0, 2, 3]]), 4)
    enforce(verdict)
    assert {tuple(r) for r in flat.filter("cell_index = 1").select("vertex_order", "vertex_index")
            .collect()} == {(0, 1), (1, 3), (2, 2)}


@pytest.mark.parametrize("rows,count", [
    ([[0] * 5] * 4, 9), ([[1, 2], [2, 99], [3, 3]], 4), ([[2, 3], [3, 4], [4, 5]], 9),
    ([[-1, 2], [2, 3], [3, 3]], 9), ([[0, 1, 2], [1, 3]], 9)])
def test_bad_connectivity(spark, rows, count):
    with pytest.raises(CheckFailed):
        enforce(mesh.topology_rows(matrix(spark, rows), count)[1])


@pytest.mark.parametrize("unit,lon,want", [
    (None, [math.pi / 2, -math.pi], [90.0, -180.0]), ("degrees", [13.4, 52.0], [13.4, 52.0]),
    ("radian", [10.0, 0.0], [math.degrees(10.0), 0.0]),
    (None, [float("nan"), math.pi], [None, 180.0])])
def test_vertices(spark, unit, lon, want):
    df = spark.createDataFrame([("G", lon, [50.0, 51.0])],
                               "source_grid_id string, longitude array<double>, latitude array<double>")
    got = [r["longitude_deg"] for r in mesh.vertex_rows(df, unit).orderBy("vertex_index").collect()]
    assert [None if math.isnan(g) else g for g in got] == [
        w if w is None else pytest.approx(w) for w in want]
    assert mesh.mesh_lengths(df).first()["passed"]


def test_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    runs = spark.createDataFrame(
        [("A", "2026-08-13 00:00:00", "PT000H00M", 1.0), ("A", "2026-08-13 01:00:00", "PT001H00M", 2.0),
         ("B", "2026-08-13 01:00:00", "PT001H00M", 3.0)],
        "plr_id string, run string, lead_time string, v double").withColumn(
        "run_time_utc", F.to_timestamp("run")).drop("run")
    tables.write_partitions(runs, path)
    tables.write_partitions(runs.filter("plr_id = 'B'").withColumn("v", F.lit(9.0)), path)
    got = tables.read_partitions(spark, path)
    assert sorted((r["plr_id"], r["v"]) for r in got.collect()) == [("A", 1.0), ("B", 9.0)]
    pruned = tables.read_partitions(spark, path, ["20260813T0000"])
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_label" in plan or "run_label" in plan.split(
        "PartitionFilters")[1][:60]
    assert {r["run_label"] for r in tables.latest_label(got).collect()} == {"20260813T0100"}


def test_reload_slice_and_upsert(spark):
    stored = spark.createDataFrame([("s1", "a", 1), ("s1", "b", 2), ("s2", "c", 3)],
                                   "source_sha256 string, k string, v int")
    new = spark.createDataFrame([("s1", "a", 10), ("s3", "d", 4)],
                                "source_sha256 string, k string, v int")
    rows = lambda df: sorted((r["k"], r["v"]) for r in df.collect())
    assert rows(tables.reload_snapshot(stored, new)) == [("a", 10), ("c", 3), ("d", 4)]
    emptied = tables.replace_slice(stored, new.filter("false"), ["source_sha256"],
                                   stored.filter("k = 'c'"))
    assert rows(emptied) == [("a", 1), ("b", 2)]
    assert rows(tables.upsert(stored, new, ["k"])) == [("a", 10), ("b", 2), ("c", 3), ("d", 4)]
    part = tables.upsert_columns(stored, new, ["k"], ["v"])
    assert {(r["k"], r["source_sha256"], r["v"]) for r in part.collect()} == {
        ("a", "s1", 10), ("b", "s1", 2), ("c", "s2", 3), ("d", None, 4)}


def test_bulk_load(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert tables.load_rows(df, ["v", "id"], str(tmp_path / "l")) == 2
    for columns in ([], ["v", "v"], ["nope"]):
        with pytest.raises(ValueError):
            tables.load_columns(df, columns)


def test_summary_has_sorted_keys(spark, tmp_path):
    df = spark.range(1).select(F.lit(1).alias("z"), F.create_map(F.lit("r"), F.lit(2)).alias("a"))
    tables.write_summary(df, str(tmp_path / "s"))
    text = spark.read.text(str(tmp_path / "s")).first()[0]
    assert text == '{"a":{"r":2},"z":1}'


def test_file_manifest_and_reuse(spark, tmp_path):
    (tmp_path / "a.grib2").write_bytes(b"GRIB")
    (tmp_path / "b.grib2").write_bytes(b"")
    (tmp_path / "c.grib2").write_bytes(b" \n<!DOCTYPE HTML><p>")
    seen = manifests.file_manifest(spark, str(tmp_path), "*.grib2")
    listed = spark.createDataFrame([(f"file:{tmp_path}/{n}.grib2",) for n in "abc"], "path string")
    got = {r["path"][-7:]: r for r in manifests.with_expected_files(seen, listed).collect()}
    assert got["a.grib2"]["sha256"] == hashlib.sha256(b"GRIB").hexdigest()
    assert [got[f"{n}.grib2"]["payload_problem"] for n in "abc"] == [
        None, "empty_or_absent", "html_payload"]
    inline = spark.createDataFrame([(bytearray(b""),)], "content binary")
    assert manifests.with_digest(inline).first()["payload_problem"] == "empty_payload"
    schema = ("path string, indicator string, run_time_utc string, lead_time string, "
              "valid_time_utc string, sha256 string")
    kept = spark.createDataFrame([(p, "T_2M", "r", "l", None, "h") for p in "abc"], schema)
    side = spark.createDataFrame([("a", "T_2M", "r", "l", None, "h"), ("b", "T_2M", "r", "l", None, "x")],
                                 schema)
    assert {r["path"]: r["decision"] for r in manifests.reuse_decision(kept, side).collect()} == {
        "a": "reuse", "b": "replace", "c": "missing"}


def test_sidecars_survive_broken_documents(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps({
        "indicator": "T_2M", "run_time_utc": "2026-08-19T12:00:00+00:00", "sha256": "h"}))
    (tmp_path / "bad.json").write_text("{oops")
    rows = manifests.read_sidecars(spark, str(tmp_path)).collect()
    assert sorted(str(r["indicator"]) for r in rows) == ["None", "T_2M"]


def test_listing(spark):
    pages = spark.createDataFrame(
        [('<a href="2026-08-19T12%3A00/">x</a> 2026-08-19T12:00 100%',), ("2026-08-20T00:00",),
         ("2026-13-45T99:99",)], "html string")
    rows = manifests.newest_first(manifests.advertised_runs(pages)).collect()
    assert [r["run_text"] for r in rows if r["run_time_utc"]] == ["2026-08-20T00:00", "2026-08-19T12:00"]


LAYERS = [("lor_2021:a_lor_plr_2021", "Planungsräume"), ("lor_2021:b_lor_bzr_2021", "Bezirksregionen"),
          ("lor_2021:c_lor_pgr_2021", "Prognoseräume")]


def test_layer_match(spark):
    layers = spark.createDataFrame(LAYERS, "name string, title string")
    got = {r["target"]: r for r in catalogue.layer_verdict(catalogue.score_layers(layers)).collect()}
    assert all(r["passed"] for r in got.values())
    assert got["planungsraum"]["name"] == "lor_2021:a_lor_plr_2021"
    twice = layers.union(layers.filter("title = 'Planungsräume'").withColumn("name", F.lit("x:q")))
    tied = spark.createDataFrame([("p", "plr"), ("q", "plr")], "name string, title string")
    judged = {r["target"]: r["passed"] for r in catalogue.layer_verdict(
        catalogue.score_layers(tied)).collect()}
    assert judged == {"planungsraum": False, "prognoseraum": False, "bezirksregion": False}
    assert twice.count() == 4
    one = spark.createDataFrame([("all", "plr bzr pgr")], "name string, title string")
    assert not any(r["passed"] for r in catalogue.layer_verdict(catalogue.score_layers(one)).collect())


def test_points_geojson(spark, tmp_path):
    df = spark.createDataFrame([(7, 13.4, 52.5)], "cell_index int, longitude double, latitude double")
    zones.write_points_geojson(df, str(tmp_path / "g"), ["cell_index"])
    doc = json.loads(spark.read.text(str(tmp_path / "g")).first()[0])
    assert doc["geometry"] == {"type": "Point", "coordinates": [13.4, 52.5]}


def test_payload_mark_behind_any_blanks(spark):
    cases = {b"": "empty_payload", b"<HTML>": "html_payload", b"GRIB" + b" " * 400: None,
             b" \n\t" * 200 + b"<!DocType html>": "html_payload", b" " * 250 + b"<html lang=x>": "html_payload",
             b" " * 255 + b"<htm>": None, b" " * 600: None, b"\xff\xfe<html>": None}
    rows = spark.createDataFrame([(bytearray(c),) for c in cases], "content binary").select(
        "content", manifests.payload_problem(F.col("content")).alias("problem")).collect()
    assert {bytes(r["content"]): r["problem"] for r in rows} == cases


def test_only_changed_files_are_hashed_again(spark, tmp_path):
    import os

    for n in "abc":
        (tmp_path / f"{n}.bin").write_bytes(n.encode() * 5)
        (tmp_path / f"{n}.bin.json").write_text('{"indicator": "T_2M", "sha256": "x"}')
    listed = manifests.incremental_manifest(spark, str(tmp_path), glob="*.bin")
    first = listed.collect()
    known = spark.createDataFrame(first, listed.schema)
    assert len(first) == 3 and all(r["rehashed"] for r in first)
    (tmp_path / "b.bin").write_bytes(b"other")
    (tmp_path / "d.bin").write_bytes(b"new")
    (tmp_path / "c.bin").unlink()
    os.utime(tmp_path / "d.bin", (1, 1))  # older than all others, but unknown
    again = {r["path"][-5:]: r for r in manifests.incremental_manifest(
        spark, str(tmp_path), known, "*.bin").collect()}
    assert {n: r["rehashed"] for n, r in again.items()} == {"a.bin": False, "b.bin": True, "d.bin": True}
    assert again["b.bin"]["sha256"] == hashlib.sha256(b"other").hexdigest()
    same = manifests.incremental_manifest(spark, str(tmp_path), spark.createDataFrame(
        list(again.values()), listed.schema), "*.bin")
    assert same.count() == 3 and same.filter("rehashed").isEmpty()


def test_table_functions_take_parameters(spark):
    from gridcensus.sources.functions import table_function

    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "k int, `odd name` string")
    table_function("rows_above", {"least": "INT", "name": "STRING"}, df, "t.k > least AND NOT t.`odd name` <=> name")
    assert [r["k"] for r in spark.sql("SELECT * FROM rows_above(1, 'c')").collect()] == [2]
    table_function("rows_above", {"least": "INT"}, df, "t.k > least")
    assert spark.sql("SELECT count(*) FROM rows_above(0)").first()[0] == 3
