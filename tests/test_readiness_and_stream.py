import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcensus.operators import readiness
from gridcensus.schemas import INDICATORS
from gridcensus.streaming import completion

OBSERVED = "run_time_utc timestamp, lead_time string, indicator string"
LEADS = ("PT000H00M", "PT001H00M")


def hour(h, day=19):
    return dt.datetime(2026, 8, day, h)


def observed(spark, *missing, runs=(14, 15)):
    return spark.createDataFrame([(hour(r), lead, i) for r in runs for lead in LEADS
                                  for i in INDICATORS if (r, lead, i) not in missing], OBSERVED)


def pending(spark, seen, done=(), runs=(14, 15), **kw):
    listed = spark.createDataFrame([(hour(r),) for r in runs], "run_time_utc timestamp")
    finished = spark.createDataFrame(list(done), "run_time_utc timestamp, lead_time string")
    return readiness.pending_availability(listed, seen, finished, leads=LEADS, **kw)


def ready(p):
    return [(r["run_time_utc"].hour, r["lead_time"]) for r in readiness.ready_set(p).collect()]


def test_missing_indicator_is_named(spark):
    forecasts = spark.createDataFrame([(hour(14), LEADS[0])], "run_time_utc timestamp, lead_time string")
    row = readiness.availability(forecasts, observed(spark, (14, LEADS[0], "U_10M"))).first()
    assert row["missing_indicators"] == ["U_10M"] and not row["complete"]


def test_all_ready_newest_first(spark):
    p = pending(spark, observed(spark))
    assert ready(p) == [(15, LEADS[0]), (15, LEADS[1]), (14, LEADS[0]), (14, LEADS[1])]
    assert readiness.decision(p).first()["checked_forecasts"] == 4


def test_incomplete_newest_does_not_block(spark):
    lost = [(15, lead, "V_10M") for lead in LEADS]
    p = pending(spark, observed(spark, *lost))
    assert ready(p) == [(14, LEADS[0]), (14, LEADS[1])]
    d = readiness.decision(p).first()
    assert (d["latest_incomplete_run"], d["latest_missing_indicators"]) == (hour(15), ["V_10M"])
    assert d["skip_reason"] is None


def test_completed_are_not_checked(spark):
    p = pending(spark, observed(spark, runs=(14,)), [(hour(14), LEADS[0])], runs=(14,))
    assert ready(p) == [(14, LEADS[1])]
    d = readiness.decision(p).first()
    assert (d["already_complete_forecasts"], d["checked_forecasts"]) == (1, 1)


def test_window_and_minimum(spark):
    p = pending(spark, observed(spark, runs=range(5, 16)), runs=range(5, 16), limit=2,
                minimum="2026-08-19 15:00:00")
    assert {r for r, _ in ready(p)} == {15}
    assert {r for r, _ in ready(pending(spark, observed(spark, runs=range(5, 16)),
                                        runs=range(5, 16), limit=3))} == {13, 14, 15}


@pytest.mark.parametrize("seen,done,words", [
    ([], [], "latest incomplete candidate: 20260819T1500 x PT000H00M; missing: T_2M"),
    ([], [(hour(h), lead) for h in (14, 15) for lead in LEADS], "already complete")])
def test_skip_reasons(spark, seen, done, words):
    frame = spark.createDataFrame(seen, OBSERVED)
    assert words in readiness.decision(pending(spark, frame, done)).first()["skip_reason"]


def test_no_candidate(spark):
    p = pending(spark, observed(spark), minimum="2027-01-01 00:00:00")
    assert readiness.decision(p).first()["skip_reason"] == "no eligible forecast candidate"


LOG = "run_time_utc timestamp, lead_time string, status string, ts timestamp"


@pytest.mark.parametrize("statuses,attempt", [
    ([], 1), (["FAILURE"], 2), (["STARTED"], None), (["SUCCESS"], None), (["FAILURE"] * 5, None),
    (["FAILURE"] * 4, 5), (["SUCCESS", "CANCELED"], 3), (["FAILURE", "QUEUED"], None)])
def test_retries(spark, statuses, attempt):
    log = spark.createDataFrame([(hour(12), LEADS[0], s, hour(i)) for i, s in enumerate(statuses)], LOG)
    one = spark.createDataFrame([(hour(12), LEADS[0])], "run_time_utc timestamp, lead_time string")
    rows = readiness.launchable(one, log, "weather").collect()
    assert [r["attempt"] for r in rows] == ([] if attempt is None else [attempt])
    if attempt:
        assert rows[0]["run_key"] == f"weather:20260819T1200:PT000H00M:attempt_{attempt}"
        assert rows[0]["partition_key"] == "PT000H00M|20260819T1200"


def test_calendar(spark):
    cal = readiness.forecast_calendar(spark, "2026-08-13 00:00:00", "2026-08-19 13:00:00")
    assert cal.filter((F.col("run_time_utc") == F.lit(hour(12))) & (
        F.col("lead_time") == "PT000H00M")).count() == 1
    assert cal.filter(F.col("run_time_utc") >= F.lit(hour(13))).count() == 0
    assert cal.count() == (6 * 24 + 13) * 6
    assert readiness.forecast_calendar(spark, "2026-08-13", "2026-08-13").count() == 0


def test_completed_partitions(spark):
    done = readiness.completed_partitions(observed(spark, (15, LEADS[1], "T_2M")))
    assert done.count() == 3


def arrivals(spark, path, per_trigger=1):
    return (spark.readStream.schema(OBSERVED).option("maxFilesPerTrigger", per_trigger)
            .parquet(path))


def land(spark, path, rows):
    """One file per call; the pause keeps file times apart."""
    spark.createDataFrame(rows, OBSERVED).coalesce(1).write.mode("append").parquet(path)


def test_stream_completes_over_batches_with_repeats(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in INDICATORS[:4]:
        land(spark, path, [(hour(14), LEADS[0], i)] * 3 + [(hour(15), LEADS[0], i)])
    land(spark, path, [(hour(14), LEADS[0], "V_10M"), (hour(14), LEADS[0], "OTHER")])
    land(spark, path, [(hour(14), LEADS[0], "V_10M")])
    rows = completion.run_available(arrivals(spark, path), "repeats").collect()
    assert [(r["run_time_utc"], r["lead_time"]) for r in rows] == [(hour(14), LEADS[0])]
    batch = completion.complete_forecasts(completion.completion_state(spark.read.parquet(path)))
    assert [(r["run_time_utc"], r["lead_time"]) for r in batch.collect()] == [(hour(14), LEADS[0])]


def test_stream_drops_late_arrivals(spark, tmp_path):
    import os

    path = str(tmp_path / "late")
    stamp = 1_700_000_000
    seen = set()

    def next_file(rows):
        nonlocal stamp
        land(spark, path, rows)
        for name in os.listdir(path):
            if name.endswith(".parquet") and name not in seen:
                seen.add(name)
                stamp += 60
                os.utime(os.path.join(path, name), (stamp, stamp))

    next_file([(hour(0, 1), LEADS[0], i) for i in INDICATORS[:4]])
    next_file([(hour(0, 20), LEADS[0], i) for i in INDICATORS])
    next_file([(hour(1, 20), LEADS[0], "T_2M")])
    next_file([(hour(0, 1), LEADS[0], "V_10M")])
    rows = completion.run_available(arrivals(spark, path), "late", "2 days").collect()
    assert [r["run_time_utc"] for r in rows] == [hour(0, 20)]


def test_stream_without_arrivals(spark, tmp_path):
    spark.createDataFrame([], OBSERVED).write.parquet(str(tmp_path / "none"))
    assert completion.run_available(arrivals(spark, str(tmp_path / "none")), "none").count() == 0


def test_outcomes_of_arrivals_in_several_batches(spark, tmp_path):
    """Complete, given up, repeated, late and still open forecasts."""
    runs, fields = str(tmp_path / "runs"), str(tmp_path / "fields")
    lead, step = LEADS[0], dt.timedelta(hours=1)
    days = [dt.datetime(2026, 8, d) for d in (1, 2, 3, 9, 20)]

    def arrive(rows):
        spark.createDataFrame(rows, OBSERVED + ", arrived_at timestamp").coalesce(1).write.mode(
            "append").parquet(fields)

    for day in days:
        spark.createDataFrame([(day, lead)], "run_time_utc timestamp, lead_time string").coalesce(
            1).write.mode("append").parquet(runs)
    arrive([(days[0], lead, i, days[0] + step) for i in INDICATORS])
    arrive([(days[0], lead, i, days[0] + step) for i in INDICATORS])          # repeated
    arrive([(days[1], lead, i, days[1] + step) for i in INDICATORS[:3]])
    arrive([(days[1], lead, INDICATORS[3], days[1] + 49 * step),              # too late
            (days[2], lead, "PMSL", days[2] + step)])                         # unknown
    arrive([(days[4], lead, i, days[4] + step) for i in INDICATORS[1:]])
    read = lambda path, schema: spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", 1).parquet(path)
    found = completion.run_outcomes(
        read(runs, "run_time_utc timestamp, lead_time string"),
        read(fields, OBSERVED + ", arrived_at timestamp"))
    got = {r["run_time_utc"]: (r["missing_indicators"], r["complete"]) for r in found.collect()}
    assert got == {days[0]: ([], True), days[1]: (list(INDICATORS[3:]), False),
                   days[2]: (list(INDICATORS), False), days[3]: (list(INDICATORS), False)}
