import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcensus.functions import fields, forecast, geom, projection, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(v):
    return F.lit(v).cast("string") if v is None else F.lit(v)


@pytest.mark.parametrize("raw,number,bad", [
    (" 12 ", 12, False), ("-5", -5, False), ("", None, False), ("   ", None, False),
    (None, None, False), ("n/a", None, True), ("1.5", None, True), ("12\n", None, True),
    ("99999999999999999999", None, True), ("+3", None, True)])
def test_strict_integers(spark, raw, number, bad):
    assert value(spark, text.strict_bigint(lit(raw))) == number
    assert value(spark, F.coalesce(text.is_unparsable(lit(raw)), F.lit(False))) is bad


@pytest.mark.parametrize("raw,number", [("1.5", 1.5), (" 7\t", 7.0), ("x", None), ("NaN", None)])
def test_lenient_numbers(spark, raw, number):
    assert value(spark, text.lenient_number(lit(raw))) == number


@pytest.mark.parametrize("code,end", [
    ("209912", dt.date(2099, 12, 31)), ("202402", dt.date(2024, 2, 29)), ("202413", None),
    ("2024", None), ("20240a", None)])
def test_month_end(spark, code, end):
    assert value(spark, text.month_end(F.lit(code))) == end


@pytest.mark.parametrize("label,minutes", [
    ("PT000H00M", 0), ("PT012H00M", 720), ("PT001H30M", 90), ("12h", None),
    ("PT012H99M", None), ("PT012H00M\n", None)])
def test_lead_labels(spark, label, minutes):
    assert value(spark, forecast.lead_minutes(F.lit(label))) == minutes
    if minutes is not None:
        assert value(spark, forecast.lead_label(F.lit(minutes))) == label


@pytest.mark.parametrize("minutes", [-1, 60000])
def test_lead_out_of_range(spark, minutes):
    assert value(spark, forecast.lead_label(F.lit(minutes))) is None


@pytest.mark.parametrize("lead,valid", [
    ("PT000H00M", "2026-08-19T12:00"), ("PT012H00M", "2026-08-20T00:00")])
def test_forecast_identity(spark, lead, valid):
    run = forecast.parse_run(F.lit("2026-08-19T12:00"))
    assert value(spark, forecast.run_label(run)) == "20260819T1200"
    assert value(spark, forecast.run_text(forecast.valid_time(run, F.lit(lead)))) == valid
    key = forecast.partition_key(F.lit(lead), run)
    assert value(spark, key) == f"{lead}|20260819T1200"
    assert value(spark, forecast.key_lead(key)) == lead
    assert value(spark, forecast.run_text(forecast.key_run(key))) == "2026-08-19T12:00"


def test_runs_with_seconds_have_no_valid_time(spark):
    run = F.to_timestamp(F.lit("2026-08-19 12:00:30"))
    assert value(spark, forecast.valid_time(run, F.lit("PT000H00M"))) is None


@pytest.mark.parametrize("date,time,stamp", [
    (20260819, 0, dt.datetime(2026, 8, 19)), (20260819, 930, dt.datetime(2026, 8, 19, 9, 30)),
    (None, 0, None), (20260819, None, None), (20261319, 0, None)])
def test_integer_stamps(spark, date, time, stamp):
    got = value(spark, forecast.stamp_from_integers(
        F.lit(date).cast("int"), F.lit(time).cast("int")))
    assert (got and got.replace(tzinfo=None)) == stamp


def test_report_text(spark):
    none = F.lit(None).cast("double")
    assert value(spark, text.fixed(F.lit(12.345), 1)) == "12.3"
    assert value(spark, text.thousands(F.lit(3913644))) == "3,913,644"
    assert value(spark, text.percent(F.lit(0.191))) == "19.1%"
    assert [value(spark, f(none)) for f in (text.fixed, text.thousands, text.percent)] == ["NA"] * 3


def test_labels_and_units(spark):
    assert value(spark, text.directory_label(F.lit(" RELHUM_2M "))) == "relhum_2m"
    assert value(spark, text.directory_label(F.lit("a/b"))) is None
    assert value(spark, text.unit_key(F.lit(" m s·-1 "))) == "ms-1"
    assert value(spark, text.epsg_code(F.lit("urn:ogc:def:crs:EPSG::25833"))) == 25833
    assert value(spark, text.ewkt(F.lit(25833), F.lit("POINT(1 2)"))) == "SRID=25833;POINT(1 2)"
    assert value(spark, text.ewkt(F.lit(None).cast("int"), F.lit("POINT(1 2)"))) == "POINT(1 2)"
    assert value(spark, text.transliterate(F.lit("Prognoseräume Straße É"))) == \
        "prognoseraeume strasse e"


@pytest.mark.parametrize("raw,plain", [
    ("a%2Fb%3a", "a/b:"), ("100%", "100%"), ("%%33A", "%3A"), ("", "")])
def test_percent_decoding(spark, raw, plain):
    assert value(spark, text.decode_percent(F.lit(raw))) == plain


@pytest.mark.parametrize("missing,bitmap,kept", [(1, 1, None), (0, 0, 9999.0), (0, 1, 9999.0)])
def test_bitmap_missing(spark, missing, bitmap, kept):
    got = fields.unmark_missing(F.lit(9999.0), F.lit(9999.0), F.lit(missing), F.lit(bitmap))
    assert value(spark, got) == kept
    assert value(spark, fields.unmark_missing(
        F.lit(280.0), F.lit(9999.0), F.lit(missing), F.lit(bitmap))) == 280.0


def square(x, y, side):
    return geom.rectangle(F.lit(x), F.lit(y), F.lit(x + side), F.lit(y + side))


def measured(spark, measure, **geometries):
    """A measure over named geometry columns."""
    df = spark.range(1).select(*[g.alias(n) for n, g in geometries.items()])
    return df.select(measure.alias("v")).first()["v"]


def test_areas_and_centroid(spark):
    holed = geom.promote(geom.polygon(square(0.0, 0.0, 10.0), square(2.0, 2.0, 4.0)))
    assert measured(spark, geom.area("g"), g=holed) == 84.0
    c = measured(spark, geom.centroid("g"), g=holed)
    assert c["x"] == pytest.approx((100 * 5 - 16 * 4) / 84)
    assert measured(spark, geom.bounds("g"), g=holed).asDict() == dict(
        minx=0, miny=0, maxx=10, maxy=10)


def test_split_square(spark):
    """A ten-metre square against rectangles divided at 2.5 m."""
    zone = geom.promote(geom.polygon(square(0.0, 0.0, 10.0)))
    for x0, x1, share in ((0.0, 2.5, 0.25), (2.5, 10.0, 0.75)):
        part = geom.promote(geom.polygon(geom.rectangle(
            F.lit(x0), F.lit(0.0), F.lit(x1), F.lit(10.0))))
        assert measured(spark, geom.overlap_area("z", "p"), z=zone, p=part) / 100 == \
            pytest.approx(share)


def test_distance_and_containment(spark):
    a = geom.promote(geom.polygon(square(0.0, 0.0, 10.0), square(2.0, 2.0, 4.0)))
    b = geom.promote(geom.polygon(square(13.0, 14.0, 2.0)))
    inner = geom.promote(geom.polygon(square(3.0, 3.0, 1.0)))
    assert measured(spark, geom.distance("a", "b"), a=a, b=b) == 5.0
    assert measured(spark, geom.within_distance("a", "b", 5.0), a=a, b=b)
    assert not measured(spark, geom.within_distance("a", "b", 4.999), a=a, b=b)
    assert measured(spark, geom.distance("a", "b"), a=a, b=inner) == 1.0
    for x, inside in ((3.0, False), (2.0, True), (1.0, True)):
        assert measured(spark, geom.contains_or_touches("a", "x", "y"),
                        a=a, x=F.lit(x), y=F.lit(3.0)) is inside


@pytest.mark.parametrize("lon,lat,x,y", [
    (15.0, 0.0, 500000.0, 0.0), (13.40, 52.50, 391390.731, 5817855.241)])
def test_projection_control_points(spark, lon, lat, x, y):
    p = value(spark, projection.to_planar(F.lit(lon), F.lit(lat)))
    assert (p["x"], p["y"]) == (pytest.approx(x, abs=1e-3), pytest.approx(y, abs=1e-3))
    q = value(spark, projection.to_geographic(F.lit(p["x"]), F.lit(p["y"])))
    assert (q["x"], q["y"]) == (pytest.approx(lon, abs=1e-9), pytest.approx(lat, abs=1e-9))
