"""Forecast identity: run and lead labels, partition keys, valid times, source addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label formats.
LEAD_PATTERN = r"\APT(\d{3})H(\d{2})M\z"
RUN_TEXT_PATTERN = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}\z"
RUN_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm"
RUN_LABEL_PATTERN = r"\A\d{8}T\d{4}\z"
RUN_LABEL_FORMAT = "yyyyMMdd'T'HHmm"
KEY_SEPARATOR = "|"


def lead_minutes(label: Column) -> Column:
    """Minutes of a ``PTxxxHxxM`` label; other forms and minutes above 59 give NULL."""
    hours = F.regexp_extract(label, LEAD_PATTERN, 1).try_cast("int")
    minutes = F.regexp_extract(label, LEAD_PATTERN, 2).try_cast("int")
    return F.when(label.rlike(LEAD_PATTERN) & (minutes < 60), hours * 60 + minutes)


def lead_label(minutes: Column) -> Column:
    """Canonical label for 0 to 999 h 59 min, else NULL."""
    m = minutes.cast("int")
    hours = F.floor(m / 60).cast("int")
    return F.when(m.between(0, 999 * 60 + 59) & (minutes.cast("double") == m.cast("double")),
                  F.format_string("PT%03dH%02dM", hours, F.pmod(m, F.lit(60))))


def parse_run(text: Column) -> Column:
    """Naive ``YYYY-MM-DDTHH:MM`` text read as UTC."""
    return F.when(text.rlike(RUN_TEXT_PATTERN),
                  F.try_to_timestamp(text, F.lit(RUN_TEXT_FORMAT)))


def parse_run_label(label: Column) -> Column:
    return F.when(label.rlike(RUN_LABEL_PATTERN),
                  F.try_to_timestamp(label, F.lit(RUN_LABEL_FORMAT)))


def run_text(run: Column) -> Column:
    return F.date_format(run, RUN_TEXT_FORMAT)


def run_label(run: Column) -> Column:
    return F.date_format(run, RUN_LABEL_FORMAT)


def is_whole_minute(run: Column) -> Column:
    return run == F.date_trunc("minute", run)


def valid_time(run: Column, lead: Column) -> Column:
    """Run plus lead; a bad lead label or a run with seconds gives NULL."""
    return F.when(is_whole_minute(run), run + F.make_interval(mins=lead_minutes(lead)))


def partition_key(lead: Column, run: Column) -> Column:
    """Two-dimensional key, lead first, as ``lead|run``."""
    return F.concat_ws(KEY_SEPARATOR, lead, run_label(run))


def key_lead(key: Column) -> Column:
    return F.when(_key_is_sound(key), F.split(key, r"\|")[0])


def key_run(key: Column) -> Column:
    return F.when(_key_is_sound(key), parse_run_label(F.split(key, r"\|")[1]))


def _key_is_sound(key: Column) -> Column:
    parts = F.split(key, r"\|")
    return ((F.size(parts) == 2) & lead_minutes(F.get(parts, F.lit(0))).isNotNull()
            & parse_run_label(F.get(parts, F.lit(1))).isNotNull())


def field_address(base: str, indicator: Column, run: Column, lead: Column) -> Column:
    """Address of one field file below ``base``."""
    return F.concat(F.lit(base.rstrip("/") + "/"), indicator, F.lit("/r/"), run_text(run),
                    F.lit("/s/"), lead, F.lit(".grib2"))


def stamp_from_integers(date: Column, time: Column) -> Column:
    """Integer ``YYYYMMDD`` and zero-padded ``HHMM`` to a timestamp; NULL if either is."""
    text = F.concat(date.cast("string"), F.lpad(time.cast("string"), 4, "0"))
    return F.when(text.rlike(r"\A\d{12}\z"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmm")))


def poll_window_open(ts: Column, first: int = 30, last: int = 59) -> Column:
    return F.minute(ts).between(first, last)
