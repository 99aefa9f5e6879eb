"""URL filtering against dated lists: each capture meets the entries active when it was fetched.

A list is a log of dated entries. An entry adds or removes a pattern, a host with its subdomains
("example.org") or a host with a path's first part ("example.org/en"). Per list and pattern the
entries become validity intervals, each open until the next entry; the last entry of a day wins,
so a pattern has at most one interval a day. An interval is cut by calendar month, and captures
join on pattern and month with the exact dates as a further condition: an as-of join that
neither sorts a host's captures nor pairs them with all its history.

Of the active entries the longest pattern decides; at equal length "allow" beats "block".

Everything is DataFrame functions. A host with a third of all captures is no problem: captures
are only grouped by themselves, and the interval side is broadcast when counted to be small, else
adaptive execution splits the crowded join partitions.

Defined results: a capture with NULL url, host or fetch date meets no entry and is not blocked;
entries without pattern, date or list are ignored; captures with the same page_id, url and date
are one; empty lists block nothing; an empty capture table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcensus.llm.words import small
from gridcensus.session import cut_lineage

_HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#@]*\]|[^/?#:@\[\]]+)"
_ADDRESS = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"
_PART = r"^[a-z][a-z0-9+.\-]*://[^/?#]+/([^/?#]+)"


def host(url: Column) -> Column:
    """The host in lower case: after the last "@" of the authority, without port and final dots;
    an address in brackets keeps them. NULL if there is none."""
    found = F.regexp_extract(F.lower(url), _HOST, 1)
    return F.nullif(F.regexp_replace(found, r"\.+$", ""), F.lit(""))


def patterns(url: Column) -> Column:
    """Patterns that cover a URL: its host, each parent of two labels or more, host and path part.

    An address has no parents.
    """
    labels = F.split(host(url), r"\.")
    last = F.when(host(url).rlike(_ADDRESS), 1).otherwise(F.greatest(F.size(labels) - 1, F.lit(1)))
    parents = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    part = F.regexp_extract(F.lower(url), _PART, 1)
    paths = F.when(part != "", F.array(F.concat_ws("/", host(url), part))).otherwise(
        F.array().cast("array<string>"))
    return F.concat(parents, paths)


def intervals(entries: DataFrame) -> DataFrame:
    """Entries list, pattern, verdict ("block", "allow" or NULL for a removal), listed_on, seq to
    intervals list, pattern, verdict, valid_from, valid_to (exclusive; NULL while open)."""
    known = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND listed_on IS NOT NULL")
    daily = known.groupBy("list", "pattern", "listed_on").agg(
        F.max(F.struct("seq", "verdict")).alias("_last"))
    following = F.lead("listed_on").over(Window.partitionBy("list", "pattern").orderBy("listed_on"))
    return daily.select(
        "list", "pattern", F.col("_last.verdict").alias("verdict"),
        F.col("listed_on").alias("valid_from"), following.alias("valid_to")).where(
        "verdict IS NOT NULL")


def by_month(spans: DataFrame, until: Column) -> DataFrame:
    """One row per calendar month that an interval touches, up to ``until``."""
    last = F.least(F.coalesce(F.date_sub("valid_to", 1), until), until)
    months = F.when(last >= F.col("valid_from"), F.sequence(
        F.trunc("valid_from", "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH")))
    return spans.withColumn("month", F.explode(months))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched_on of every capture with host, n_active (entries active then),
    decided_by (pattern) and blocked."""
    rows = captures.select("page_id", "url", "fetched_on").distinct()
    latest = captures.agg(F.max("fetched_on")).first()[0]
    spans = cut_lineage(by_month(intervals(entries), F.lit(latest).cast("date")))
    keys = rows.select("page_id", "url", "fetched_on", F.explode(patterns(F.col("url"))).alias(
        "pattern"), F.trunc("fetched_on", "month").alias("month"))
    active = keys.join(small(spans, spans.count()), ["pattern", "month"]).where(
        (F.col("fetched_on") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    rank = F.struct(F.length("pattern").alias("length"), (F.col("verdict") == "allow").alias("allow"),
                    F.col("pattern"))
    same = ["page_id", "url", "fetched_on"]
    none = F.lit(None)
    both = active.select(*same, F.lit(1).alias("_active"), rank.alias("_rank")).unionByName(
        rows.select(*same, F.lit(0).alias("_active"), F.struct(
            none.cast("int").alias("length"), none.cast("boolean").alias("allow"),
            none.cast("string").alias("pattern")).alias("_rank")))
    best = both.groupBy(*same).agg(
        F.sum("_active").alias("n_active"), F.max("_rank").alias("_best"))
    return best.select(
        *same, host(F.col("url")).alias("host"), "n_active",
        F.col("_best.pattern").alias("decided_by"),
        (F.col("n_active") > 0).__and__(~F.coalesce("_best.allow", F.lit(False))).alias("blocked"))


def _number(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 7), 16, 10).cast("int")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch date in 2024, which the table lacks, from a hash of the page id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(
        _number(F.concat(F.lit("fetch:"), F.col("page_id").cast("string"))), F.lit(366))
        ).alias("fetched_on"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A log of dated entries over the hosts, parent domains and host paths of ``pages``.

    Half of the patterns get four entries each in two lists; dates, removals and verdicts follow
    from hashes, so the log grows with the distinct hosts.
    """
    found = pages.select(F.explode(patterns(F.col("url"))).alias("pattern")).distinct().where(
        _number(F.concat(F.lit("listed:"), F.col("pattern"))) % 2 == 0)
    rows = found.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seq"))
    of = lambda name: _number(F.concat(F.lit(name), F.col("seq").cast("string"), F.lit(":"),
                                       F.col("pattern")))
    verdict = F.when(of("verdict") % 4 == 0, "allow").when(of("verdict") % 4 < 3, "block")
    return rows.select(
        F.when(F.col("seq") % 2 == 0, "a").otherwise("b").alias("list"), "pattern",
        verdict.alias("verdict"), F.date_add(F.lit("2023-07-01").cast("date"), F.pmod(
            of("date"), F.lit(540))).alias("listed_on"), "seq")


SQL = r"""
WITH p AS (
  SELECT DISTINCT page_id, url,
    nullif(rtrim(regexp_extract(lower(url),
      '^[a-z][a-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#@]*\]|[^/?#:@\[\]]+)', 1), '.'), '') AS host,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://[^/?#]+/([^/?#]+)', 1) AS part,
    DATE '2024-01-01' + CAST(CAST('0x' || substr(md5('fetch:' || page_id), 1, 7) AS BIGINT) % 366
                             AS INTEGER) AS fetched_on
  FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
k AS (
  SELECT page_id, url, fetched_on, unnest(list_concat(
    list_transform(range(1, CASE WHEN regexp_matches(host, '^(\[.*|[0-9]+(\.[0-9]+){3})$') THEN 1
                                 ELSE greatest(len(labels) - 1, 1) END + 1),
                   lambda i: array_to_string(labels[i:], '.')),
    CASE WHEN part <> '' THEN [host || '/' || part] ELSE [] END)) AS pattern
  FROM l WHERE host IS NOT NULL),
found AS (SELECT DISTINCT pattern FROM k
          WHERE CAST('0x' || substr(md5('listed:' || pattern), 1, 7) AS BIGINT) % 2 = 0),
e AS (
  SELECT CASE WHEN seq % 2 = 0 THEN 'a' ELSE 'b' END AS list, pattern, seq,
    CAST('0x' || substr(md5('verdict' || seq || ':' || pattern), 1, 7) AS BIGINT) % 4 AS v,
    DATE '2023-07-01' + CAST(CAST('0x' || substr(md5('date' || seq || ':' || pattern), 1, 7)
                                  AS BIGINT) % 540 AS INTEGER) AS listed_on
  FROM found, range(4) AS r(seq)),
daily AS (SELECT list, pattern, listed_on, arg_max(v, seq) AS v FROM e GROUP BY ALL),
spans AS (
  SELECT list, pattern, v, listed_on AS valid_from,
    lead(listed_on) OVER (PARTITION BY list, pattern ORDER BY listed_on) AS valid_to
  FROM daily),
active AS (
  SELECT k.*, v = 0 AS allow,
    row_number() OVER (PARTITION BY page_id, url, fetched_on
                       ORDER BY length(pattern) DESC, v = 0 DESC, pattern DESC) AS place,
    count(*) OVER (PARTITION BY page_id, url, fetched_on) AS n
  FROM k JOIN (SELECT * FROM spans WHERE v < 3) USING (pattern)
  WHERE fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to))
SELECT p.page_id, p.url, p.fetched_on, p.host, coalesce(a.n, 0) AS n_active,
  a.pattern AS decided_by, coalesce(NOT a.allow, false) AS blocked
FROM p LEFT JOIN (SELECT * FROM active WHERE place = 1) a
  ON a.page_id = p.page_id AND a.url = p.url
"""
