"""Run registered queries against their SQL: ``python tests/compare.py SF_DIR [names]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t))


def kinds(rows, width):
    out = []
    for i in range(width):
        out.append({type(r[i]).__name__ for r in rows if r[i] is not None})
    return out


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    columns = sorted(names)
    a, b = kinds(got, len(columns)), kinds(want, len(columns))
    wrong = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
    if wrong:
        return f"types differ: {wrong}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        return f"{len(bad)} rows differ, first {[(c, x, y) for c, x, y in zip(columns, g, w) if x != y]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from gridcensus.session import spark_session

    session = spark_session(
        master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    duck = connect(sf)
    failures = 0
    for query in sys.argv[2:] or queries():
        started = time.time()
        if query not in oracle_sql():
            print(f"none {query}")
            continue
        try:
            found = difference(session, duck, query, sf)
        except Exception as error:  # noqa: BLE001
            found = f"error {str(error)[:700]}"
        failures += found is not None
        print(f"{'FAIL' if found else 'ok'} {query} {time.time() - started:.1f}s {found or ''}",
              flush=True)
    print(f"{failures} failures")
