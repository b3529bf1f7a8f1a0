"""Runs registered queries against their SQL oracles: python tests/compare.py [sf_dir] [name ...]"""

import datetime
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from perennia.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(cores=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
