"""Run registered queries beside their SQL and report differences.

    python tests/oracle_check.py [sf] [key ...]
"""

import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def compare(spark, con, folder, key, build, sql):
    """None if equal, else what differs."""
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    columns = [c[0] for c in res.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, res.fetchall())
    if got == want:
        return None if got else "both empty"
    only_got = sorted(set(got) - set(want))[:3]
    only_want = sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows vs {len(want)}; only spark {only_got}; only sql {only_want}"


def main(sf="0.01", *keys):
    import __spark_entry__ as e
    from rillwork.session import local_session
    spark = local_session("8")
    folder = f"/root/testdata/sf{sf}"
    con = duck(folder)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for key in keys or queries:
        t = time.time()
        try:
            problem = compare(spark, con, folder, key, queries[key], sqls.get(key))
        except Exception:
            problem = traceback.format_exc(limit=3)[-1500:]
        bad += problem is not None
        print(f"{key:28s} {time.time() - t:6.2f}s {'ok' if problem is None else 'BAD ' + problem}"
              f"{'' if sqls.get(key) else ' (rows only)'}", flush=True)
    print(f"{len(keys or queries)} queries, {bad} bad")


if __name__ == "__main__":
    main(*sys.argv[1:])
