"""Run catalog queries against DuckDB and report differences.

python -m tests.compare [name-prefix ...] ; SF_DIR picks the data folder.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

DEFAULT_DIR = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def oracle(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"date {value}"
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple((type(r[i]).__name__, plain(r[i])) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    names, got = bag(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    onames, want = bag([d[0] for d in cur.description], cur.fetchall())
    if names != onames:
        return [f"columns {names} vs {onames}"]
    if got == want:
        return []
    out = [f"rows {sum(got.values())} vs {sum(want.values())}"]
    out += [f"  only spark : {r}" for r in list((got - want))[:3]]
    out += [f"  only oracle: {r}" for r in list((want - got))[:3]]
    return out


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from fieldcohort.session import local_session, sweep

    folder = os.environ.get("SF_DIR", DEFAULT_DIR)
    shared = tempfile.mkdtemp(prefix="run-")
    spark = local_session("8", shared=f"file://{shared}")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle(folder), entry.oracle_sql(), 0
    for name, func in entry.queries().items():
        if len(sys.argv) > 1 and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        start = time.time()
        try:
            df = func(spark, folder)
            problems = compare(df, con, sqls[name]) if name in sqls else [] if df.count() > 0 else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:900]}"]
        sweep(spark)
        mark = "FAIL" if problems else "ok  " if name in sqls else "rows"
        bad += bool(problems)
        print(f"{mark} {name} {time.time() - start:.1f}s", *problems, sep="\n   " if problems else " ", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
