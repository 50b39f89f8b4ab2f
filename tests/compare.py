"""Run registered queries in Spark and their check SQL in DuckDB, compare rows.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return str(x)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got_names = spark_df.columns
    got = rows_of(got_names, spark_df.collect())
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = rows_of(want_names, cur.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    kinds = {n: KINDS.get(t, t) for n, t in spark_df.dtypes}
    other = {d[0]: str(d[1]) for d in cur.description}
    odd = {n: (kinds[n], other[n]) for n in kinds if kinds[n] != other[n]}
    if odd:
        return f"types {odd}"
    if got != want:
        return f"rows {sum(got.values())} != {sum(want.values())}; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lociflow.scale import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), duck(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            result = difference(df, con, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += result is not None and not result.startswith("no SQL")
        print(f"{name:28s} {time.time() - t:6.2f}s  {result or 'equal'}", flush=True)
    print("bad:", bad)
