"""Compare registered queries with their SQL: row count, column names and order-free values.

Run as ``python tests/oracle_check.py SF_DIR [key ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def table_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    rel = con.execute(sql)
    want = table_of([c[0] for c in rel.description], rel.fetchall())
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} against {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}" if wrong else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from shardloom.session import local_session

    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if keys and name not in keys:
            continue
        t = time.time()
        try:
            said = compare(fn(spark, sf_dir), con, sqls[name]) if name in sqls else f"no SQL, {fn(spark, sf_dir).count()} rows"
        except Exception as err:  # noqa: BLE001
            said = f"{type(err).__name__}: {str(err)[:700]}"
        bad += said is not None
        print(f"{name:24s} {time.time() - t:6.1f}s  {said or 'ok'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
