"""Run registered queries beside their DuckDB twins: python tests/compare.py [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both results are the same, else a short description."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    mine = rows(df.columns, df.collect())
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} against {b}"
    return None


def main() -> int:
    from conftest import session

    from __spark_entry__ import oracle_sql, queries

    sf_dir = "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in sys.argv[1:] or queries():
        if name not in oracle_sql():
            print(f"{name}: no twin")
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name}: {problem or 'equal'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
