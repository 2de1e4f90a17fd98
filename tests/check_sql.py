"""Compare registered queries with their SQL: python tests/check_sql.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from logweave.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(found[1])} rows, no SQL, {took:.1f}s"
    cursor = con.execute(sql)
    wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if found == wanted:
        return True, f"{len(found[1])} rows, {took:.1f}s"
    if found[0] != wanted[0]:
        return False, f"columns {found[0]} != {wanted[0]}"
    extra = [r for r in found[1] if r not in set(wanted[1])][:3]
    missing = [r for r in wanted[1] if r not in set(found[1])][:3]
    return False, f"{len(found[1])} vs {len(wanted[1])} rows; extra {extra}; missing {missing}"[:900]


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name in args or entry.queries():
        try:
            ok, text = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
