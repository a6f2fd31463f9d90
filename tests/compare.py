"""Compare registered queries with their SQL on DuckDB.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def sorted_columns(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """What differs, or an empty string."""
    df = query(spark, sf_dir)
    got_names, got = sorted_columns(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_names, want = sorted_columns(names, result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if not want:
        return "no rows to compare"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"extra {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
        )
    return ""


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if name not in sqls or argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            found = difference(spark, con, query, sqls[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name} {found}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
