"""Compare catalogue queries with their SQL on the given tables.

Run as a script to check queries by name: ``python tests/oracle.py <sf_dir> [name …]``.
"""

from __future__ import annotations

import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> list[tuple]:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return columns, rows_of(columns, cur.fetchall())


def check(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    got = spark_rows(df)
    columns, want = oracle_rows(con, sql)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if got != want:
        a, b = set(got), set(want)
        return (
            f"rows {len(got)} vs {len(want)}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}"
        )
    return None


def main() -> None:
    from tradepulse.plans import catalogue
    from tradepulse.session import build_session

    sf_dir = sys.argv[1]
    queries, sqls = catalogue.queries(), catalogue.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        began = time.time()
        try:
            if name in sqls:
                note = check(spark, con, queries[name], sqls[name], sf_dir)
                note = "ok" if note is None else f"DIFF {note}"
            else:
                note = f"rows {queries[name](spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            note = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        print(f"{name}: {note} ({time.time() - began:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
