"""Compare every catalogue query with its SQL: python tests/oracle_check.py [folder] [query ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def arranged(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in any fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def same(left, right) -> bool:
    return left[0] == right[0] and len(left[1]) == len(right[1]) and all(a == b for a, b in zip(left[1], right[1]))


if __name__ == "__main__":
    from parlato.session import build_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in chosen:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            mine = arranged(df.columns, [tuple(row) for row in df.collect()])
        except Exception as error:
            print(f"{name:28} SPARK ERROR {str(error)[:1500]}", flush=True)
            continue
        spent = time.time() - started
        if name not in entry.oracle_sql():
            print(f"{name:28} no SQL, {len(mine[1])} rows {spent:.2f}s", flush=True)
            continue
        started = time.time()
        try:
            theirs = arranged(*sql_rows(con, entry.oracle_sql()[name]))
        except Exception as error:
            print(f"{name:28} SQL ERROR {str(error)[:600]}", flush=True)
            continue
        verdict = "ok" if same(mine, theirs) else "DIFFERS"
        print(f"{name:28} {verdict} {len(mine[1])} rows spark {spent:.2f}s sql {time.time() - started:.2f}s", flush=True)
        if verdict != "ok":
            print("   ", mine[0], theirs[0], len(mine[1]), len(theirs[1]))
            for a, b in [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b][:2]:
                print("    spark", str(a)[:300])
                print("    sql  ", str(b)[:300])
