"""Compare every query with its SQL on one table folder: python tests/check_oracle.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(base: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{base}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    return value


def _type(name: str) -> str:
    names = {
        "bigint": "bigint", "int": "int", "integer": "int", "double": "double", "string": "varchar",
        "varchar": "varchar", "boolean": "boolean", "float": "float", "hugeint": "hugeint",
    }
    return names.get(name.lower(), name.lower())


def compare(spark, connection, query, sql: str, base: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, base)
    names = sorted(df.columns)
    spark_types = {f.name: _type(f.dataType.simpleString()) for f in df.schema.fields}
    got = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    duck_types = {d[0]: _type(str(d[1])) for d in result.description}
    rows = result.fetchall()
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    place = [columns.index(n) for n in names]
    wanted = sorted((tuple(_plain(r[i]) for i in place) for r in rows), key=repr)
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    if got != wanted:
        differing = [(g, w) for g, w in zip(got, wanted) if g != w]
        return f"{len(differing)} rows differ, e.g. {names} {differing[0]}"
    if spark_types != duck_types:
        return f"types differ: { {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]} }"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from modelyard.session import build_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(base), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, connection, query, sqls[name], base)
            else:
                rows = query(spark, base).collect()
                problem = None if rows else "no rows"
                print("   rows only:", len(rows), rows[:2])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
