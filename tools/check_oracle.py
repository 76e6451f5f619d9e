"""Run registered queries on Spark and their SQL twins on DuckDB and compare: python tools/check_oracle.py [sf] [names]."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else round(v, 6) + 0.0)
    if isinstance(v, int):
        return (3, v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (4, v.isoformat())
    return (5, str(v))


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


_KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(spark_df, con, sql: str) -> list[str]:
    """Columns whose type differs between the two engines. (A HUGEINT sum counts as a difference.)"""
    other = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{f.name}: {f.dataType.simpleString()} vs {other.get(f.name)}"
        for f in spark_df.schema
        if _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) != other.get(f.name)
    ]


def compare(spark_df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    types = type_differences(spark_df, con, sql)
    if types:
        return f"types differ: {types}"
    rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    a_cols, a = _normal(spark_df.columns, rows)
    b_cols, b = _normal(names, cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} vs {b_cols}"
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    if not a:
        return "no rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}" if bad else ""


def main() -> int:
    from latewatch.plans import QUERIES, SQL
    from latewatch.runtime import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, SQL[name]) if name in SQL else ("" if df.count() > 0 else "no rows")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        status = "ok " if not problem else "BAD"
        print(f"{status} {name:28s} {time.time() - start:6.2f}s {'' if name in SQL else '(rows only) '}{problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
