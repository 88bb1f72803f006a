"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    return str(value)


def counted(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def compare(spark, con, name: str, query, sql: str | None, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if df.columns else "no columns"
    relation = con.sql(sql)
    types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    want_columns = list(relation.columns)
    want = relation.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    odd = [f"{c}: {t} against {types[c]}" for c, t in df.dtypes if KINDS.get(t, t) != types[c]]
    if odd:
        return f"types {odd}"
    have, expect = counted(df.columns, rows), counted(want_columns, want)
    if have != expect:
        return (f"{len(rows)} rows against {len(want)}; only Spark {list((have - expect).items())[:3]}; "
                f"only SQL {list((expect - have).items())[:3]}")
    if not rows:
        return "no rows"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from millrace.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            issue = compare(spark, con, name, query, oracles.get(name), folder)
        except Exception as error:  # report and go on with the next query
            issue = f"{type(error).__name__}: {str(error)[:900]}"
        bad += issue is not None
        mark = "ok  " if issue is None else "BAD "
        print(f"{mark}{name:28s} {time.time() - started:6.2f}s {'' if name in oracles else '(rows only) '}{issue or ''}",
              flush=True)
    spark.stop()
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
