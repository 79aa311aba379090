"""Run registered queries in Spark and in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from glob import glob
from pathlib import Path

import duckdb


def plain(value):
    """One spelling per value for both engines."""
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return repr(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return names, types, cursor.fetchall()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def differences(df, sf_dir: str, sql: str) -> str | None:
    """None when columns, types and all rows agree; else what does not."""
    names, rows = bag(df.columns, df.collect())
    o_names, o_types, raw = oracle_rows(sf_dir, sql)
    o_columns, o_rows = bag(o_names, raw)
    if names != o_columns:
        return f"columns {names} != {o_columns}"
    wrong = [(c, t, o_types[c]) for c, t in df.dtypes if TYPES.get(t) != o_types[c]]
    if wrong:
        return f"types {wrong}"
    if rows != o_rows:
        return (f"rows {sum(rows.values())} != {sum(o_rows.values())}; only spark "
                f"{list((rows - o_rows).items())[:3]}; only oracle {list((o_rows - rows).items())[:3]}")
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from siltbed.session import build_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        start = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = differences(df, sf_dir, ORACLE[name]) if name in ORACLE else f"(rows only: {df.count()})"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.monotonic() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("queries without oracle:", sorted(set(QUERIES) - set(ORACLE)), "oracles without query:", sorted(set(ORACLE) - set(QUERIES)))
    spark.stop()
    sys.exit(bad > 0)
