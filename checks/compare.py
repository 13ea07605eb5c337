"""Run every query beside its SQL and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from cardlens.session import session_builder
from checks.queries import QUERIES
from checks.sql import SQL


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name, NULL and NaN alike."""
    frame = frame[sorted(frame.columns)]

    def text(value):
        if value is None or value is pd.NaT or value != value:
            return ""
        if isinstance(value, float):
            return repr(round(value, 9) + 0.0)
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        return str(value)

    columns = [[text(v) for v in frame[c].astype(object)] for c in frame.columns]
    return sorted(zip(*columns))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    for column in spark_frame.columns:
        a, b = spark_frame[column], sql_frame[column]
        floats = pd.api.types.is_float_dtype(a), pd.api.types.is_float_dtype(b)
        if floats[0] != floats[1] and not (a.isna().any() or b.isna().any()):
            return f"type of {column}: {a.dtype} / {b.dtype}"
    a, b = canonical(_unify(spark_frame, sql_frame)), canonical(_unify(sql_frame, spark_frame))
    if len(a) != len(b):
        return f"{len(a)} rows / {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} / {y}"
    return None


def _unify(frame: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers that pandas holds as floats on one side only become floats on both."""
    frame = frame.copy()
    for c in frame.columns:
        if pd.api.types.is_float_dtype(other[c]) and pd.api.types.is_integer_dtype(frame[c]):
            frame[c] = frame[c].astype(float)
    return frame


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        session_builder("compare")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            problem = difference(result, connection.sql(SQL[name]).df())
            rows = len(result)
        except Exception as error:  # report and go on with the next query
            problem, seconds, rows = f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:40} {rows:8} rows {seconds:6.2f}s {problem or ''}",
              flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
