"""Run queries beside their SQL twins: ``python tests/compare.py SF_DIR [names...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value."""
    frame = frame.reindex(sorted(frame.columns), axis=1)
    for name in frame.columns:
        if frame[name].dtype == object:
            frame[name] = frame[name].map(lambda v: None if v is None else str(v))
        elif str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
        if name == "date":
            frame[name] = frame[name].astype(str).str.slice(0, 10)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if the tables hold exactly the same rows."""
    got, want = canonical(got), canonical(want)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for name in got.columns:
        a, b = got[name], want[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            bad = (~same).idxmax()
            return f"{(~same).sum()} values of {name}, first {got.loc[bad].to_dict()} != {want.loc[bad].to_dict()}"
        if a.dtype.kind != b.dtype.kind:
            return f"type of {name}: {a.dtype} != {b.dtype}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from hailgrid.catalog import ORACLES, QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            if name in ORACLES:
                verdict = difference(got, connection.execute(ORACLES[name]).fetch_df())
            else:
                verdict = None if len(got) else "no rows"
            rows = len(got)
        except Exception as error:  # report and go on with the next query
            verdict, rows, spent = f"{type(error).__name__}: {str(error)[:700]}", 0, time.time() - start
        failed += verdict is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{name:26} {kind:4} {rows:7} rows {spent:6.2f}s  {verdict or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
