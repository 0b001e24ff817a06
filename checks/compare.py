"""Run the registered queries against their SQL: ``python -m checks.compare [sf_dir] [name …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from tidemill.session import local_session

from . import oracle, queries

SF_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, cells as text, rows in order."""

    def cell(v) -> str:
        if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NA:
            return "NULL"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{float(v):.6f}"
        return str(v)

    frame = frame[sorted(frame.columns)]
    frame = pd.DataFrame({c: [cell(v) for v in frame[c].astype(object)] for c in frame.columns})
    return frame.sort_values(list(frame.columns), ignore_index=True)


def compare(spark, connection, sf_dir: str, name: str, sql: str | None) -> str:
    started = time.time()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    took = time.time() - started
    if sql is None:
        return f"rows-only {len(got)} rows, {took:.1f}s"
    want = connection.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} / {len(b)}"
    if not a.equals(b):
        wrong = (a != b).any(axis=1)
        first = wrong.idxmax()
        columns = [c for c in a.columns if a.at[first, c] != b.at[first, c]]
        shown = {c: (a.at[first, c][:200], b.at[first, c][:200]) for c in columns}
        return f"VALUES {int(wrong.sum())} of {len(a)} rows differ, e.g. {dict(a.loc[first].str[:40])}: {shown}"
    return f"ok {len(a)} rows, {took:.1f}s"


def main() -> None:
    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and "/" in arguments[0] else SF_DIR
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), oracle.oracle()
    for name in arguments or queries.QUERIES:
        try:
            result = compare(spark, connection, sf_dir, name, sql.get(name))
        except Exception as problem:
            result = f"FAILED {type(problem).__name__}: {str(problem)[:600]}"
        print(f"{name:28s} {result}", flush=True)


if __name__ == "__main__":
    main()
