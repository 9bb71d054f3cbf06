"""Compare a query with its SQL on the same tables."""

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def assert_same(got, want) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [sorted((tuple(None if pd.isna(x) else x for x in r) for r in df[columns].itertuples(index=False)), key=repr) for df in (got, want)]
    assert rows[0] == rows[1]
