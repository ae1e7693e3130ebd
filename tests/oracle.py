"""Compares a query with its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pandas as pd


def _value(v):
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return [_value(x) for x in v]
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 9) if isinstance(v, float) else v


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    return sorted(repr([_value(v) for v in r]) for r in frame.itertuples(index=False))


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def same(spark, query, sql: str, sf_dir: str) -> None:
    found, wanted = query(spark, sf_dir).toPandas(), connection(sf_dir).execute(sql).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)
