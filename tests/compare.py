"""Run a query and its SQL side by side and compare names, types and rows."""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(dtype: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(dtype) else str(dtype)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    ours = result.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    found = {f.name: _plain(f.type) for f in ours.schema}
    wanted = {f.name: _plain(f.type) for f in theirs.schema}
    if found != wanted:
        return [f"schema {sorted(found.items())} is not {sorted(wanted.items())}"]
    a, b = _rows(ours), _rows(theirs)
    if len(a) != len(b):
        return [f"{len(a)} rows, expected {len(b)}"]
    if not a:
        return ["no rows on either side"]
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return [f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0]}"] if wrong else []
