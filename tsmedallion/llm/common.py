"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` made unlike every column of ``df``, so that extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; a null is an empty text."""
    return [x or "" for x in column.to_pylist()]


def runs(lengths: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut rows into ranges of at most ``most`` in total length, or one longer row."""
    start, size, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if i >= start:
        yield start, i + 1


def appended(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` with further columns behind it."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])


def with_columns(batch: pa.RecordBatch, *columns: tuple[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with further columns behind its own."""
    names = [*batch.schema.names, *(n for n, _ in columns)]
    return pa.RecordBatch.from_arrays([*batch.columns, *(c for _, c in columns)], names=names)
