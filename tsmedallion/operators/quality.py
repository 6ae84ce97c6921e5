"""Declarative data tests. Each check is a DataFrame of failure counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT = ["test", "table_name", "column_name", "failures"]


def _row(counted: DataFrame, test: str, table: str, column: str) -> DataFrame:
    return counted.select(
        F.lit(test).alias("test"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    )


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULL count of every column, all in one pass."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    )
    return nulls.select(F.inline(per_column)).select(
        F.lit("not_null").alias("test"),
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("failures").cast("bigint").alias("failures"),
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-NULL keys that occur more than once."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("failures"))
    )
    return _row(repeated, "unique", table, column)


def _orphan_count(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key no parent has.

    Child keys are counted first, so that the join sees each key once and a hot
    key costs no more than a rare one.
    """
    keys = child.groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(field).alias("k")).distinct()
    return keys.join(parents, "k", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("failures")
    )


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Rows with a non-NULL key that no parent has."""
    keyed = child.filter(F.col(column).isNotNull())
    return _row(_orphan_count(keyed, column, parent, field), "relationships", table, column)


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows without a parent; a NULL key has none."""
    return _orphan_count(child, column, parent, field).select(
        F.col("failures").alias("orphan_count")
    )


def key_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which any key column is NULL."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.agg(F.count_if(any_null).alias("null_count"))


def in_range(df: DataFrame, table: str, key: str, value: str, bounds: DataFrame) -> DataFrame:
    """Rows whose value lies outside its key's ``min_value`` and ``max_value``.

    A missing bound, and a key without bounds, limits nothing. ``bounds`` has
    one row per key; Catalyst broadcasts it while it is small.
    """
    limits = bounds.select(F.col(key), "min_value", "max_value")
    below = F.coalesce(F.col(value) < F.col("min_value"), F.lit(False))
    above = F.coalesce(F.col(value) > F.col("max_value"), F.lit(False))
    outside = df.select(key, value).join(limits, key).agg(
        F.count_if(below | above).alias("failures")
    )
    return _row(outside, "in_range", table, value)


def run_suite(
    staged: DataFrame, dim_indicators: DataFrame, dim_time: DataFrame, fct: DataFrame
) -> DataFrame:
    """The thirteen data tests of the staging relation and the gold tables."""
    checks = [
        not_null(
            staged,
            "stg_observations",
            ["series_id", "series_name", "observation_date", "value"],
        ),
        not_null(dim_indicators, "dim_indicators", ["indicator_id"]),
        unique(dim_indicators, "dim_indicators", "indicator_id"),
        not_null(dim_time, "dim_time", ["date_key"]),
        unique(dim_time, "dim_time", "date_key"),
        not_null(
            fct, "fct_observations", ["indicator_id", "date_key", "observation_value"]
        ),
        relationships(fct, "fct_observations", "indicator_id", dim_indicators, "indicator_id"),
        relationships(fct, "fct_observations", "date_key", dim_time, "date_key"),
    ]
    return reduce(DataFrame.unionByName, checks).select(*REPORT)


def failed(report: DataFrame) -> list[str]:
    """Failed tests as text; the report has one row per test."""
    return [
        f"{r['test']} {r['table_name']}.{r['column_name']}: {r['failures']} failures"
        for r in report.filter("failures > 0").collect()
    ]

