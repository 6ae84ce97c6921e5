"""The questions asked of gold. Every result stays a lazy DataFrame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import change_label, two_decimals

# Columns of the star result, in display order.
STAR = [
    "indicator_id",
    "indicator_name",
    "date_key",
    "observation_value",
    "yoy_change_pct",
    "year",
    "quarter",
    "month",
]

# Age of a row among rows of the same date: newest is last.
AGE = ["data_as_of_date", "ingested_at", "indicator_id", "observation_value"]


def indicator_list(dim_indicators: DataFrame) -> DataFrame:
    return dim_indicators.orderBy("indicator_id", "indicator_name")


def star(
    fct: DataFrame,
    dim_indicators: DataFrame,
    dim_time: DataFrame,
    indicator_ids: list[str] | None = None,
    with_age: bool = False,
) -> DataFrame:
    """Fact with both dimensions; rows without a dimension row drop out.

    No join hint: Catalyst broadcasts a dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges, where
    AQE splits the partitions of a hot indicator. The id filter reaches the
    fact's partition folders and the dimension scan.
    """
    if indicator_ids is not None:
        if not indicator_ids:
            raise ValueError("select at least one indicator")
        fct = fct.filter(F.col("indicator_id").isin(*indicator_ids))
    joined = fct.join(
        dim_indicators.select("indicator_id", "indicator_name"), "indicator_id"
    ).join(dim_time.select("date_key", "year", "quarter", "month"), "date_key")
    return joined.select(*STAR, *(["data_as_of_date", "ingested_at"] if with_age else []))


def date_bounds(data: DataFrame) -> DataFrame:
    return data.agg(F.min("date_key").alias("min_date"), F.max("date_key").alias("max_date"))


def filter_range(data: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Inclusive on both ends; no filter unless both ends are given."""
    if start is None or end is None:
        return data
    return data.filter(F.col("date_key").between(start, end))


def _vintage(data: DataFrame) -> list[str]:
    """The columns that tell the vintages of a date apart, where ``data`` has them.

    A star over all vintages must be read ``with_age``; over the current ones a date has
    one row, and they change nothing.
    """
    return [c for c in ("data_as_of_date", "ingested_at") if c in data.columns]


def latest_metrics(data: DataFrame) -> DataFrame:
    """Newest vintage of the newest date per indicator, as number and as display text."""
    newest = data.groupBy("indicator_id").agg(
        F.max(
            F.struct(
                "date_key", *_vintage(data), "observation_value", "yoy_change_pct", "indicator_name"
            )
        ).alias("newest")
    )
    return newest.select(
        "indicator_id",
        F.col("newest.indicator_name").alias("indicator_name"),
        F.col("newest.date_key").alias("date_key"),
        F.col("newest.observation_value").alias("latest_value"),
        F.col("newest.yoy_change_pct").alias("latest_yoy"),
        two_decimals(F.col("newest.observation_value")).alias("value_label"),
        change_label(F.col("newest.yoy_change_pct")).alias("change_label"),
    )


def time_series(data: DataFrame) -> DataFrame:
    """Points of every selected line, in drawing order."""
    return data.select(
        "indicator_id", "indicator_name", "date_key", "observation_value"
    ).orderBy("date_key", "indicator_id", "observation_value")


def yoy_series(data: DataFrame) -> DataFrame:
    """Points that have a yearly change; NULL and NaN are left out."""
    return data.select("indicator_id", "indicator_name", "date_key", "yoy_change_pct").na.drop(
        subset=["yoy_change_pct"]
    )


def _last_of(column: str, dtype: str) -> Column:
    """Newest present value; among rows of one age the greatest."""
    present = F.col(column).isNotNull()
    if dtype == "double":
        present = present & ~F.isnan(column)
    aged = F.struct(*AGE, F.col(column).alias("last"))
    return F.max(F.when(present, aged)).getField("last")


def dedupe_last(data: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Last value of each column that is not NULL or NaN, per (date, name).

    ``data`` is the star result ``with_age``. NULL keys are dropped. The
    aggregation combines before its shuffle, so a date with any number of
    vintages sends one row per task.
    """
    columns = columns or [c for c in STAR if c not in ("date_key", "indicator_name")]
    dtypes = dict(data.dtypes)
    return (
        data.filter(F.col("date_key").isNotNull() & F.col("indicator_name").isNotNull())
        .groupBy("date_key", "indicator_name")
        .agg(*[_last_of(c, dtypes[c]).alias(c) for c in columns])
    )


def pivot_wide(deduped: DataFrame, names: dict[str, str]) -> DataFrame:
    """Dates as rows, one column per indicator: ``{name: column alias}``.

    ``deduped`` has one row per (date, name); the names are given, so no job
    is needed to find them, and each becomes one hash-aggregated expression.
    """
    return deduped.groupBy("date_key").agg(
        *[
            F.max(F.when(F.col("indicator_name") == name, F.col("observation_value"))).alias(alias)
            for name, alias in names.items()
        ]
    )


def top_recent(data: DataFrame, n: int = 50) -> DataFrame:
    """The n newest rows, of one date and name the newest vintage first; further ties
    are ordered by every shown column."""
    shown = ["indicator_name", "date_key", "observation_value", "yoy_change_pct"]
    return (
        data.select(*shown, *_vintage(data))
        .orderBy(
            F.col("date_key").desc_nulls_last(),
            F.col("indicator_name").asc_nulls_last(),
            *(F.col(c).desc_nulls_last() for c in _vintage(data)),
            F.col("observation_value").desc_nulls_last(),
            F.col("yoy_change_pct").desc_nulls_last(),
        )
        .limit(n)
        .select(*shown)
    )
