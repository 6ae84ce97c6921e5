"""Silver to staging, and the choice among vintages of one observation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import at

# Age order of the vintages of one (series, date), oldest first, NULL first.
# Rows that agree on all four are copies of each other. The name comes last, so
# that leaving it out, as the fact does, changes no value.
VINTAGE_ORDER = ["data_as_of_date", "ingested_at", "value", "series_name"]

# Rows without a date are numbered from here on, above every day number.
UNDATED = 1 << 40


def stage(silver: DataFrame, transformed_at: datetime | None = None) -> DataFrame:
    """Valid rows with names and types of the staging relation.

    Unsorted on purpose: consumers partition by series, so an order given here
    would only add a range exchange that the next hash exchange undoes.
    """
    return silver.filter("is_valid").select(
        "series_id",
        "series_name",
        "observation_date",
        "value",
        F.col("realtime_start").alias("data_as_of_date"),
        F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingested_at"),
        at(transformed_at).alias("transformed_at"),
    )


def current_vintage(staged: DataFrame) -> DataFrame:
    """The newest vintage of every (series, date); rows without a date all stay.

    A date that does not parse tells nothing about which observation it belongs to, so
    that such rows are no vintages of each other; the ``not_null`` test reports them.

    ``max`` over a struct is combined before the shuffle, so a series or a date
    with any number of vintages sends one row per task. The result has at most
    one dated row per series and calendar day.

    One number is the key beside the series: the day, or for a row without a date a number
    of its own. It comes first because the aggregation sorts by the keys, and a
    number compares as one machine word where a series id is text.
    """
    aged = [c for c in VINTAGE_ORDER if c in staged.columns]
    constant = ["transformed_at"] if "transformed_at" in staged.columns else []
    day = F.unix_date("observation_date").cast("long")
    own = F.lit(UNDATED) + F.monotonically_increasing_id()
    newest = staged.groupBy(F.coalesce(day, own).alias("day"), "series_id").agg(
        F.max(F.struct(*aged)).alias("newest"), *[F.max(c).alias(c) for c in constant]
    )
    date_ = F.when(F.col("day") < UNDATED, F.date_from_unix_date(F.col("day").try_cast("int")))
    found = {c: F.col(f"newest.{c}") for c in aged} | {"observation_date": date_}
    return newest.select(*[found.get(c, F.col(c)).alias(c) for c in staged.columns])


def as_of(staged: DataFrame, day: date | str) -> DataFrame:
    """What was known on ``day``: the newest vintage not younger than it."""
    return current_vintage(staged.filter(F.col("data_as_of_date") <= F.lit(str(day))))
