"""Aggregates over the calendar: every day counts, observed or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import period_start
from tsmedallion.operators.staging import current_vintage

LEVELS = ("month", "quarter", "year")


def time_weighted(staged: DataFrame) -> DataFrame:
    """Per series and month, quarter and year: aggregates over days, gaps filled with the last value.

    An observation holds from its date until the day before the next one, the last for its day
    only; days before the first observation have none. A row without a date holds nowhere.

    The calendar spine is made of months, not days: an observation is put into each month that it
    reaches, with its number of days there, so rows grow with months of gap. All three
    levels come from one pass with grouping sets. A window partition has one row per day of a
    series at most.
    """
    observations = staged.filter(F.col("observation_date").isNotNull()).select(
        "series_id", "observation_date", "value", "data_as_of_date", "ingested_at"
    )
    day, month = F.col("observation_date"), F.col("month")
    by_date = Window.partitionBy("series_id").orderBy("observation_date")
    held = current_vintage(observations).withColumn(
        "until", F.coalesce(F.lead("observation_date").over(by_date), F.date_add(day, 1))
    )
    months = F.sequence(
        period_start(day, "month"), period_start(F.date_sub("until", 1), "month"), F.expr("interval 1 month")
    )
    parts = held.withColumn("month", F.explode(months)).select(
        "series_id",
        month.alias("month"),
        period_start(month, "quarter").alias("quarter"),
        period_start(month, "year").alias("year"),
        "value",
        F.greatest(day, month).alias("since"),
        F.datediff(F.least("until", F.add_months(month, 1).cast("date")), F.greatest(day, month)).alias("days"),
        (period_start(day, "month") == month).cast("long").alias("observed"),
    )
    levels = [[F.col("series_id"), F.col(level)] for level in LEVELS]
    grouped = parts.groupingSets(levels, F.col("series_id"), *(F.col(level) for level in LEVELS)).agg(
        F.grouping_id().alias("level_id"),
        F.sum("days").alias("n_days"),
        F.sum("observed").alias("n_observations"),
        (F.sum(F.col("value") * F.col("days")) / F.sum("days")).alias("mean_value"),
        F.max_by("value", "since").alias("last_value"),
    )
    # In a grouping id the bits of series, month, quarter and year are set where left out.
    level = F.when(F.col("level_id") == 0b0011, "month").when(F.col("level_id") == 0b0101, "quarter").otherwise("year")
    return grouped.select(
        F.col("series_id").alias("indicator_id"),
        level.alias("level"),
        F.coalesce(*LEVELS).alias("period_start"),
        "n_days",
        "n_observations",
        "mean_value",
        "last_value",
    )
