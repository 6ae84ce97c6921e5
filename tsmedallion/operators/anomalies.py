"""Observations that stand out from those before them, by order statistics that outliers cannot move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import finite
from tsmedallion.operators.staging import current_vintage

ROWS = 30
LEAST_ROWS = 8
THRESHOLD = 3.5
# Fixed value: the median absolute deviation of normal values times this is their standard deviation.
NORMAL = 1.4826


def _median(values: Column) -> Column:
    """Of an ascending array; the mean of the middle two of an even number."""
    n = F.size(values)
    low, high = (F.get(values, F.floor((n + d) / 2).cast("int")) for d in (-1, 0))
    return F.when(n > 0, (low + high) / 2)


def rolling_anomalies(
    staged: DataFrame, rows: int = ROWS, least_rows: int = LEAST_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """Current observations with the median and deviation of the ``rows`` finite ones before.

    ``robust_score`` is the distance from the median in (normalised) median absolute deviations.
    It is NULL with fewer than ``least_rows`` values before, and where all of these are
    equal: there ``is_anomaly`` tells whether the value is another one.

    The window partition has a row per day of a series at most, and a row sees
    ``rows`` values, which are sorted as an array.
    """
    dated = staged.filter(F.col("observation_date").isNotNull() & finite(F.col("value")).isNotNull())
    current = current_vintage(dated.select("series_id", "observation_date", "value", "data_as_of_date", "ingested_at"))
    before = Window.partitionBy("series_id").orderBy("observation_date").rowsBetween(-rows, -1)
    named = current.withColumn("seen", F.array_sort(F.collect_list("value").over(before)))
    named = named.withColumn("median", _median(F.col("seen")))
    away = F.array_sort(F.transform("seen", lambda v: F.abs(v - F.col("median"))))
    named = named.withColumn("deviation", _median(away))
    distance = F.abs(F.col("value") - F.col("median"))
    enough, spread = F.size("seen") >= least_rows, F.col("deviation") > 0
    score = F.when(enough & spread, distance / (F.lit(NORMAL) * F.col("deviation")))
    return named.select(
        F.col("series_id").alias("indicator_id"),
        F.col("observation_date").alias("date_key"),
        F.col("value").alias("observation_value"),
        F.size("seen").alias("n_before"),
        F.col("median").alias("median_before"),
        F.col("deviation").alias("deviation_before"),
        score.alias("robust_score"),
        F.when(~enough, F.lit(False)).when(spread, score > threshold).otherwise(distance > 0).alias("is_anomaly"),
    )
