"""Bronze to silver: parse, keep the raw text, flag quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import finite, is_missing, parse_date, parse_value, pct_of


def clean(bronze: DataFrame, *also: str, finite_only: bool = False) -> DataFrame:
    """One narrow projection: no shuffle, runs inside the scan's stage.

    The raw text of value and date stays, so that what did not parse can be traced.
    ``also`` names further bronze columns to keep. With ``finite_only`` the texts of
    infinities and NaN are unparseable. An empty series id is NULL, as a folder of that
    name would be read, so that both layouts of silver hold the same rows.
    """
    raw = F.col("value")
    parsed = finite(parse_value(raw)) if finite_only else parse_value(raw)
    return bronze.select(
        F.nullif(F.col("series_id"), F.lit("")).alias("series_id"),
        "series_name",
        parse_date(F.col("date")).alias("observation_date"),
        parsed.alias("value"),
        raw.alias("value_raw"),
        is_missing(raw).alias("is_missing"),
        parsed.isNotNull().alias("is_valid"),
        "realtime_start",
        "realtime_end",
        "ingestion_timestamp",
        F.col("date").alias("date_raw"),
        *also,
    )


def quality_summary(silver: DataFrame) -> DataFrame:
    """Totals and shares in one pass over two flag columns.

    Run it on written silver: the scan then reads only the flags, and the
    numbers stay exact when tasks are retried.
    """
    counts = silver.agg(
        F.count("*").alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if("is_missing").alias("missing_records"),
        F.count_if(~F.col("is_valid") & ~F.col("is_missing")).alias("unparseable_records"),
    )
    return counts.select(
        "*",
        pct_of(F.col("valid_records"), F.col("total_records")).alias("valid_pct"),
        pct_of(F.col("missing_records"), F.col("total_records")).alias("missing_pct"),
    )
