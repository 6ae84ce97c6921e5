"""Adapters that give the driver's tables the shape of bronze or staging.

All are narrow projections or combining aggregations over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsmedallion.schemas import CATALOGUE, STAGING

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Series of ``obs_daily`` by return flag and line status. RO stays outside the
# default catalogue on purpose.
DAILY_SERIES = {
    "AF": "GDP",
    "AO": "UNRATE",
    "NF": "CPIAUCSL",
    "NO": "DFF",
    "RF": "UMCSENT",
    "RO": "RO",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def obs_events(events: DataFrame, *extra: Column) -> DataFrame:
    """Bronze rows: a series per event type, many vintages per day, dirty text."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    value = (
        F.when(k < 6, ".")
        .when(k == 99, "n/a")
        .otherwise(_money("value").cast("string"))
    )
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        day.alias("realtime_start"),
        day.alias("realtime_end"),
        day.alias("date"),
        value.alias("value"),
        F.col("event_type").alias("series_id"),
        F.concat(F.lit("Series "), "event_type").alias("series_name"),
        F.date_format("ts", ISO_MICROS).alias("ingestion_timestamp"),
        day.alias("ingest_date"),
        *extra,
    )


def obs_daily(lineitem: DataFrame, *extra: Column) -> DataFrame:
    """Bronze rows: six daily series whose observations are revised for a week."""
    pair = F.concat("l_returnflag", "l_linestatus")
    series = F.lit(None).cast("string")
    for code, series_id in DAILY_SERIES.items():
        series = F.when(pair == code, series_id).otherwise(series)
    shipped = F.to_date("l_shipdate")
    # Named first and used below, so that each is computed once per row.
    named = lineitem.withColumns(
        {
            "series_id": series,
            "revised": F.date_add(shipped, F.col("l_linenumber")).cast("string"),
        }
    )
    value = (
        F.when(F.col("l_quantity") == 7, ".")
        .when(F.col("l_quantity") == 23, "n/a")
        .otherwise(_money("l_extendedprice").cast("string"))
    )
    return named.select(
        F.col("revised").alias("realtime_start"),
        F.lit("9999-12-31").alias("realtime_end"),
        shipped.cast("string").alias("date"),
        value.alias("value"),
        "series_id",
        F.concat(F.lit("Series "), "series_id").alias("series_name"),
        F.concat("revised", F.lit("T06:00:00")).alias("ingestion_timestamp"),
        F.col("revised").alias("ingest_date"),
        *extra,
    )


def obs_edges(bronze: DataFrame) -> DataFrame:
    """``obs_daily`` with what a source may send: dates that do not parse or are not
    padded, values that are not finite, rows without a series id, and one age for all
    vintages of a day."""
    day = F.dayofmonth(F.col("date").cast("date"))
    year, month = F.substring("date", 1, 4), F.substring("date", 6, 2).cast("int").cast("string")
    return bronze.withColumns(
        {
            "value": F.when(day == 3, "Infinity").when(day == 4, "NaN").otherwise(F.col("value")),
            "date": F.when(day == 1, F.concat(year, F.lit("-13-01")))
            .when(day == 2, "")
            .when(day < 10, F.concat(year, F.lit("-"), month, F.lit("-"), day.cast("string")))
            .otherwise(F.col("date")),
            "series_id": F.when(day == 28, F.lit(None)).otherwise(F.col("series_id")),
            "realtime_start": F.lit("2000-01-01"),
            "ingestion_timestamp": F.lit("2000-01-02T03:04:05"),
        }
    )


def obs_monthly(orders: DataFrame) -> DataFrame:
    """Staging rows: monthly order totals per priority, one row per month."""
    month = F.trunc("o_orderdate", "month")
    return (
        orders.groupBy(
            F.col("o_orderpriority").alias("series_id"), month.alias("observation_date")
        )
        .agg(
            F.sum(_money("o_totalprice")).cast("double").alias("value"),
            F.max("o_orderdate").cast("timestamp_ntz").alias("ingested_at"),
        )
        .withColumns(
            {
                "series_name": F.concat(F.lit("Priority "), "series_id"),
                "data_as_of_date": F.date_format("observation_date", "yyyy-MM-dd"),
                "transformed_at": F.current_timestamp(),
            }
        )
        .select(*STAGING.names)
    )


def nation_points(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Monthly order totals per customer nation as (date, name, value)."""
    by_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "month").alias("date_key")
    ).agg(F.sum(_money("o_totalprice")).alias("total"))
    return (
        by_customer.join(customer.select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy(
            "date_key",
            F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias(
                "indicator_name"
            ),
        )
        .agg(F.sum("total").cast("double").alias("observation_value"))
    )


def documents(bronze: DataFrame, ingest_date: str | None = None) -> DataFrame:
    """Pack bronze rows into landed JSON documents, one per run, series and page.

    The ``page`` column bounds the rows of a document, as an API response does.
    """
    day = F.col("ingest_date") if ingest_date is None else F.lit(ingest_date)
    return paged(bronze, day).select("ingest_date", "series_id", "observations")


def paged(bronze: DataFrame, day: Column) -> DataFrame:
    """``documents`` with their page."""
    record = F.struct("realtime_start", "realtime_end", "date", "value")
    return bronze.groupBy(day.alias("ingest_date"), "series_id", "page").agg(
        F.collect_list(record).alias("observations")
    )


def land(docs: DataFrame, path: str) -> str:
    """Write documents in the landing layout, one document per line, compressed.

    A compressed file is read back whole by one task; it holds no more than the task had that wrote it.
    """
    docs.write.partitionBy("ingest_date", "series_id").option("ignoreNullFields", False).option(
        "compression", "gzip"
    ).json(path)
    return path


def land_damaged(docs: DataFrame, path: str) -> str:
    """``land``, but with some pages broken off, some of another shape and some that are no JSON."""
    text = F.to_json(F.struct("observations"), {"ignoreNullFields": "false"})
    damaged = (
        F.when(F.col("page") % 5 == 1, F.substring(text, 1, F.length(text) - 9))
        .when(F.col("page") % 5 == 2, F.concat(F.lit('{"observations": "'), F.col("page").cast("string"), F.lit('"}')))
        .when(F.col("page") % 5 == 3, F.concat(F.lit("<html> "), F.col("page").cast("string")))
        .otherwise(text)
    )
    rows = docs.select("ingest_date", "series_id", damaged.alias("value"))
    rows.write.partitionBy("ingest_date", "series_id").text(path)
    return path


def probes(lineitem: DataFrame) -> DataFrame:
    """Questions about ``obs_daily``: a (series, date), and a day from before its first vintage to behind its last."""
    shipped = F.to_date("l_shipdate")
    known = F.date_add(shipped, (F.col("l_partkey") % 12).cast("int") - 2)
    bronze = obs_daily(lineitem, F.col("l_orderkey"), F.col("l_linenumber"), shipped.alias("observation_date"), known.cast("string").alias("known_at"))
    return bronze.select("l_orderkey", "l_linenumber", "series_id", "observation_date", "known_at")


def catalogue_of(bronze: DataFrame) -> DataFrame:
    """A catalogue of the series found, without category and frequency."""
    return (
        bronze.select("series_id", "series_name")
        .distinct()
        .withColumns({c: F.lit(None).cast("string") for c in ("category", "frequency")})
        .select(*CATALOGUE.names)
    )

