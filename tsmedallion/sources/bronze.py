"""Bronze: raw text rows, partitioned by run date and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsmedallion.schemas import BRONZE_AT_REST


def write_bronze(bronze: DataFrame, path: str) -> None:
    """Replace only the (run date, series) partitions present in ``bronze``.

    ``rebalance`` lets AQE merge small partitions and split a hot series, so a
    series holding most rows becomes several files of even size.
    """
    (
        bronze.hint("rebalance", "ingest_date", "series_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "series_id")
        .parquet(path)
    )


def run_folder(root: str, ingest_date: str) -> str:
    return f"{root.rstrip('/')}/ingest_date={ingest_date}"


def read_bronze(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """Every run and series under ``path``, without deduplication, or one run,
    of which only the own folder is listed."""
    return (
        spark.read.schema(BRONZE_AT_REST)
        .option("basePath", path)
        .parquet(path if ingest_date is None else run_folder(path, ingest_date))
    )


def audit(bronze: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per expected series: was it ingested, and with how many rows?"""
    counts = bronze.groupBy("series_id").agg(F.count("*").alias("n_rows"))
    return (
        catalogue.select("series_id")
        .join(counts, "series_id", "left")
        .select(
            "series_id",
            F.col("n_rows").isNotNull().alias("found"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        )
    )


def audit_totals(audited: DataFrame) -> DataFrame:
    return audited.agg(
        F.count_if("found").alias("series_found"),
        F.count("*").alias("series_expected"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
    )


def require_any_series(audited: DataFrame) -> dict[str, int]:
    """The audit's totals; raises where not one expected series arrived."""
    totals = audit_totals(audited).first().asDict()
    if totals["series_found"] == 0:
        raise ValueError("no expected series was ingested")
    return totals


def date_range(bronze: DataFrame) -> DataFrame:
    """First and last raw date text per series."""
    return bronze.groupBy("series_id").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count("*").alias("n_rows"),
    )
