"""Silver as a file stream, and the gold refresh of touched series.

Cleaning is stateless, so it streams. LAG needs a series' order, which a stream
has not, so gold is refreshed in batches for the series that got new rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tsmedallion.operators import marts, silver
from tsmedallion.schemas import BRONZE_AT_REST
from tsmedallion.session import materialise, scratch_scope
from tsmedallion.sources.bronze import read_bronze
from tsmedallion.sources.tables import replace_series, write_gold

PARTITION = ["ingest_date", "series_id"]


def bronze_stream(
    spark: SparkSession, path: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """New bronze files, in batches of bounded size if a bound is given.

    A file that a rerun has replaced in the meantime is skipped: the files that
    took its place are new.
    """
    reader = spark.readStream.schema(BRONZE_AT_REST).option("ignoreMissingFiles", True)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def stream_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    max_bytes_per_trigger: int | None = None,
) -> StreamingQuery:
    """Bring silver up to date with bronze, then stop.

    New files tell which (run date, series) partitions of bronze were written. Each of
    these is read as it is now, cleaned, and replaces the same partition of silver. So
    a rerun of a run date leaves no row that it withdrew, a batch that is repeated
    writes the same, and a partition split over batches comes out whole. The rebalance
    makes few files, also of a hot series.
    """

    def replace(batch: DataFrame, _: int) -> None:
        with scratch_scope(spark):
            written = materialise(batch.select(*PARTITION).distinct(), "written")
            rows = read_bronze(spark, bronze_path).join(written, PARTITION, "left_semi")
            (
                silver.clean(rows, "ingest_date")
                .hint("rebalance", *PARTITION)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*PARTITION)
                .parquet(silver_path)
            )

    return (
        bronze_stream(spark, bronze_path, max_bytes_per_trigger)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_gold(
    staged: DataFrame,
    touched: DataFrame,
    catalogue: DataFrame,
    gold: str,
    vintages: str = "current",
    created_at: datetime | None = None,
) -> None:
    """Bring gold up to date after new rows of the touched series (series_id).

    ``staged`` is all of staging. Both dimensions are rebuilt from two of its columns,
    so that no refreshed observation misses its dimension row; the fact is rebuilt for
    the touched series only and keeps all others, in either layout. Dimensions come
    first: the star never has a fact without them.

    The series list is written first: its size is then known, so Catalyst can
    broadcast it and prune the silver folders of all other series. The rows of the
    touched series are written too, as the chunked lag needs a scan below it.
    """
    with scratch_scope(staged.sparkSession):
        series = materialise(touched.select("series_id").distinct(), "touched")
        rows = staged.join(series, "series_id", "left_semi")
        if vintages == "all":
            rows = materialise(rows, "touched-rows")
        write_gold(marts.dim_indicators(staged, catalogue, created_at), gold, "dim_indicators")
        write_gold(marts.dim_time(staged), gold, "dim_time")
        fact = marts.fct_observations(rows, vintages, created_at)
        replace_series(fact, series, gold, "fct_observations")
