"""The newest vintage of every observation, kept up to date by a stream in any order of arrival.

State is keyed by (series, date): one row of bounded size, the newest vintage seen. A late
vintage that is older changes nothing and is not emitted, so what is written grows with
revisions, not with arrivals. After a restart from the checkpoint the stream goes on from its state.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tsmedallion.operators import silver, staging
from tsmedallion.schemas import STAGING
from tsmedallion.streaming.silver_stream import bronze_stream

KEYS = ["series_id", "observation_date"]
# The value goes through pandas as text, which would take NaN for NULL.
KEPT = "data_as_of_date string, ingested_us bigint, value_text string, series_name string"
NAMES = [field.split()[0] for field in KEPT.split(", ")]
ROW = f"series_id string, observation_date date, {KEPT}"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def age(vintage: tuple) -> tuple:
    """Sorts as ``VINTAGE_ORDER`` does: a missing part first, NaN behind all numbers."""
    as_of, at, text, name = vintage
    value = None if text is None else float(text)
    return tuple(
        (0,) if x is None else (2, 0) if isinstance(x, float) and math.isnan(x) else (1, x) for x in (as_of, at, value, name)
    )


class NewestVintage(StatefulProcessor):
    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", KEPT, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self.newest.get()) if self.newest.exists() else None
        best = before
        for frame in rows:
            for row in zip(*(frame[c].tolist() for c in NAMES)):
                as_of, at, value, name = row
                row = (as_of, None if at is None or at != at else int(at), value, name)  # a long with gaps is read as floats
                if best is None or age(row) > age(best):
                    best = row
        if best is not None and best != before:
            self.newest.update(best)
            yield pd.DataFrame([(*key, *best)], columns=[*KEYS, *NAMES])

    def close(self) -> None:
        pass


def newest_vintages(staged: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of staging rows as a stream of changes: a row per (series, date) that got a newer vintage.

    With ``ttl_ms`` a key's state is dropped so long after its last change. A vintage of that key that
    arrives later counts as new, even an older one; ``read_current`` still chooses right. This is
    for a query that runs on: Spark then makes batches without data as well, so that one that is
    to stop when all is read (``availableNow``) never would.
    Rows without a date are no vintages of anything and pass as they are.
    """
    rows = staged.select(
        *KEYS,
        "data_as_of_date",
        F.unix_micros(F.col("ingested_at").cast("timestamp")).alias("ingested_us"),
        F.col("value").cast("string").alias("value_text"),
        "series_name",
    )
    dated = (
        rows.filter(F.col("observation_date").isNotNull())
        .groupBy(*KEYS)
        .transformWithStateInPandas(
            NewestVintage(ttl_ms), ROW, "Update", "none" if ttl_ms is None else "processingTime"
        )
    )
    return dated.unionByName(rows.filter(F.col("observation_date").isNull()))


def stream_current_vintage(
    spark: SparkSession,
    bronze_path: str,
    target: str,
    checkpoint: str,
    max_bytes_per_trigger: int | None = None,
) -> StreamingQuery:
    """Bring the changes under ``target`` up to date with bronze, then stop.

    A batch that is repeated after a failure replaces the folder that it wrote.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    staged = staging.stage(silver.clean(bronze_stream(spark, bronze_path, max_bytes_per_trigger)))
    writer = (
        newest_vintages(staged)
        .writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A query keeps the settings that it starts with; the session gets its own back.
    own = {key: spark.conf.get(key, None) for key in STATE_STORE}
    try:
        for key, value in STATE_STORE.items():
            spark.conf.set(key, value)
        return writer.start()
    finally:
        for key, value in own.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The newest vintage of every (series, date) among the changes written so far."""
    rows = spark.read.schema(ROW).parquet(target)
    at = F.timestamp_micros("ingested_us").cast("timestamp_ntz")
    columns = [c for c in STAGING.names if c != "transformed_at"]
    value = F.col("value_text").cast("double")
    return staging.current_vintage(rows.withColumns({"ingested_at": at, "value": value}).select(*columns))
