"""Landed JSON documents: one API response per document.

Layout: ``<landing>/ingest_date=YYYY-MM-DD/series_id=ID/*.json``. A document is
an object whose ``observations`` array holds flat records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.functions.scalar import parse_date
from tsmedallion.schemas import BRONZE, DOCUMENT, QUARANTINE
from tsmedallion.sources.bronze import run_folder


def read_documents(
    spark: SparkSession,
    landing: str,
    ingest_date: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Documents with the ``ingest_date`` and ``series_id`` of their folder.

    Given a run date, only that date's folder is listed. A malformed document
    fails the read. ``multi_line=False`` reads one document per line, which
    Spark splits inside a file.
    """
    schema = T.StructType(
        DOCUMENT.fields
        + [
            T.StructField("ingest_date", T.StringType()),
            T.StructField("series_id", T.StringType()),
        ]
    )
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("basePath", landing)
        .json(landing if ingest_date is None else run_folder(landing, ingest_date))
    )


def read_landed(
    spark: SparkSession,
    landing: str,
    ingest_date: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """All documents, sound or not, with their ``file`` and, of one that is not a document of the
    declared shape, its text as ``rescued``."""
    fields = [
        *DOCUMENT.fields,
        *(T.StructField(n, T.StringType()) for n in ("rescued", "ingest_date", "series_id")),
    ]
    return (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "rescued")
        .option("basePath", landing)
        .json(landing if ingest_date is None else run_folder(landing, ingest_date))
        .withColumn("file", F.col("_metadata.file_path"))
    )


def sound_documents(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col("rescued").isNull()).select("ingest_date", "series_id", "observations")


def quarantined(landed: DataFrame) -> DataFrame:
    """A row per document that could not be read: its folder, file, cause and text.

    Nothing of it gets into bronze, also not what could be read before the fault.
    """
    text = F.trim("rescued")
    cause = (
        F.when(text == "", "empty")
        .when(F.try_parse_json("rescued").isNotNull(), "another shape")
        .when(F.startswith(text, F.lit("{")) | (F.size("observations") > 0), "broken JSON")
        .otherwise("no JSON")
    )
    return landed.filter(F.col("rescued").isNotNull()).select(
        "ingest_date", "series_id", "file", cause.alias("cause"), "rescued"
    )


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Replace the quarantine of the run dates in ``bad``; other run dates keep theirs."""
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE.names)


def document_counts(landed: DataFrame) -> DataFrame:
    """Documents, those quarantined and their share, and observations; of no document the share is 0."""
    counts = landed.agg(
        F.count("*").alias("n_documents"),
        F.count_if(F.col("rescued").isNotNull()).alias("n_quarantined"),
        F.coalesce(F.sum(F.size("observations")), F.lit(0)).alias("n_observations"),
    )
    return counts.withColumn(
        "bad_share", F.coalesce(F.try_divide("n_quarantined", "n_documents"), F.lit(0.0))
    )


def explode_documents(docs: DataFrame, observation_start: str | None = None) -> DataFrame:
    """One row per observation. A document without the array gives no row.

    The bound compares dates, padded or not; an observation whose date does not parse
    stays, for silver to report.
    """
    rows = docs.select("ingest_date", "series_id", F.inline("observations"))
    if observation_start is not None:
        day = parse_date(F.col("date"))
        rows = rows.filter(day.isNull() | (day >= F.to_date(F.lit(observation_start))))
    return rows


def to_bronze(observations: DataFrame, catalogue: DataFrame, ingested_at: str) -> DataFrame:
    """Add the series name and the run's timestamp text.

    The catalogue has one row per series; Catalyst sizes it and picks a
    broadcast or a shuffled join. A series it does not know keeps a NULL name.
    """
    names = catalogue.select("series_id", "series_name")
    return observations.join(names, "series_id", "left").select(
        *(c for c in BRONZE.names if c != "ingestion_timestamp"),
        F.lit(ingested_at).alias("ingestion_timestamp"),
        "ingest_date",
    )
