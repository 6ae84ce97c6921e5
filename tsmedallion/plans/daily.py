"""The daily run: landed JSON to bronze, silver, gold and the data tests."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tsmedallion.operators import incremental, marts, quality, silver, staging
from tsmedallion.schemas import (
    BRONZE_AT_REST,
    DEFAULT_OBSERVATION_START,
    check_at_rest,
    default_catalogue,
)
from tsmedallion.session import require_utc, scratch_scope
from tsmedallion.sources import bronze, landing, snapshots, tables


class DataTestError(RuntimeError):
    """At least one data test found failing rows."""


class LandingError(RuntimeError):
    """More documents than allowed could not be read."""


@dataclass(frozen=True)
class DailyRun:
    """``max_bad_share`` is the share of documents that may be unreadable: these go to the lake's
    ``quarantine`` and the run goes on. Without it the first one fails the run."""

    landing: str
    lake: str
    ingest_date: str
    run_at: datetime
    observation_start: str | None = DEFAULT_OBSERVATION_START
    vintages: str = "current"
    layout: str = "folders"
    multi_line: bool = True
    catalogue: DataFrame | None = None
    max_bad_share: float | None = None

    @property
    def ingestion_timestamp(self) -> str:
        """The run's time as text in UTC, without a zone, as bronze keeps it."""
        moment = self.run_at
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        return moment.isoformat()

    def path(self, layer: str) -> str:
        return f"{self.lake.rstrip('/')}/{layer}"


def readable_documents(spark: SparkSession, run: DailyRun) -> DataFrame:
    """The run date's documents; others are quarantined, as far as the run allows any."""
    if run.max_bad_share is None:
        return landing.read_documents(spark, run.landing, run.ingest_date, run.multi_line)
    landed = landing.read_landed(spark, run.landing, run.ingest_date, run.multi_line)
    found = landing.document_counts(landed).first()
    if found["n_quarantined"]:
        landing.write_quarantine(landing.quarantined(landed), run.path("quarantine"))
    if found["bad_share"] > run.max_bad_share:
        raise LandingError(f"{found['n_quarantined']} of {found['n_documents']} documents of {run.ingest_date} cannot be read")
    return landing.sound_documents(landed)


def ingest(spark: SparkSession, run: DailyRun, catalogue: DataFrame) -> dict[str, int]:
    """Landed documents of the run date to bronze; returns the audit totals."""
    documents = readable_documents(spark, run)
    rows = landing.explode_documents(documents, run.observation_start)
    bronze.write_bronze(
        landing.to_bronze(rows, catalogue, run.ingestion_timestamp), run.path("bronze")
    )
    try:
        check_at_rest(
            spark,
            bronze.run_folder(run.path("bronze"), run.ingest_date),
            BRONZE_AT_REST,
            ("ingest_date", "series_id"),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no observation was ingested for {run.ingest_date}") from error
    written = bronze.read_bronze(spark, run.path("bronze"), run.ingest_date)
    return bronze.require_any_series(bronze.audit(written, catalogue))


def refine(spark: SparkSession, run: DailyRun) -> dict[str, Any]:
    """All of bronze to silver; returns the quality summary."""
    cleaned = silver.clean(bronze.read_bronze(spark, run.path("bronze")))
    tables.write_silver(cleaned, run.path("silver"), run.layout)
    written = tables.read_silver(spark, run.path("silver"))
    return silver.quality_summary(written).first().asDict()


def build_gold(spark: SparkSession, run: DailyRun, catalogue: DataFrame) -> None:
    """The three gold tables. Each scans only the silver columns it needs."""
    staged = staging.stage(tables.read_silver(spark, run.path("silver")), run.run_at)
    gold = run.path("gold")
    tables.write_gold(
        marts.dim_indicators(staged, catalogue, run.run_at), gold, "dim_indicators"
    )
    tables.write_gold(marts.dim_time(staged), gold, "dim_time")
    tables.write_gold(
        marts.fct_observations(staged, run.vintages, run.run_at),
        gold,
        "fct_observations",
        run.layout,
    )


def data_tests(spark: SparkSession, run: DailyRun) -> DataFrame:
    """The report over written silver and gold: one row per test."""
    gold = run.path("gold")
    return quality.run_suite(
        staging.stage(tables.read_silver(spark, run.path("silver")), run.run_at),
        *(
            tables.read_gold(spark, gold, name)
            for name in ("dim_indicators", "dim_time", "fct_observations")
        ),
    )


def run_daily(spark: SparkSession, run: DailyRun) -> dict[str, Any]:
    """Run the layers in order; a failed audit or data test raises."""
    require_utc(spark)
    catalogue = default_catalogue(spark) if run.catalogue is None else run.catalogue
    # A series listed twice would double its rows in bronze.
    listed_twice = quality.failed(quality.unique(catalogue, "catalogue", "series_id"))
    if listed_twice:
        raise DataTestError("; ".join(listed_twice))
    with scratch_scope(spark):
        audited = ingest(spark, run, catalogue)
        summary = refine(spark, run)
        build_gold(spark, run, catalogue)
        failures = quality.failed(data_tests(spark, run))
    if failures:
        raise DataTestError("; ".join(failures))
    return {"audit": audited, "quality": summary}


def version_tests(made: snapshots.Snapshot) -> list[str]:
    """Failures of the data tests over a version's own staging and gold."""
    names = (snapshots.STAGED, "dim_indicators", "dim_time", snapshots.FACT)
    return quality.failed(quality.run_suite(*(made.read(n) for n in names)))


def run_versions(spark: SparkSession, run: DailyRun) -> dict[str, Any]:
    """The daily run at the cost of what it changes: the lake's ``versions`` get one more.

    A run date is compared with what the newest version has of it. Staging is transformed again
    for the years of the rows that came or went, the fact from each series' earliest change on.
    The data tests run before the version is published; if one fails it never is.
    """
    require_utc(spark)
    catalogue = default_catalogue(spark) if run.catalogue is None else run.catalogue
    with scratch_scope(spark):
        documents = readable_documents(spark, run)
        rows = landing.explode_documents(documents, run.observation_start)
        raw = landing.to_bronze(rows, catalogue, run.ingestion_timestamp)
        # Written once: what the audit reads is what the version will name.
        folder = snapshots.write_run(raw, run.path("versions"))
        raw = spark.read.schema(BRONZE_AT_REST).parquet(folder)
        audited = bronze.require_any_series(bronze.audit(raw, catalogue))
        summary = silver.quality_summary(silver.clean(raw)).first().asDict()
        try:
            made = incremental.refresh_from_run(
                spark, run.path("versions"), raw, run.ingest_date, catalogue, run.run_at, version_tests, folder=folder
            )
        except incremental.CheckFailed as error:
            raise DataTestError(str(error)) from error
    return {"audit": audited, "quality": summary, "version": made.number}
