"""One query per operator, over the whole of the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.operators import (
    anomalies,
    calendar,
    correlation,
    dashboard,
    incremental,
    marts,
    quality,
    ranges,
    silver,
    smoothing,
    staging,
    temporal,
)
from tsmedallion.plans import daily, fixtures
from tsmedallion.schemas import FCT_OBSERVATIONS, STAGING, default_catalogue, local_table
from tsmedallion.session import materialise, scratch_path
from tsmedallion.sources import bronze, landing, snapshots, tables
from tsmedallion.streaming import silver_stream, vintage_stream

RUN_AT = datetime(2024, 2, 1, 6, tzinfo=timezone.utc)
RUN_DATE = "2024-02-01"

PRIORITIES = {
    "Priority 1-URGENT": "urgent",
    "Priority 2-HIGH": "high",
    "Priority 3-MEDIUM": "medium",
    "Priority 4-NOT SPECIFIED": "not_specified",
    "Priority 5-LOW": "low",
}
SERIES_NAMES = {f"Series {s}": s.lower() for s in fixtures.DAILY_SERIES.values()}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.obs_events(fixtures.table(spark, sf, "events"))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.obs_daily(fixtures.table(spark, sf, "lineitem"))


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.obs_monthly(fixtures.table(spark, sf, "orders"))


def _staged_events(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage(silver.clean(_events(spark, sf)))


def _staged_daily(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage(silver.clean(_daily(spark, sf)))


# Gold is built once per application and table folder, then read by every
# dashboard query, as a dashboard reads the tables of the last run.
_GOLD: dict[tuple[str, str], str] = {}


def gold_root(spark: SparkSession, sf: str) -> str:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _GOLD:
        root = scratch_path(spark, "gold")
        silver_path = f"{root}/silver"
        tables.write_silver(silver.clean(_daily(spark, sf)), silver_path)
        staged = staging.stage(tables.read_silver(spark, silver_path), RUN_AT)
        tables.write_gold(
            marts.dim_indicators(staged, default_catalogue(spark), RUN_AT), root, "dim_indicators"
        )
        tables.write_gold(marts.dim_time(staged), root, "dim_time")
        tables.write_gold(
            marts.fct_observations(staged, "current", RUN_AT), root, "fct_observations"
        )
        tables.write_gold(marts.fct_observations(staged, "all", RUN_AT), root, "fct_all_vintages")
        _GOLD[key] = root
    return _GOLD[key]


def _gold(spark: SparkSession, sf: str, table: str) -> DataFrame:
    schema = FCT_OBSERVATIONS if table.startswith("fct_") else None
    return tables.read_gold(spark, gold_root(spark, sf), table, schema)


def _star(
    spark: SparkSession,
    sf: str,
    ids: list[str] | None = None,
    fact: str = "fct_observations",
    with_age: bool = False,
) -> DataFrame:
    return dashboard.star(
        _gold(spark, sf, fact),
        _gold(spark, sf, "dim_indicators"),
        _gold(spark, sf, "dim_time"),
        ids,
        with_age,
    )


# --- Sources and bronze -----------------------------------------------------


@query
def bronze_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed as JSON pages, read back and flattened."""
    page = F.floor(F.col("event_id") / 1000).alias("page")
    raw = fixtures.obs_events(fixtures.table(spark, sf, "events"), page)
    landed = fixtures.land(fixtures.documents(raw), scratch_path(spark, "landing"))
    rows = landing.explode_documents(
        landing.read_documents(spark, landed, multi_line=False), "2024-01-10"
    )
    catalogue = materialise(fixtures.catalogue_of(raw), "catalogue")
    return landing.to_bronze(rows, catalogue, RUN_AT.isoformat())


@query
def landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and observations per folder and fate; most pages land damaged."""
    page = F.floor(F.col("event_id") / 100).alias("page")
    raw = fixtures.obs_events(fixtures.table(spark, sf, "events"), page)
    landed = fixtures.land_damaged(fixtures.paged(raw, F.col("ingest_date")), scratch_path(spark, "landing"))
    found = landing.read_landed(spark, landed, multi_line=False)
    path = scratch_path(spark, "quarantine")
    landing.write_quarantine(landing.quarantined(found), path)
    sound = landing.sound_documents(found)
    keys = ["ingest_date", "series_id"]
    fates = (
        (sound.withColumn("fate", F.lit("sound")), F.sum(F.size("observations"))),
        (landing.read_quarantine(spark, path).withColumnRenamed("cause", "fate"), F.lit(0)),
    )
    good, bad = (
        df.groupBy(*keys, "fate").agg(F.count("*").alias("n_documents"), n.cast("long").alias("n_observations"))
        for df, n in fates
    )
    return good.unionByName(bad)


@query
def bronze_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze written by run date and series, against an expected list with
    one series that never arrives."""
    raw = _events(spark, sf)
    path = scratch_path(spark, "bronze")
    bronze.write_bronze(raw, path)
    expected = raw.select("series_id").distinct().union(
        spark.range(1).select(F.lit("never"))
    )
    return bronze.audit(bronze.read_bronze(spark, path), expected)


@query
def bronze_audit_totals(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.audit_totals(bronze.audit(_daily(spark, sf), default_catalogue(spark)))


@query
def bronze_date_range(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.date_range(_events(spark, sf))


# --- Silver -----------------------------------------------------------------


@query
def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean(_daily(spark, sf))


@query
def silver_clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean(_events(spark, sf))


@query
def silver_dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return silver.quality_summary(silver.clean(_daily(spark, sf)))


@query
def silver_partition_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    tables.write_silver(silver.clean(_events(spark, sf)), path)
    return tables.read_silver(spark, path)


@query
def silver_clustered_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    tables.write_silver(silver.clean(_daily(spark, sf)), path, "clustered")
    return tables.read_silver(spark, path)


@query
def silver_stream_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows through the streaming form of silver, of which a first run of every
    run date is then replaced: it had other values, and a row more each."""
    landed, path, state = (scratch_path(spark, n) for n in ("bronze", "silver-stream", "state"))
    raw = _events(spark, sf)
    first = raw.unionByName(raw.dropDuplicates(["ingest_date", "series_id"]))
    for rows in (first.withColumn("value", F.lit("0")), raw):
        bronze.write_bronze(rows, landed)
        silver_stream.stream_silver(spark, landed, path, state).awaitTermination()
    return tables.read_silver(spark, path)


@query
def vintage_stream_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Newest vintages by keyed state: run dates arrive newest first, in three runs of the stream."""
    raw = _events(spark, sf)
    landed, path, state = (scratch_path(spark, n) for n in ("bronze", "vintages", "state"))
    day = F.dayofmonth(F.col("ingest_date").cast("date"))
    for part in (day > 20, (day <= 20) & (day > 10), day <= 10):
        bronze.write_bronze(raw.filter(part), landed)
        vintage_stream.stream_current_vintage(spark, landed, path, state).awaitTermination()
    return vintage_stream.read_current(spark, path)


# --- Staging ----------------------------------------------------------------


@query
def stg_observations(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_daily(spark, sf).drop("transformed_at")


@query
def stg_view(spark: SparkSession, sf: str) -> DataFrame:
    """Staging as a named view, queried by name; the name is the run's own."""
    name = f"stg_observations_{uuid.uuid4().hex}"
    _staged_events(spark, sf).createOrReplaceTempView(name)
    found = spark.table(name).drop("transformed_at")
    spark.catalog.dropTempView(name)
    return found


@query
def current_vintage(spark: SparkSession, sf: str) -> DataFrame:
    return staging.current_vintage(_staged_daily(spark, sf)).drop("transformed_at")


@query
def current_vintage_events(spark: SparkSession, sf: str) -> DataFrame:
    return staging.current_vintage(_staged_events(spark, sf)).drop("transformed_at")


@query
def as_of(spark: SparkSession, sf: str) -> DataFrame:
    return staging.as_of(_staged_daily(spark, sf), date(1998, 6, 30)).drop("transformed_at")


@query
def as_of_many(spark: SparkSession, sf: str) -> DataFrame:
    """What was known of an observation on a day, for a question per line item."""
    asked = fixtures.probes(fixtures.table(spark, sf, "lineitem"))
    return temporal.as_of_join(
        asked,
        _staged_daily(spark, sf),
        ["series_id", "observation_date"],
        "known_at",
        "data_as_of_date",
        ["value", "data_as_of_date"],
        ("ingested_at",),
    )


# --- Gold -------------------------------------------------------------------


@query
def dim_indicators(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged_daily(spark, sf)
    return marts.dim_indicators(staged, default_catalogue(spark)).drop("created_at")


@query
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_time(_staged_daily(spark, sf))


@query
def fct_observations(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_observations(_staged_daily(spark, sf)).drop("created_at")


@query
def fct_observations_events(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_observations(_staged_events(spark, sf)).drop("created_at")


@query
def fct_observations_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_observations(_monthly(spark, sf)).drop("created_at")


@query
def fct_all_vintages(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_observations(_staged_daily(spark, sf), "all").drop("created_at")


@query
def fct_all_vintages_events(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_observations(_staged_events(spark, sf), "all").drop("created_at")


def _nan_apart(df: DataFrame) -> DataFrame:
    """NaN as NULL with a flag of its own, as NaN equals nothing in a comparison."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    flags = {f"{c}_is_nan": F.coalesce(F.isnan(c), F.lit(False)) for c in doubles}
    return df.withColumns(flags).withColumns({c: F.nanvl(c, F.lit(None)) for c in doubles})


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean(fixtures.obs_edges(_daily(spark, sf)))


@query
def silver_clean_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Unparseable and unpadded dates, non-finite values, missing ids."""
    return _nan_apart(_edges(spark, sf))


@query
def current_vintage_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a date all stay; equal ages are told apart by value."""
    staged = staging.stage(_edges(spark, sf)).drop("transformed_at")
    return _nan_apart(staging.current_vintage(staged))


@query
def fct_observations_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _nan_apart(marts.fct_observations(staging.stage(_edges(spark, sf))).drop("created_at"))


@query
def dq_not_null_edges(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null(
        staging.stage(_edges(spark, sf)), "stg_observations", ["series_id", "observation_date"]
    )


def _refreshed(spark: SparkSession, sf: str, layout: str) -> DataFrame:
    """Gold built on what was shipped up to 1995, then refreshed with all the rest."""
    root = scratch_path(spark, "gold-refresh")
    staged, catalogue = _staged_daily(spark, sf), default_catalogue(spark)
    untouched = F.col("series_id").isin("CPIAUCSL", "NO")  # all there from the start
    old = staged.filter((F.col("observation_date") < "1996-01-01") | untouched)
    tables.write_gold(marts.dim_indicators(old, catalogue, RUN_AT), root, "dim_indicators")
    tables.write_gold(marts.dim_time(old), root, "dim_time")
    fact = marts.fct_observations(old, "current", RUN_AT)
    tables.write_gold(fact, root, "fct_observations", layout)
    touched = staged.filter(~untouched).select("series_id")
    silver_stream.refresh_gold(staged, touched, catalogue, root, "current", RUN_AT)
    names = ("fct_observations", "dim_indicators", "dim_time")
    return dashboard.star(*(tables.read_gold(spark, root, n) for n in names))


@query
def gold_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, "folders")


@query
def gold_refresh_clustered(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, "clustered")


def _versions(spark: SparkSession, sf: str) -> tuple[str, int, int]:
    """Versioned gold, refreshed after late, revised and deleted rows; its folder and versions."""
    root = scratch_path(spark, "gold-versions")
    staged, catalogue = _staged_daily(spark, sf), default_catalogue(spark)
    day, series = F.col("observation_date"), F.col("series_id")
    late = (series == "UMCSENT") & (day >= "1997-06-01")
    revised = (series == "DFF") & (F.col("data_as_of_date") >= "1998-01-01")
    deleted = (series == "GDP") & day.between("1994-03-01", "1994-03-20")
    arriving = F.coalesce(late | revised, F.lit(False))
    withdrawn = F.coalesce(deleted, F.lit(False))
    first = incremental.build_version(spark, root, staged.filter(~arriving), catalogue, RUN_AT)
    incremental.write_staged(staged.filter(~withdrawn), f"{root}/staged")
    now = spark.read.schema(T.StructType([*STAGING.fields, T.StructField("year", T.IntegerType())])).parquet(f"{root}/staged")
    second = incremental.refresh_version(
        spark, root, now, staged.filter(arriving), staged.filter(withdrawn), catalogue, RUN_AT
    )
    return root, first, second


def _star_of_version(spark: SparkSession, root: str, number: int) -> DataFrame:
    pinned = snapshots.open_snapshot(spark, root, number)
    names = ("fct_observations", "dim_indicators", "dim_time")
    return dashboard.star(*(pinned.read(n) for n in names))


@query
def gold_version_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    root, _, second = _versions(spark, sf)
    return _star_of_version(spark, root, second)


@query
def gold_version_pinned(spark: SparkSession, sf: str) -> DataFrame:
    """The version before the refresh, read after it."""
    root, first, _ = _versions(spark, sf)
    return _star_of_version(spark, root, first)


@query
def yoy_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series: 365 rows are not always there, so lag 12 would be wrong."""
    return marts.yoy_calendar(_staged_daily(spark, sf))


@query
def yoy_calendar_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series without any July."""
    return marts.yoy_calendar(
        _monthly(spark, sf).filter(F.month("observation_date") != 7)
    )


@query
def resample_month(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf, "month")


@query
def resample_year(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf, "year")


def _resampled(spark: SparkSession, sf: str, unit: str) -> DataFrame:
    means = marts.resample(_staged_daily(spark, sf), unit)
    return means.withColumn("mean_value", F.round("mean_value", 6))


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Staging with series renamed with the vintages of 1998, some of them back in 2000."""
    staged = _staged_daily(spark, sf)
    as_of_date, name = F.col("data_as_of_date"), F.col("series_name")
    renamed = F.when(
        (as_of_date >= "1998-01-01")
        & ~((as_of_date >= "2000-01-01") & F.col("series_id").isin("GDP", "DFF")),
        F.concat(name, F.lit(" rebased")),
    ).otherwise(name)
    return staged.withColumn("series_name", renamed)


@query
def indicator_history(spark: SparkSession, sf: str) -> DataFrame:
    return marts.indicator_history(_renamed(spark, sf))


@query
def indicator_history_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from three deltas whose as-of dates are in no order, over a kept state."""
    staged = _renamed(spark, sf)
    part = F.crc32(F.concat("series_id", "data_as_of_date")) % 3
    first = staged.filter(part == 1)
    names = materialise(marts.names_by_date(first), "names")
    history = materialise(marts.name_intervals(names), "history")
    for i in (0, 2):
        new_history, new_names = temporal.refresh_history(history, names, staged.filter(part == i))
        history, names = materialise(new_history, "history"), materialise(new_names, "names")
    return history


@query
def fact_with_names(spark: SparkSession, sf: str) -> DataFrame:
    """Every vintage of the fact with the name that its indicator had at the time."""
    fact = _gold(spark, sf, "fct_all_vintages").select("indicator_id", "date_key", "observation_value", "data_as_of_date")
    history = marts.indicator_history(_renamed(spark, sf))
    until = fact.agg(F.max("data_as_of_date")).first()[0]
    return temporal.names_valid_at(fact, history, "indicator_id", "data_as_of_date", until)


@query
def time_weighted(spark: SparkSession, sf: str) -> DataFrame:
    found = calendar.time_weighted(_staged_daily(spark, sf))
    return found.withColumn("mean_value", F.round("mean_value", 6))


@query
def time_weighted_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series without any July."""
    found = calendar.time_weighted(_monthly(spark, sf).filter(F.month("observation_date") != 7))
    return found.withColumn("mean_value", F.round("mean_value", 4))


@query
def rolling_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    found = anomalies.rolling_anomalies(_staged_daily(spark, sf))
    return found.withColumn("robust_score", F.round("robust_score", 6))


@query
def seasonal_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """One step ahead for every month, and a year ahead behind the last."""
    fitted = smoothing.smooth(_monthly(spark, sf))
    ahead = smoothing.forecast(fitted, 12)
    known = fitted.observations.select("series_id", "place", "value", "forecast")
    sizes = fitted.states.select("series_id", "n_observations")
    future = ahead.join(sizes, "series_id").select(
        "series_id",
        (F.col("n_observations") + F.col("step") - 1).alias("place"),
        F.lit(None).cast("double").alias("value"),
        "forecast",
    )
    return known.unionByName(future).withColumn("forecast", F.round("forecast", 2))


@query
def forecast_backtest(spark: SparkSession, sf: str) -> DataFrame:
    found = smoothing.backtest(smoothing.smooth(_monthly(spark, sf)))
    return found.withColumns({c: F.round(c, 2) for c in ("mean_error", "naive_error")})


# --- Dashboard --------------------------------------------------------------


@query
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf, ["GDP", "UNRATE", "CPIAUCSL"])


@query
def star_join_all_vintages(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf, fact="fct_all_vintages")


@query
def indicator_list(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.indicator_list(_gold(spark, sf, "dim_indicators")).drop("created_at")


@query
def date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.date_bounds(_star(spark, sf))


@query
def date_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.filter_range(_star(spark, sf), date(1997, 1, 1), date(1998, 12, 31))


@query
def latest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.latest_metrics(_star(spark, sf))


@query
def latest_metrics_all_vintages(spark: SparkSession, sf: str) -> DataFrame:
    """Over a fact with all vintages the newest one counts, so the changes of values
    differ from the current fact's and the values do not."""
    return dashboard.latest_metrics(_star(spark, sf, fact="fct_all_vintages", with_age=True))


@query
def latest_50_all_vintages(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_recent(_star(spark, sf, fact="fct_all_vintages", with_age=True))


@query
def series_timeseries(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.time_series(_star(spark, sf, ["DFF"]))


@query
def yoy_series(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.yoy_series(_star(spark, sf, ["GDP", "UNRATE"]))


@query
def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.dedupe_last(_star(spark, sf, fact="fct_all_vintages", with_age=True))


@query
def pivot_wide(spark: SparkSession, sf: str) -> DataFrame:
    deduped = dashboard.dedupe_last(
        _star(spark, sf, fact="fct_all_vintages", with_age=True), ["observation_value"]
    )
    return dashboard.pivot_wide(deduped, SERIES_NAMES)


@query
def pivot_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.pivot_wide(_monthly_points(spark, sf), PRIORITIES)


def _monthly_points(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series as (date, name, value), which has no duplicates."""
    return _monthly(spark, sf).select(
        F.col("observation_date").alias("date_key"),
        F.col("series_name").alias("indicator_name"),
        F.col("value").alias("observation_value"),
    )


def _rounded(matrix: DataFrame) -> DataFrame:
    return matrix.withColumn("r", F.round("r", 6))


@query
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    deduped = dashboard.dedupe_last(
        _star(spark, sf, fact="fct_all_vintages", with_age=True), ["observation_value"]
    )
    return _rounded(correlation.corr_matrix(deduped, list(SERIES_NAMES)))


@query
def corr_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(correlation.corr_matrix(_monthly_points(spark, sf), list(PRIORITIES)))


@query
def corr_nations(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty-five series."""
    points = fixtures.nation_points(
        fixtures.table(spark, sf, "orders"), fixtures.table(spark, sf, "customer")
    )
    return _rounded(correlation.corr_matrix(points, [f"Nation {i}" for i in range(25)]))


@query
def corr_non_finite(spark: SparkSession, sf: str) -> DataFrame:
    """Infinity every March and NaN every May in one of the series."""
    points = _monthly_points(spark, sf)
    month, value = F.month("date_key"), F.col("observation_value")
    dirty = F.when(month == 3, float("inf")).when(month == 5, float("nan")).otherwise(value)
    first = F.col("indicator_name") == "Priority 1-URGENT"
    points = points.withColumn("observation_value", F.when(first, dirty).otherwise(value))
    return _rounded(correlation.corr_matrix(points, list(PRIORITIES)))


@query
def latest_50(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_recent(_star(spark, sf))


@query
def csv_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Names with outer blanks, quotes, commas and a line break come back as they were."""
    name = F.concat(F.lit('  "a", "'), "indicator_name", F.lit('" \n and more '))
    data = _star(spark, sf, ["GDP", "UNRATE", "CPIAUCSL"]).withColumn("indicator_name", name)
    path = tables.export_csv(data, scratch_path(spark, "csv"), RUN_AT.date())
    return tables.read_csv(spark, path, data.schema)


# --- Data tests -------------------------------------------------------------


@query
def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """The thirteen tests over built gold."""
    return quality.run_suite(
        _staged_daily(spark, sf),
        _gold(spark, sf, "dim_indicators"),
        _gold(spark, sf, "dim_time"),
        _gold(spark, sf, "fct_observations"),
    )


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Before the valid-row filter, so that values are missing."""
    return quality.not_null(
        silver.clean(_daily(spark, sf)),
        "silver",
        ["series_id", "series_name", "observation_date", "value"],
    )


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Unique and repeated keys side by side."""
    return (
        quality.unique(_gold(spark, sf, "dim_time"), "dim_time", "date_key")
        .unionByName(
            quality.unique(_gold(spark, sf, "fct_all_vintages"), "fct_all_vintages", "date_key")
        )
        .unionByName(
            quality.unique(fixtures.table(spark, sf, "lineitem"), "lineitem", "l_orderkey")
        )
    )


@query
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Kept and broken references side by side."""
    orders = fixtures.table(spark, sf, "orders")
    lineitem = fixtures.table(spark, sf, "lineitem")
    customer = fixtures.table(spark, sf, "customer")
    fact = _gold(spark, sf, "fct_observations")
    catalogue = default_catalogue(spark)
    return (
        quality.relationships(lineitem, "lineitem", "l_orderkey", orders, "o_orderkey")
        .unionByName(
            quality.relationships(customer, "customer", "c_custkey", orders, "o_custkey")
        )
        .unionByName(
            quality.relationships(fact, "fct_observations", "indicator_id", catalogue, "series_id")
        )
    )


@query
def dq_in_range(spark: SparkSession, sf: str) -> DataFrame:
    bounds = local_table(
        spark,
        [("GDP", 2000.0, 90000.0), ("DFF", None, 50000.0), ("UNRATE", 0.0, 1000000.0)],
        T.StructType.fromDDL("series_id string, min_value double, max_value double"),
    )
    return quality.in_range(
        _staged_daily(spark, sf), "stg_observations", "series_id", "value", bounds
    )


@query
def dq_learned_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Rows outside ranges learned in two runs, as the quarantine has them.

    The sketches are large enough to be exact on the tables of the tests.
    """
    rows = _staged_daily(spark, sf).select("series_id", "observation_date", "value", "data_as_of_date", "ingested_at")
    early = F.col("data_as_of_date") < "1996-01-01"
    runs = [ranges.learn(rows.filter(part), "series_id", "value", 65_535) for part in (early, ~early)]
    state = materialise(runs[0], "sketches")
    limits = ranges.bounds(ranges.merge(state, runs[1]), 0.3, 0.6, 0.5)
    path = scratch_path(spark, "quarantine")
    ranges.quarantine(rows, "series_id", "value", limits, path)
    return spark.read.parquet(path)


@query
def dq_key_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_nulls(silver.clean(_events(spark, sf)), ["series_id", "value"])


@query
def dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    fact = _gold(spark, sf, "fct_all_vintages")
    return quality.orphans(fact, "indicator_id", default_catalogue(spark), "series_id")


# --- The daily run ----------------------------------------------------------


@query
def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """Landed JSON to gold and the data tests, all through files; returns the
    fact it wrote."""
    page = F.floor(F.col("l_orderkey") / 4000).alias("page")
    raw = fixtures.obs_daily(fixtures.table(spark, sf, "lineitem"), page)
    landed = fixtures.land(fixtures.documents(raw, RUN_DATE), scratch_path(spark, "landing"))
    run = daily.DailyRun(
        landing=landed,
        lake=scratch_path(spark, "lake"),
        ingest_date=RUN_DATE,
        run_at=RUN_AT,
        observation_start="1996-01-01",
        multi_line=False,
        catalogue=materialise(fixtures.catalogue_of(raw), "catalogue"),
    )
    daily.run_daily(spark, run)
    return tables.read_gold(spark, run.path("gold"), "fct_observations").drop("created_at")


@query
def daily_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The same fact by versions: a run with half of the pages, then a repeated run with all."""
    page = F.floor(F.col("l_orderkey") / 4000).alias("page")
    raw = fixtures.obs_daily(fixtures.table(spark, sf, "lineitem"), page)
    catalogue, lake = materialise(fixtures.catalogue_of(raw), "catalogue"), scratch_path(spark, "lake")
    for part in (raw.filter(F.col("page") % 2 == 0), raw):
        run = daily.DailyRun(
            landing=fixtures.land(fixtures.documents(part, RUN_DATE), scratch_path(spark, "landing")),
            lake=lake,
            ingest_date=RUN_DATE,
            run_at=RUN_AT,
            observation_start="1996-01-01",
            multi_line=False,
            catalogue=catalogue,
        )
        daily.run_versions(spark, run)
    newest = snapshots.open_snapshot(spark, run.path("versions"))
    return newest.read("fct_observations").drop("created_at")
