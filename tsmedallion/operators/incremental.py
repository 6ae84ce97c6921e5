"""Gold brought up to date from a change set, at the cost of what the changes reach.

A change at a date of a series can alter the fact from that date on: its own row, and those
that look back at it. So of each touched series the fact is recomputed from its
earliest changed date on, with the last rows before that date, which lags need, taken from
the published fact. Series without a change, and years before all that, are not read.

Dimensions are kept by key: only the dates and names that occur in the change set are looked up.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsmedallion.operators import marts, silver, staging
from tsmedallion.operators.staging import current_vintage
from tsmedallion.schemas import BRONZE_AT_REST, STAGING
from tsmedallion.session import materialise, scratch_scope
from tsmedallion.sources.snapshots import (
    FACT,
    STAGED,
    Layer,
    Snapshot,
    in_years,
    open_snapshot,
    publish,
    versions,
    write_layer,
    write_run,
)

# Of a change to rows without a date, which follow all dated ones.
BEHIND_ALL_DATES = "9999-12-31"
# Years searched at first for the rows before a series' earliest change, then further back.
LOOK_BACK_YEARS = (1, 4, 16)
MAX_LAYERS = 8
LONGEST_LAG = max(marts.LAGS.values())


def write_staged(staged: DataFrame, path: str) -> None:
    """Staging with one folder per year of observation."""
    rows = staged.withColumn("year", F.year("observation_date")).hint("rebalance", "year")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(path)


def change_set(inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The earliest changed date of every touched series: series_id, from_date."""
    changed = inserted.select("series_id", "observation_date").unionByName(deleted.select("series_id", "observation_date"))
    day = F.coalesce("observation_date", F.lit(BEHIND_ALL_DATES).cast("date"))
    return changed.groupBy("series_id").agg(F.min(day).alias("from_date"))


def _touched(rows: DataFrame, key: str, changes: DataFrame) -> DataFrame:
    named = changes.select(F.col("series_id").alias("touched_id"), "from_date")
    return rows.join(named, F.col(key).eqNullSafe(F.col("touched_id"))).drop("touched_id")


def rows_before(snapshot: Snapshot, changes: DataFrame, first_year: int, look_back: tuple[int, ...] = LOOK_BACK_YEARS) -> DataFrame:
    """Of each touched series the last published rows before its earliest change, as many as lags need.

    The years just before are read first. Only for series that have too few rows there are
    more read, so a sparse series does not make others costly.
    """
    years = snapshot.years()
    oldest, newest = min(years, default=first_year), max(years, default=first_year)
    newest_first = Window.partitionBy("indicator_id").orderBy(F.col("date_key").desc())
    fact, found, pending = snapshot.by_year(FACT), None, changes
    for span in (*look_back, None):
        low = min(first_year, newest) - span if span is not None else oldest
        rows = materialise(
            _touched(fact.filter(F.col("year") >= low), "indicator_id", pending)
            .filter(F.col("date_key") < F.col("from_date"))
            .withColumn("place", F.row_number().over(newest_first))
            .filter(F.col("place") <= LONGEST_LAG),
            "rows-before",
        )
        if low <= oldest:
            full, short = rows, None
        else:
            whole = rows.filter(F.col("place") == LONGEST_LAG).select(F.col("indicator_id").alias("whole_id"))
            same = F.col("indicator_id").eqNullSafe(F.col("whole_id"))
            full = rows.join(whole, same, "left_semi")
            short = pending.join(whole, F.col("series_id").eqNullSafe(F.col("whole_id")), "left_anti")
        found = full if found is None else found.unionByName(full)
        if short is None or short.isEmpty():
            break
        pending = materialise(short, "short-series")
    return found.select(
        F.col("indicator_id").alias("series_id"),
        F.col("date_key").alias("observation_date"),
        F.col("observation_value").alias("value"),
        "data_as_of_date",
        "ingested_at",
    )


def suffix_fact(
    snapshot: Snapshot, staged: DataFrame, changes: DataFrame, first_year: int, created_at: datetime | None = None
) -> DataFrame:
    """The fact of the touched series from their earliest changed dates on."""
    columns = ["series_id", "observation_date", "value", "data_as_of_date", "ingested_at"]
    recent = staged.filter((F.col("year") >= first_year) | F.col("year").isNull())
    rows = _touched(recent.select(*columns), "series_id", changes)
    dated = current_vintage(rows.filter(F.col("observation_date") >= F.col("from_date")).select(*columns))
    undated = rows.filter(F.col("observation_date").isNull()).select(*columns)
    before = rows_before(snapshot, changes, first_year)
    lagged = marts.lagged_current(
        dated.withColumn("is_before", F.lit(False)).unionByName(before.withColumn("is_before", F.lit(True))),
        undated.withColumn("is_before", F.lit(False)),
    )
    return marts.fact_columns(lagged.filter(~F.col("is_before")), created_at)


def _upserted(dim: DataFrame, keys: list[str], gone: DataFrame, found: DataFrame) -> DataFrame:
    """``dim`` without the keys of ``gone`` and with the rows of ``found`` that it lacks."""
    named = lambda df: df.select(*(F.col(k).alias(f"other_{k}") for k in keys)).distinct()
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"other_{k}"))
        same = equal if same is None else same & equal
    kept = dim.join(named(gone), same, "left_anti")
    return kept.unionByName(found.join(named(kept), same, "left_anti"))


def upsert_time(dim: DataFrame, staged: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The time dimension after the changes; only the years of changed dates are read."""
    days = materialise(
        inserted.select("observation_date").unionByName(deleted.select("observation_date")).distinct(), "changed-dates"
    )
    near = staged.filter(in_years(_years(days)))
    changed = days.select(F.col("observation_date").alias("changed"))
    same = F.col("observation_date").eqNullSafe(F.col("changed"))
    found = marts.dim_time(near.join(changed, same, "left_semi"))
    gone = days.select(F.col("observation_date").alias("date_key"))
    return _upserted(dim, ["date_key"], gone, found)


def upsert_indicators(
    dim: DataFrame,
    staged: DataFrame,
    inserted: DataFrame,
    deleted: DataFrame,
    first_year: int,
    catalogue: DataFrame,
    created_at: datetime | None = None,
) -> DataFrame:
    """The indicator dimension after the changes.

    A name that lost rows and has none in the changed years is looked for in all of staging, by
    its two columns; without such a name nothing else is read.
    """
    keys = ["series_id", "series_name"]
    same = F.col("series_id").eqNullSafe(F.col("lost_id")) & F.col("series_name").eqNullSafe(F.col("lost_name"))
    lost = materialise(deleted.select(*(F.col(k).alias(n) for k, n in zip(keys, ("lost_id", "lost_name")))).distinct(), "lost-names")
    recent = staged.filter((F.col("year") >= first_year) | F.col("year").isNull()).select(*keys).unionByName(inserted.select(*keys))
    for rows in (recent, staged.select(*keys)):
        if lost.isEmpty():
            break
        lost = materialise(lost.join(rows, same, "left_anti"), "lost-names")
    gone = lost.select(F.col("lost_id").alias("indicator_id"), F.col("lost_name").alias("indicator_name"))
    found = marts.dim_indicators(inserted, catalogue, created_at)
    return _upserted(dim, ["indicator_id", "indicator_name"], gone, found)


def gold_layers(root: str, staged: DataFrame, catalogue: DataFrame, created_at: datetime | None = None) -> dict[str, list[Layer]]:
    """All of gold, built from all of staging."""
    return {
        "dim_indicators": [write_layer(marts.dim_indicators(staged, catalogue, created_at), root, "dim_indicators")],
        "dim_time": [write_layer(marts.dim_time(staged), root, "dim_time")],
        FACT: [write_layer(marts.fct_observations(staged, "current", created_at), root, FACT)],
    }


def build_version(
    spark: SparkSession, root: str, staged: DataFrame, catalogue: DataFrame, created_at: datetime | None = None, after: int = 0
) -> int:
    """A version built from all of staging; returns its number."""
    return publish(spark, root, after, gold_layers(root, staged, catalogue, created_at))


def refreshed_layers(
    snapshot: Snapshot,
    staged: DataFrame,
    inserted: DataFrame,
    deleted: DataFrame,
    catalogue: DataFrame,
    created_at: datetime | None = None,
    max_layers: int = MAX_LAYERS,
) -> dict[str, list[Layer]] | None:
    """Gold of ``snapshot`` brought up to date, not yet published; None if nothing changed."""
    spark, root = snapshot.spark, snapshot.root
    changes = materialise(change_set(inserted, deleted), "changes")
    first = changes.agg(F.year(F.min("from_date"))).first()[0]
    if first is None:
        return None
    time = upsert_time(snapshot.read("dim_time"), staged, inserted, deleted)
    names = upsert_indicators(snapshot.read("dim_indicators"), staged, inserted, deleted, first, catalogue, created_at)
    fact = write_layer(suffix_fact(snapshot, staged, changes, first, created_at), root, FACT, changes)
    tables = {
        "dim_time": [write_layer(time, root, "dim_time")],
        "dim_indicators": [write_layer(names, root, "dim_indicators")],
        FACT: [*snapshot.tables[FACT], fact],
    }
    if len(tables[FACT]) > max_layers:
        whole = Snapshot(spark, root, snapshot.number, tables).read(FACT)
        tables[FACT] = [write_layer(whole, root, FACT)]
    return tables


def refresh_version(
    spark: SparkSession,
    root: str,
    staged: DataFrame,
    inserted: DataFrame,
    deleted: DataFrame,
    catalogue: DataFrame,
    created_at: datetime | None = None,
    max_layers: int = MAX_LAYERS,
) -> int:
    """Publish the version that follows the newest one; returns its number, or the newest's if
    nothing changed.

    ``staged`` is staging after the changes, with its ``year`` (``write_staged``); ``inserted`` and
    ``deleted`` are the rows that it gained and lost. A revision is an inserted vintage.
    Layers beyond ``max_layers`` are written into one.
    """
    snapshot = open_snapshot(spark, root)
    with scratch_scope(spark):
        tables = refreshed_layers(snapshot, staged, inserted, deleted, catalogue, created_at, max_layers)
        return snapshot.number if tables is None else publish(spark, root, snapshot.number, tables)


# --- From raw rows ----------------------------------------------------------

# What tells rows of staging apart; the time of transformation does not.
STAGED_COLUMNS = [c for c in STAGING.names if c != "transformed_at"]


def _years(*rows: DataFrame) -> set[int | None]:
    """The years in which any of the frames has rows: a calendar's worth."""
    found = None
    for df in rows:
        own = df.select(F.year("observation_date").alias("year"))
        found = own if found is None else found.unionByName(own)
    return {r[0] for r in found.distinct().collect()}


def staged_layers(snapshot: Snapshot | None, root: str, inserted: DataFrame, deleted: DataFrame, at: datetime) -> list[Layer]:
    """Staging after the changes: the years that they are in are written anew, all others kept."""
    years = _years(inserted, deleted)
    held = [] if snapshot is None else snapshot.tables[STAGED]
    if not years:
        return held
    rows = inserted.select(*STAGED_COLUMNS)
    if held:
        before = snapshot.by_year(STAGED).filter(in_years(years)).select(*STAGED_COLUMNS)
        rows = before.exceptAll(deleted.select(*STAGED_COLUMNS)).unionByName(rows)
    stamped = rows.withColumn("transformed_at", F.lit(at).cast("timestamp"))
    layer = write_layer(stamped, root, STAGED, years=years)
    unused = [x for x in held if set(x["years"]) <= years]
    return [*(x for x in held if x not in unused), layer]


def refresh_from_run(
    spark: SparkSession,
    root: str,
    bronze: DataFrame,
    ingest_date: str,
    catalogue: DataFrame,
    at: datetime,
    check: Callable[[Snapshot], list[str]] | None = None,
    max_layers: int = MAX_LAYERS,
    folder: str | None = None,
) -> Snapshot:
    """Publish the version that has these raw rows as those of the run date; returns it.

    What the run adds, and of a repeated run what it withdraws, follows from the raw rows that the
    newest version names for that date. Only the years of these rows are transformed again. The
    version is published if ``check`` finds no failure in it; else nothing has changed, and a
    later run starts from the version that there is. ``folder`` is where ``write_run`` has put these
    rows already; without it they are written here.
    """
    numbers = versions(spark, root)
    snapshot = open_snapshot(spark, root, numbers[-1]) if numbers else None
    folder = folder or write_run(bronze, root)
    with scratch_scope(spark):
        clean = lambda rows: staging.stage(silver.clean(rows), at).select(*STAGED_COLUMNS)
        now = clean(spark.read.schema(BRONZE_AT_REST).parquet(folder))
        before = now.limit(0) if snapshot is None else clean(snapshot.run(ingest_date))
        inserted, deleted = (
            materialise(rows.withColumn("transformed_at", F.lit(at).cast("timestamp")), name)
            for rows, name in ((now.exceptAll(before), "inserted"), (before.exceptAll(now), "deleted"))
        )
        staged = {STAGED: staged_layers(snapshot, root, inserted, deleted, at)}
        after = Snapshot(spark, root, 0, staged).by_year(STAGED)
        if snapshot is None:
            gold = gold_layers(root, after.drop("year"), catalogue, at)
        else:
            gold = refreshed_layers(snapshot, after, inserted, deleted, catalogue, at, max_layers)
            gold = gold or {t: x for t, x in snapshot.tables.items() if t != STAGED}
        runs = ({} if snapshot is None else snapshot.runs) | {ingest_date: folder}
        made = Snapshot(spark, root, (snapshot.number if snapshot else 0) + 1, gold | staged, runs)
        failures = check(made) if check else []
        if failures:
            raise CheckFailed("; ".join(failures))
        publish(spark, root, made.number - 1, made.tables, runs)
    return made


class CheckFailed(RuntimeError):
    """A version did not pass its tests and was not published."""
