"""Questions about what was known when: as-of joins, and names kept as valid intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.operators.lagging import by_chunk, chunk_number, sorted_chunks
from tsmedallion.operators.marts import name_intervals, names_by_date


def as_of_join(
    probes: DataFrame,
    vintages: DataFrame,
    keys: list[str],
    known_at: str,
    age: str,
    values: list[str],
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """Every probe with the newest vintage of its keys that is not younger than ``known_at``.

    ``probes`` should come straight from a table scan (``chunked_lag``). ``values`` are columns of
    ``vintages``, NULL where a probe is older than the first vintage, or
    has a NULL key or time. Of vintages of one age the largest by ``tie_break``, then by value,
    counts.

    Both sides are merged in one order over even chunks, so a key of any share of the
    rows, with any number of vintages and probes, is spread over tasks. A chunk's
    probes look back in their chunk; the last vintage before a chunk, which may stand several
    chunks earlier, is the one row that each chunk gets from the others.
    """
    # One vintage per age, combined before the shuffle.
    held = [*tie_break, *(v for v in values if v not in tie_break and v != age)]
    newest = (
        vintages.filter(F.col(age).isNotNull())
        .groupBy(*keys, age)
        .agg(F.max(F.struct(*held)).alias("held"))
        .select(*keys, F.col(age).alias("at"), F.struct(F.col(age), *(F.col(f"held.{h}") for h in held)).alias("vintage"))
    )
    asked = probes.select(
        *keys, F.col(known_at).alias("at"), F.struct(*(F.col(c) for c in probes.columns)).alias("probe")
    )
    merged = newest.withColumn("is_probe", F.lit(False)).unionByName(
        asked.withColumn("is_probe", F.lit(True)), allowMissingColumns=True
    )
    sorting = [F.col(c).asc_nulls_first() for c in (*keys, "at", "is_probe")]
    # Of the vintages there are at most as many as rows; counting them so needs no shuffle.
    number = chunk_number(merged, probes.count() + vintages.count())
    chunked = sorted_chunks(merged, sorting, number)

    # One row per chunk: small enough for one window task and for a broadcast.
    seen = F.struct(*keys, "vintage")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(
        chunked.groupBy("chunk")
        .agg(F.max_by(seen, F.when(~F.col("is_probe"), F.col("pos"))).alias("last_seen"))
        .select("chunk", F.last("last_seen", ignorenulls=True).over(before).alias("carried"))
    )
    in_chunk = Window.partitionBy("chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(~F.col("is_probe"), seen), ignorenulls=True).over(in_chunk)
    found = (
        by_chunk(chunked, number).withColumn("seen", own)
        .filter("is_probe")
        .join(carried, "chunk", "left")
        .withColumn("seen", F.coalesce("seen", "carried"))
    )
    same = F.col("at").isNotNull()
    for k in keys:
        same &= F.coalesce(F.col(f"seen.{k}") == F.col(k), F.lit(False))
    return found.select(
        "probe.*", *(F.when(same, F.col(f"seen.vintage.{v}")).alias(_free(v, probes.columns)) for v in values)
    )


def _free(name: str, taken: list[str]) -> str:
    return name if name not in taken else f"vintage_{name}"


# --- Names as intervals -----------------------------------------------------


def _first(day: str) -> Column:
    """As-of dates as text, of which a missing one comes first."""
    return F.coalesce(F.col(day), F.lit(""))


def refresh_history(history: DataFrame, names: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Name intervals and their state after new rows of staging, in any order of as-of dates.

    ``names`` is the state (``names_by_date`` of all rows before), ``history`` its intervals. An
    indicator's intervals that began before its earliest new as-of date stay; the last of
    these is reopened, and closed again by what follows. Of the state only the dates from there on
    are read. Indicators without new rows stay as they are.
    """
    new = names_by_date(delta)
    changed = new.groupBy(F.col("indicator_id").alias("touched_id")).agg(F.min(_first("valid_from")).alias("from_date"))
    touched = F.col("indicator_id").eqNullSafe(F.col("touched_id"))
    later = names.join(changed, touched).filter(_first("valid_from") >= F.col("from_date")).select(*names.columns)
    merged = (
        later.unionByName(new)
        .groupBy("valid_from", "indicator_id")
        .agg(F.max("last").alias("last"))
        .select(*names.columns)
    )
    earlier = names.join(changed, touched, "left").filter(
        F.col("from_date").isNull() | (_first("valid_from") < F.col("from_date"))
    ).select(*names.columns)

    dated = history.join(changed, touched, "left")
    reopened = (
        dated.filter(_first("valid_from") < F.col("from_date"))
        .groupBy(F.col("indicator_id").alias("seed_id"))
        .agg(F.max_by(F.struct("valid_from", "indicator_name"), _first("valid_from")).alias("seed"))
    )
    seeds = reopened.select(
        F.col("seed.valid_from").alias("valid_from"),
        F.col("seed_id").alias("indicator_id"),
        F.struct(F.lit(None).cast(names.schema["last"].dataType["ingested_at"].dataType).alias("ingested_at"),
                 F.col("seed.indicator_name").alias("series_name")).alias("last"),
    )
    kept = (
        dated.join(reopened, F.col("indicator_id").eqNullSafe(F.col("seed_id")), "left")
        .filter(F.col("from_date").isNull() | (_first("valid_from") < _first("seed.valid_from")))
        .select(*history.columns)
    )
    return kept.unionByName(name_intervals(seeds.unionByName(merged))), earlier.unionByName(merged)


def names_valid_at(rows: DataFrame, history: DataFrame, key: str, at: str, until: str) -> DataFrame:
    """``rows`` with the ``indicator_name`` that was valid at their as-of date, else NULL.

    An interval is put into every month that it touches, an open one up to ``until``, the last
    date asked for. So the join is an equality on key and month, which spreads a hot key over
    the calendar, and each row meets the few intervals of its month.
    """
    month = lambda c: F.trunc(F.try_to_date(c), "month")
    end = F.coalesce(F.col("valid_to"), F.lit(until))
    months = F.sequence(
        month(F.col("valid_from")),
        F.greatest(month(F.col("valid_from")), month(end)),
        F.expr("interval 1 month"),
    )
    named = history.select(
        F.col("indicator_id").alias("name_key"),
        "indicator_name",
        F.col("valid_from").alias("name_from"),
        F.col("valid_to").alias("name_to"),
        F.explode(months).alias("name_month"),
    )
    asked = rows.withColumn("asked_month", month(F.col(at)))
    valid = (F.col("name_from") <= F.col(at)) & (F.col("name_to").isNull() | (F.col(at) < F.col("name_to")))
    return asked.join(
        named, (F.col(key) == F.col("name_key")) & (F.col("asked_month") == F.col("name_month")) & valid, "left"
    ).drop("name_key", "name_from", "name_to", "name_month", "asked_month")
