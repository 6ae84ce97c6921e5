"""Gold: the indicator and time dimensions and the observation fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import at, day_of_week, is_weekend, pct_change, period_start
from tsmedallion.operators.lagging import chunked_lag
from tsmedallion.operators.staging import VINTAGE_ORDER, current_vintage
from tsmedallion.session import materialise

# Rows back. "Year ago" is twelve rows, as the fact defines it; see
# ``yoy_calendar`` for twelve months.
LAGS = {"previous_value": 1, "value_year_ago": 12}


def dim_indicators(
    staged: DataFrame, catalogue: DataFrame, created_at: datetime | None = None
) -> DataFrame:
    """Distinct (series, name) with the catalogue's category and frequency.

    A series outside the catalogue gets NULL for both; a renamed series gets a
    row per name, which the ``unique`` check then reports.
    """
    attributes = catalogue.select("series_id", "category", "frequency")
    return (
        staged.select("series_id", "series_name")
        .distinct()
        .join(attributes, "series_id", "left")
        .select(
            F.col("series_id").alias("indicator_id"),
            F.col("series_name").alias("indicator_name"),
            "category",
            "frequency",
            at(created_at).alias("created_at"),
        )
    )


def dim_time(staged: DataFrame) -> DataFrame:
    """One row per observed date; gaps in the calendar stay gaps."""
    d = F.col("observation_date")
    return (
        staged.select("observation_date")
        .distinct()
        .select(
            d.alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            day_of_week(d).alias("day_of_week"),
            F.dayofyear(d).alias("day_of_year"),
            period_start(d, "month").alias("month_start"),
            period_start(d, "quarter").alias("quarter_start"),
            period_start(d, "year").alias("year_start"),
            is_weekend(d).alias("is_weekend"),
        )
    )


def fact_columns(lagged: DataFrame, created_at: datetime | None) -> DataFrame:
    """The fact's columns of lagged observations."""
    value, prev, year_ago = F.col("value"), F.col("previous_value"), F.col("value_year_ago")
    return lagged.select(
        F.col("series_id").alias("indicator_id"),
        F.col("observation_date").alias("date_key"),
        value.alias("observation_value"),
        prev,
        year_ago,
        pct_change(value, prev).alias("period_change_pct"),
        pct_change(value, year_ago).alias("yoy_change_pct"),
        "data_as_of_date",
        "ingested_at",
        at(created_at).alias("created_at"),
    )


def fct_observations(
    staged: DataFrame, vintages: str = "current", created_at: datetime | None = None
) -> DataFrame:
    """Observations with the previous and the twelve-rows-back value.

    ``current``: newest vintage per (series, date). A series then has at most
    one dated row per calendar day, so a window partition is bounded by the
    calendar. Rows whose date does not parse follow all others of their series
    and may be any share of it; they have no part in that window.

    ``all``: every vintage is a row, ordered by date and then by age. A series
    is unbounded there, hence the chunked lag.
    """
    # Only what the fact shows: the exchanges below carry nothing else.
    observations = staged.select(
        "series_id", "observation_date", "value", "data_as_of_date", "ingested_at"
    )
    if vintages == "current":
        lagged = lagged_current(*_by_date(observations))
    elif vintages == "all":
        lagged = chunked_lag(
            observations,
            key="series_id",
            order=["observation_date", *(c for c in VINTAGE_ORDER if c in observations.columns)],
            value="value",
            offsets=LAGS,
            nulls_last=["observation_date"],
        )
    else:
        raise ValueError(f"vintages must be 'current' or 'all', not {vintages!r}")
    return fact_columns(lagged, created_at)


def _by_date(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The newest vintage of every (series, date), and the rows without a date."""
    has_date = F.col("observation_date").isNotNull()
    return current_vintage(observations.filter(has_date)), observations.filter(~has_date)


def lagged_current(dated: DataFrame, undated: DataFrame) -> DataFrame:
    """Lags over one row per (series, date), and over rows without a date behind them."""
    by_date = Window.partitionBy("series_id").orderBy("observation_date")
    lagged = dated.withColumns({name: F.lag("value", n).over(by_date) for name, n in LAGS.items()})
    if undated.isEmpty():
        return lagged
    return lagged.unionByName(_lagged_undated(dated, undated))


def _lagged_undated(dated: DataFrame, undated: DataFrame) -> DataFrame:
    """Rows without a date, lagged behind the last dated rows of their series.

    There is no bound on their number, hence the chunked lag. It gets of each series
    the dated rows that a lag can reach, at most as many as the longest lag.
    """
    newest_first = Window.partitionBy("series_id").orderBy(F.col("observation_date").desc())
    ends = (
        dated.withColumn("place", F.row_number().over(newest_first))
        .filter(F.col("place") <= max(LAGS.values()))
        .drop("place")
    )
    rows = materialise(undated.unionByName(ends), "undated-rows")
    lagged = chunked_lag(
        rows,
        key="series_id",
        order=["observation_date", *(c for c in VINTAGE_ORDER if c in rows.columns)],
        value="value",
        offsets=LAGS,
        nulls_last=["observation_date"],
    )
    return lagged.filter(F.col("observation_date").isNull())


def yoy_calendar(staged: DataFrame) -> DataFrame:
    """Change against the same date twelve months earlier, if observed.

    29 February looks up 28 February. A range frame of exactly twelve months
    shares the fact's exchange and sort, where a self-join would shuffle twice.
    A row without a date has no date to look up; it is a window partition of its own.
    """
    year_ago = F.expr(
        """first_value(value) OVER (
             PARTITION BY series_id, undated_row ORDER BY observation_date
             RANGE BETWEEN INTERVAL '1' YEAR PRECEDING AND INTERVAL '1' YEAR PRECEDING)"""
    )
    value = F.col("value")
    observations = staged.select(
        "series_id", "observation_date", "value", "data_as_of_date", "ingested_at"
    )
    undated = F.when(F.col("observation_date").isNull(), F.monotonically_increasing_id())
    looked_up = current_vintage(observations).withColumn("undated_row", undated).withColumn(
        "value_12_months_ago", F.when(F.col("observation_date").isNotNull(), year_ago)
    )
    return looked_up.select(
        F.col("series_id").alias("indicator_id"),
        F.col("observation_date").alias("date_key"),
        value.alias("observation_value"),
        "value_12_months_ago",
        pct_change(value, F.col("value_12_months_ago")).alias("yoy_calendar_pct"),
    )


def resample(staged: DataFrame, unit: str) -> DataFrame:
    """Current vintage per series and month, quarter or year.

    All buffers are numbers and dates, so this is a hash aggregation on top of
    at most one row per series and day.
    """
    if unit not in ("month", "quarter", "year"):
        raise ValueError(f"unit must be month, quarter or year, not {unit!r}")
    dated = staged.filter(F.col("observation_date").isNotNull()).select(
        "series_id", "observation_date", "value", "data_as_of_date", "ingested_at"
    )
    return (
        current_vintage(dated)
        .groupBy(
            F.col("series_id").alias("indicator_id"),
            period_start(F.col("observation_date"), unit).alias("period_start"),
        )
        .agg(
            F.count("*").alias("n_observations"),
            F.min_by("value", "observation_date").alias("first_value"),
            F.max_by("value", "observation_date").alias("last_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("mean_value"),
        )
    )


def names_by_date(staged: DataFrame) -> DataFrame:
    """The name of each indicator and as-of date: that of its last ingestion.

    Combined per as-of date before the shuffle, so that an indicator has as many rows as there
    are such dates.
    """
    return staged.groupBy(
        F.col("data_as_of_date").alias("valid_from"), F.col("series_id").alias("indicator_id")
    ).agg(F.max(F.struct("ingested_at", "series_name")).alias("last"))


def name_intervals(names: DataFrame) -> DataFrame:
    """Names by date as intervals in which the name stays."""
    by_date = Window.partitionBy("indicator_id").orderBy(F.col("valid_from").asc_nulls_first())
    changes = (
        names.withColumn("indicator_name", F.col("last.series_name"))
        .withColumn("before", F.lag(F.struct("indicator_name")).over(by_date))
        .filter(
            F.col("before").isNull()
            | ~F.col("before.indicator_name").eqNullSafe(F.col("indicator_name"))
        )
    )
    valid_to = F.lead("valid_from").over(by_date)
    return changes.select(
        "indicator_id",
        "indicator_name",
        "valid_from",
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def indicator_history(staged: DataFrame) -> DataFrame:
    """Names an indicator has had, each with the as-of dates it was valid for.

    ``valid_to`` is the date of the next name, exclusive, and NULL for the current one.
    """
    return name_intervals(names_by_date(staged))
