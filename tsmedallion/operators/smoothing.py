"""Seasonal exponential smoothing as a scan over chunks, so that a long series is no single task.

One step of additive smoothing (level, trend and the seasons of one cycle) is an affine map of
the state: ``state' = A state + b value``. So is a run of n steps, with ``A^n`` and one
vector that depends on the run's values. Chunks of sorted rows compute these vectors side by side;
a scan over one small row per chunk composes them into the state at each chunk's start;
and the chunks then run the recurrence from there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.functions.scalar import finite
from tsmedallion.operators.lagging import sorted_chunks
from tsmedallion.operators.staging import current_vintage
from tsmedallion.session import materialise


@dataclass(frozen=True)
class Smoothing:
    """``cycle`` observations make a season; the rates weigh what is new, each from 0 to 1."""

    cycle: int = 12
    level: float = 0.3
    trend: float = 0.05
    season: float = 0.2

    def __post_init__(self):
        if self.cycle < 1 or not all(0 <= r <= 1 for r in (self.level, self.trend, self.season)):
            raise ValueError("the cycle must be positive and the rates from 0 to 1")

    def start(self, values: np.ndarray) -> np.ndarray:
        """The state behind the first cycle: its mean, no trend, and the distances from the mean."""
        return np.concatenate([[values.mean(), 0.0], values - values.mean()])

    def step(self, state: np.ndarray, value: float) -> np.ndarray:
        """The state is level, trend and the seasons, that of the next observation first."""
        level, trend, season = state[0], state[1], state[2]
        new_level = self.level * (value - season) + (1 - self.level) * (level + trend)
        new_trend = self.trend * (new_level - level) + (1 - self.trend) * trend
        new_season = self.season * (value - new_level) + (1 - self.season) * season
        return np.concatenate([[new_level, new_trend], state[3:], [new_season]])

    def matrix(self) -> np.ndarray:
        """A step without its value."""
        return np.column_stack([self.step(unit, 0.0) for unit in np.eye(self.cycle + 2)])

    def offset(self, values: np.ndarray) -> np.ndarray:
        """What a run adds to the state that it starts with."""
        state = np.zeros(self.cycle + 2)
        for v in values:
            state = self.step(state, v)
        return state

    def forecasts(self, state: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step ahead before each value; and the state behind the last."""
        out = np.empty(len(values))
        for i, v in enumerate(values):
            out[i] = state[0] + state[1] + state[2]
            state = self.step(state, v)
        return out, state

    def ahead(self, state: np.ndarray, steps: int) -> np.ndarray:
        n = np.arange(steps)
        return state[0] + (n + 1) * state[1] + state[2 + n % self.cycle]


@dataclass
class Fitted:
    observations: DataFrame
    """series_id, observation_date, value, place (from 0), forecast (made one step before; NULL in the first cycle)."""
    states: DataFrame
    """series_id, n_observations and state (level, trend, seasons) behind the last observation."""


def _scanned(model: Smoothing, maps: DataFrame, starts: DataFrame) -> DataFrame:
    """The state at the start of each chunk of a series, from one row per chunk."""
    matrix = model.matrix()

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        state, found = model.start(np.array(rows["first_values"].iloc[0])), []
        for n, offset in zip(rows["n_steps"], rows["offset"]):
            found.append(state)
            state = np.linalg.matrix_power(matrix, int(n)) @ state + np.array(offset)
        return rows[["chunk", "series_id"]].assign(state=found, last_state=[None] * (len(found) - 1) + [state])

    joined = maps.join(starts, F.col("series_id").eqNullSafe(F.col("start_id"))).drop("start_id")
    return joined.groupBy("series_id").applyInPandas(
        scan, "chunk int, series_id string, state array<double>, last_state array<double>"
    )


def smooth(staged: DataFrame, model: Smoothing = Smoothing()) -> Fitted:
    """Fit current finite observations of every series in order of date.

    A series of one cycle or less has no forecasts, and of less than one cycle no state. Rows
    without a date take no part.
    """
    usable = F.col("observation_date").isNotNull() & finite(F.col("value")).isNotNull()
    observations = staged.filter(usable).select("series_id", "observation_date", "value", "data_as_of_date", "ingested_at")
    current = materialise(current_vintage(observations).select("series_id", "observation_date", "value"), "current")
    chunked = sorted_chunks(current, [F.col("series_id").asc_nulls_first(), F.col("observation_date")])

    # Where each chunk's part of a series begins, in the chunk and in the series.
    earlier = Window.partitionBy("series_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialise(
        chunked.groupBy("chunk", "series_id")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
        .withColumn("first_place", F.coalesce(F.sum("n").over(earlier), F.lit(0))),
        "parts",
    )
    # Of each series the first cycle: few rows, from the parts that hold them.
    heads = parts.filter(F.col("first_place") < model.cycle).select(
        F.col("chunk").alias("head_chunk"), F.col("series_id").alias("start_id"), "first_pos", "first_place"
    )
    place = F.col("pos") - F.col("first_pos") + F.col("first_place")
    starts = (
        chunked.join(heads, (F.col("chunk") == F.col("head_chunk")) & F.col("series_id").eqNullSafe(F.col("start_id")))
        .withColumn("place", place)
        .filter(F.col("place") < model.cycle)
        .groupBy("start_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda s: s.value).alias("first_values"))
        .filter(F.size("first_values") == model.cycle)
    )

    def split(rows: pd.DataFrame, own: pd.DataFrame):
        """Each series of a chunk: its part, its rows' places, and its rows behind the first cycle."""
        rows = rows.sort_values("pos")
        for part in own.itertuples():
            low = int(np.searchsorted(rows["pos"].to_numpy(), part.first_pos))
            mine = rows.iloc[low : low + int(part.n)]
            places = int(part.first_place) + np.arange(len(mine))
            yield part, mine, places, places >= model.cycle

    def to_maps(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = []
        for part, mine, _, runs in split(rows, own):
            values = mine["value"].to_numpy()[runs]
            found.append((part.chunk, part.series_id, len(values), model.offset(values)))
        return pd.DataFrame(found, columns=["chunk", "series_id", "n_steps", "offset"])

    def run(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = []
        for part, mine, places, runs in split(rows, own):
            forecast = np.full(len(mine), np.nan)
            if part.state is not None:
                forecast[runs], _ = model.forecasts(np.array(part.state), mine["value"].to_numpy()[runs])
            found.append(mine[["series_id", "observation_date", "value"]].assign(place=places, forecast=forecast))
        return pd.concat(found) if found else pd.DataFrame(columns=["series_id", "observation_date", "value", "place", "forecast"])

    by_chunk = chunked.groupBy("chunk")
    maps = by_chunk.cogroup(parts.groupBy("chunk")).applyInPandas(
        to_maps, "chunk int, series_id string, n_steps long, offset array<double>"
    )
    states = materialise(_scanned(model, maps, starts), "states")
    same = (F.col("chunk") == F.col("state_chunk")) & F.col("series_id").eqNullSafe(F.col("state_id"))
    named = states.select(F.col("chunk").alias("state_chunk"), F.col("series_id").alias("state_id"), "state")
    begun = parts.join(named, same, "left").drop("state_chunk", "state_id")
    fitted = by_chunk.cogroup(begun.groupBy("chunk")).applyInPandas(
        run, "series_id string, observation_date date, value double, place long, forecast double"
    )
    sizes = parts.groupBy(F.col("series_id").alias("size_id")).agg(F.sum("n").alias("n_observations"))
    last = states.filter(F.col("last_state").isNotNull()).select("series_id", F.col("last_state").alias("state"))
    return Fitted(
        fitted.withColumn("forecast", F.nanvl("forecast", F.lit(None).cast("double"))),
        last.join(sizes, F.col("series_id").eqNullSafe(F.col("size_id"))).select("series_id", "n_observations", "state"),
    )


def forecast(fitted: Fitted, steps: int, model: Smoothing = Smoothing()) -> DataFrame:
    """The next ``steps`` observations of every series that has a state: series_id, step, forecast."""

    def run(frames):
        for rows in frames:
            found = [
                (r.series_id, i + 1, float(v)) for r in rows.itertuples() for i, v in enumerate(model.ahead(np.array(r.state), steps))
            ]
            yield pd.DataFrame(found, columns=["series_id", "step", "forecast"])

    return fitted.states.mapInPandas(run, "series_id string, step int, forecast double")


def backtest(fitted: Fitted) -> DataFrame:
    """Per series the mean absolute error one step ahead, and that of repeating the last value."""
    by_date = Window.partitionBy("series_id").orderBy("observation_date")
    errors = fitted.observations.withColumn("naive", F.lag("value").over(by_date)).filter(F.col("forecast").isNotNull())
    return errors.groupBy("series_id").agg(
        F.count("*").alias("n_forecasts"),
        F.avg(F.abs(F.col("value") - F.col("forecast"))).alias("mean_error"),
        F.avg(F.abs(F.col("value") - F.col("naive"))).alias("naive_error"),
    )
