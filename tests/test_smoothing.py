"""Chunked smoothing against the plain recurrence."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from tsmedallion.operators import smoothing
from tsmedallion.schemas import STAGING

NOW = datetime(2024, 2, 1, 6)


def _staged(spark, rows):
    return spark.createDataFrame([(s, s, d, v, as_of, NOW, NOW) for s, d, v, as_of in rows], STAGING)


def _plain(model, values):
    """Level, trend and seasons in loops over numbers."""
    m = model.cycle
    level, trend = sum(values[:m]) / m, 0.0
    season = [v - level for v in values[:m]]
    out = [None] * m
    for i in range(m, len(values)):
        s = season[i - m]
        out.append(level + trend + s)
        new = model.level * (values[i] - s) + (1 - model.level) * (level + trend)
        trend = model.trend * (new - level) + (1 - model.trend) * trend
        season.append(model.season * (values[i] - new) + (1 - model.season) * s)
        level = new
    return out, level, trend, season[-m:]


@pytest.mark.parametrize("chunks", ["1", "7"])
def test_equals_the_sequential_recurrence(spark, chunks):
    rng = random.Random(2)
    model = smoothing.Smoothing(cycle=6, level=0.4, trend=0.1, season=0.3)
    first = date(2000, 1, 1)
    series = {"LONG": 3_000, "EXACT": 6, "ONE": 7, "SHORT": 5, None: 40, **{f"S{i}": 10 + i for i in range(8)}}
    values = {s: [100 + 0.1 * i + 5 * math.sin(i) + rng.gauss(0, 1) for i in range(n)] for s, n in series.items()}
    rows = [(s, first + timedelta(days=i), v, "2024-01-02") for s, own in values.items() for i, v in enumerate(own)]
    rows += [("LONG", first, -1.0, "2024-01-01"), ("LONG", None, 5.0, "2024-01-01"), ("SHORT", first + timedelta(days=99), float("nan"), "2024-01-01")]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", chunks)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fitted = smoothing.smooth(_staged(spark, rows), model)
        found = fitted.observations.collect()
        states = {r.series_id: r for r in fitted.states.collect()}
        ahead = smoothing.forecast(fitted, 8, model).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for s, own in values.items():
        mine = sorted((r for r in found if r.series_id == s), key=lambda r: r.place)
        assert [r.value for r in mine] == own and [r.place for r in mine] == list(range(len(own)))
        if len(own) < 6:
            assert all(r.forecast is None for r in mine) and s not in states
            continue
        wanted, level, trend, season = _plain(model, own)
        for r, w in zip(mine, wanted):
            assert (r.forecast is None) == (w is None)
            assert w is None or r.forecast == pytest.approx(w, rel=1e-9)
        assert states[s].n_observations == len(own)
        assert states[s].state == pytest.approx([level, trend, *season], rel=1e-9, abs=1e-9)
        steps = [r.forecast for r in sorted((r for r in ahead if r.series_id == s), key=lambda r: r.step)]
        assert steps == pytest.approx([level + (i + 1) * trend + season[i % 6] for i in range(8)], rel=1e-9)


def test_runs_compose():
    model = smoothing.Smoothing(cycle=4)
    values = np.arange(50) ** 1.5
    state = model.start(values[:4])
    whole = model.forecasts(state, values[4:])[1]
    for cut in (4, 5, 20, 50):
        mid = np.linalg.matrix_power(model.matrix(), cut - 4) @ state + model.offset(values[4:cut])
        end = np.linalg.matrix_power(model.matrix(), 50 - cut) @ mid + model.offset(values[cut:])
        assert end == pytest.approx(whole, rel=1e-9)


def test_backtest_beats_the_last_value_on_a_seasonal_series(spark):
    rows = [("S", date(2010 + i // 12, i % 12 + 1, 1), 50 + 0.5 * i + 20 * math.sin(i * math.pi / 6), "2024-01-01") for i in range(120)]
    (row,) = smoothing.backtest(smoothing.smooth(_staged(spark, rows))).collect()
    assert row.n_forecasts == 108 and row.mean_error < 0.25 * row.naive_error


def test_odd_settings_are_refused():
    for bad in ({"cycle": 0}, {"level": 1.5}, {"season": -0.1}):
        with pytest.raises(ValueError):
            smoothing.Smoothing(**bad)
