"""Learned ranges, rolling anomalies and time-weighted aggregates."""

from __future__ import annotations

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tsmedallion.operators import anomalies, calendar, ranges
from tsmedallion.schemas import STAGING

NOW = datetime(2024, 2, 1, 6)


def _staged(spark, rows):
    return spark.createDataFrame([(s, s, d, v, "2024-01-01", NOW, NOW) for s, d, v in rows], STAGING)


def test_rank_error_of_merged_sketches_stays_in_its_bound(spark):
    values = spark.range(200_000).select(F.lit("S").alias("k"), F.col("id").cast("double").alias("v"))
    parts = [ranges.learn(values.filter(F.col("v") % 7 == i), "k", "v") for i in range(7)]
    for sketches in (ranges.merge(*parts), ranges.learn(values, "k", "v")):
        quantiles = sketches.select("k", *(F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{int(q * 100)}") for q in (0.1, 0.25, 0.5, 0.9)))
        row = quantiles.first()
        assert all(abs(row[f"q{q}"] / 200_000 - q / 100) < 0.0165 for q in (10, 25, 50, 90))
    assert ranges.bounds(ranges.merge(*parts)).first()["n_values"] == 200_000


def test_small_sketches_are_exact_and_merge_to_one_shot(spark):
    rng = random.Random(1)
    rows = [(rng.choice("AB"), rng.random()) for _ in range(300)] + [("A", float("nan")), ("A", float("inf")), ("A", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    half = [ranges.learn(df.filter(F.coalesce(F.col("v") < 0.5, F.lit(False)) == b), "k", "v", 400) for b in (True, False)]
    merged, once = (sorted((tuple(r) for r in ranges.bounds(s).collect()), key=str) for s in (ranges.merge(*half), ranges.learn(df, "k", "v", 400)))
    assert merged == once
    own = sorted(v for k, v in rows if k == "B")
    lower, upper = own[-(-len(own) // 4) - 1], own[-(-3 * len(own) // 4) - 1]
    found = next(r for r in once if r[0] == "B")
    assert found[1:] == (len(own), lower - 3 * (upper - lower), upper + 3 * (upper - lower))


def test_quarantine_takes_what_is_outside_and_keeps_the_rest(spark, tmp_path):
    limits = spark.createDataFrame([("A", 0.0, 10.0), ("B", None, 5.0)], "k string, min_value double, max_value double")
    rows = [("A", -1.0), ("A", 0.0), ("A", 11.0), ("A", None), ("A", float("nan")), ("B", -99.0), ("B", 6.0), ("C", 1e9), (None, 1.0)]
    kept = ranges.quarantine(spark.createDataFrame(rows, "k string, v double"), "k", "v", limits, str(tmp_path / "q"))
    assert kept.columns == ["k", "v"]
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in spark.createDataFrame([rows[i] for i in (1, 3, 5, 7, 8)], "k string, v double").collect()]))
    bad = [(r.k, str(r.v), r.max_value) for r in spark.read.parquet(str(tmp_path / "q")).collect()]
    assert sorted(bad) == [("A", "-1.0", 10.0), ("A", "11.0", 10.0), ("A", "nan", 10.0), ("B", "6.0", 5.0)]


# --- Anomalies --------------------------------------------------------------


def test_rolling_anomalies_against_plain_medians(spark):
    rng = random.Random(4)
    first = date(2024, 1, 1)
    rows = [("S", first + timedelta(days=i), rng.gauss(0, 1) + (50 if i == 40 else 0)) for i in range(60)]
    rows += [("FLAT", first + timedelta(days=i), 2.0 if i != 15 else 3.0) for i in range(20)]
    rows += [("SHORT", first, 1.0), ("SHORT", first + timedelta(days=1), 100.0), ("S", None, 9.0), ("S", first + timedelta(days=70), float("nan"))]
    found = {(r.indicator_id, r.date_key): r for r in anomalies.rolling_anomalies(_staged(spark, rows), 12, 5).collect()}
    assert len(found) == 82
    by_series = {}
    for s, d, v in rows:
        if d is None or v != v:
            continue
        before = by_series.setdefault(s, [])
        r, seen = found[s, d], before[-12:]
        assert r.n_before == len(seen)
        if not seen:
            assert r.median_before is None and r.robust_score is None and not r.is_anomaly
        else:
            median = statistics.median(seen)
            mad = statistics.median([abs(x - median) for x in seen])
            assert r.median_before == pytest.approx(median) and r.deviation_before == pytest.approx(mad, abs=1e-12)
            if len(seen) < 5:
                assert r.robust_score is None and not r.is_anomaly
            elif mad:
                assert r.robust_score == pytest.approx(abs(v - median) / (1.4826 * mad))
                assert r.is_anomaly == (r.robust_score > 3.5)
            else:
                assert r.robust_score is None and r.is_anomaly == (v != median)
        before.append(v)
    assert found["S", first + timedelta(days=40)].is_anomaly and found["FLAT", first + timedelta(days=15)].is_anomaly
    assert sum(r.is_anomaly for r in found.values() if r.indicator_id == "FLAT") == 1


# --- The calendar -----------------------------------------------------------


def test_gaps_hold_the_last_value_over_months_and_leap_days(spark):
    rows = [("A", date(2024, 1, 30), 10.0), ("A", date(2024, 2, 28), 20.0), ("A", date(2024, 3, 2), 40.0), ("B", date(2023, 12, 31), 1.0), ("A", None, 7.0)]
    found = {(r.indicator_id, r.level, r.period_start): r for r in calendar.time_weighted(_staged(spark, rows)).collect()}
    february = found["A", "month", date(2024, 2, 1)]
    assert (february.n_days, february.n_observations, february.last_value) == (29, 1, 20.0)
    assert february.mean_value == pytest.approx((27 * 10 + 2 * 20) / 29)
    march = found["A", "month", date(2024, 3, 1)]
    assert (march.n_days, march.mean_value, march.last_value) == (2, 30.0, 40.0)
    quarter = found["A", "quarter", date(2024, 1, 1)]
    assert quarter.n_days == found["A", "year", date(2024, 1, 1)].n_days == 2 + 29 + 2
    assert quarter.mean_value == pytest.approx((29 * 10 + 3 * 20 + 40) / 33)
    assert found["B", "year", date(2023, 1, 1)].n_days == 1 and len(found) == 5 + 3


def test_one_pass_with_grouping_sets(spark):
    plan = calendar.time_weighted(_staged(spark, []))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
