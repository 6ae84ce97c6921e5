"""Staging, gold, dashboard, data tests and streaming on small fixtures."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tsmedallion.operators import correlation, dashboard, lagging, marts, quality, silver, staging
from tsmedallion.schemas import (
    BRONZE_AT_REST,
    CATALOGUE,
    DIM_INDICATORS,
    DIM_TIME,
    FCT_OBSERVATIONS,
    SILVER,
    STAGING,
    default_catalogue,
    schema_drift,
)
from tsmedallion.sources import bronze, tables
from tsmedallion.streaming import silver_stream

NOW = datetime(2024, 2, 1, 6)


def _staged(spark, rows):
    """Rows of (series, date, value[, as_of[, ingested_at[, name]]])."""
    full = []
    for series, day, value, *rest in rows:
        as_of, at, name = (list(rest) + [None] * 3)[:3]
        full.append((series, name or series, day, value, as_of or "2024-01-01", at or NOW, NOW))
    return spark.createDataFrame(full, STAGING)


def _month(i):
    return date(2020 + i // 12, i % 12 + 1, 1)


# --- Staging ----------------------------------------------------------------


def test_stage_keeps_valid_rows(spark):
    rows = [
        ("S", "Name", date(2024, 1, 1), 1.0, "1.0", False, True, "2024-01-05", "x", "2024-01-06T07:08:09.123456", "2024-01-01"),
        ("S", "Name", date(2024, 1, 2), None, ".", True, False, "2024-01-05", "x", "2024-01-06T07:08:09", "2024-01-02"),
    ]
    staged = staging.stage(spark.createDataFrame(rows, SILVER), NOW)
    assert schema_drift(staged, STAGING) == []
    (row,) = staged.collect()
    assert row["data_as_of_date"] == "2024-01-05"
    assert row["ingested_at"] == datetime(2024, 1, 6, 7, 8, 9, 123456)


def test_current_vintage_takes_the_newest(spark):
    day = date(2024, 1, 1)
    staged = _staged(spark, [
        ("S", day, 1.0, "2024-01-02", datetime(2024, 1, 9)),
        ("S", day, 2.0, "2024-01-03", datetime(2024, 1, 4)),
        ("S", day, 3.0, "2024-01-03", datetime(2024, 1, 5)),
        ("T", day, 4.0),
        ("T", None, 5.0),
        ("T", None, 6.0),
        ("T", None, 6.0),
    ])
    found = staging.current_vintage(staged)
    assert found.columns == STAGING.names
    # Rows without a date are not vintages of one another.
    assert sorted((r["series_id"], str(r["observation_date"]), r["value"]) for r in found.collect()) == [
        ("S", str(day), 3.0),
        ("T", str(day), 4.0),
        ("T", "None", 5.0),
        ("T", "None", 6.0),
        ("T", "None", 6.0),
    ]


def test_rows_without_a_date_reach_the_fact_and_are_reported(spark):
    bronze_rows = _bronze(spark, "2024-02-01", [("A", "2024-01-01", "1"), ("A", "bad1", "2"), ("A", "bad2", "3")])
    cleaned = silver.clean(bronze_rows)
    assert {r["date_raw"] for r in cleaned.collect()} == {"2024-01-01", "bad1", "bad2"}
    staged = staging.stage(cleaned, NOW)
    fact = marts.fct_observations(staged, created_at=NOW)
    assert sorted((r["observation_value"], r["previous_value"] or 0) for r in fact.collect()) == [(1, 0), (2, 1), (3, 2)]
    report = quality.not_null(staged, "staged", ["observation_date"])
    assert report.first()["failures"] == 2


def test_rows_without_a_date_may_be_any_share_of_a_series(spark, monkeypatch):
    """They follow the dated rows in chunks; the window by series has none of them."""
    kept = []
    chunks = lagging.sorted_chunks
    monkeypatch.setattr(lagging, "sorted_chunks", lambda *a: kept.append(chunks(*a)) or kept[-1])
    monkeypatch.setattr(lagging, "_chunks", lambda df: [6])
    dated = [("HOT", date(2020, 1, 1) + timedelta(days=i), float(i)) for i in range(400)] + [("B", date(2020, 1, 1), 3.0)]
    undated = [("HOT", None, float(i % 50), f"2024-01-{i % 28 + 1:02d}") for i in range(300)]
    undated += [("B", None, 5.0), ("B", None, 4.0), (None, None, 6.0), (None, None, None)]
    fact = marts.fct_observations(_staged(spark, dated + undated), "current", NOW)
    found = sorted(map(str, ((r.indicator_id, r.date_key, r.observation_value, r.previous_value, r.value_year_ago) for r in fact.collect())))
    wanted = []
    for series in ("HOT", "B", None):
        own = [(d, v) for s, d, v in dated if s == series]
        behind = sorted((r[3] if len(r) > 3 else "2024-01-01", r[2] is not None, r[2] or 0.0, r[2]) for r in undated if r[0] == series)
        own += [(None, v) for *_, v in behind]
        back = lambda i, n: own[i - n][1] if i >= n else None  # noqa: B023, E731
        wanted += [(series, d, v, back(i, 1), back(i, 12)) for i, (d, v) in enumerate(own)]
    assert found == sorted(map(str, wanted))
    sizes = [r["count"] for r in kept[0].groupBy("chunk").count().collect()]
    assert sum(sizes) == 304 + 12 + 1 and len(sizes) > 1 and max(sizes) < 200
    yearly = marts.yoy_calendar(_staged(spark, dated + undated))
    assert yearly.filter("date_key is null and value_12_months_ago is null").count() == 304
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(observation_date" in plan[plan.index("Window ") :]
    plan = yearly._jdf.queryExecution().executedPlan().toString()
    assert "undated_row" in next(line for line in plan.split("\n") if "Exchange hashpartitioning(series_id" in line)


def test_as_of_ignores_younger_vintages(spark):
    day = date(2024, 1, 1)
    staged = _staged(spark, [("S", day, 1.0, "2024-01-02"), ("S", day, 2.0, "2024-02-02")])
    assert [r["value"] for r in staging.as_of(staged, date(2024, 1, 31)).collect()] == [1.0]
    assert [r["value"] for r in staging.as_of(staged, "2024-02-02").collect()] == [2.0]
    assert staging.as_of(staged, "2024-01-01").count() == 0


# --- Gold -------------------------------------------------------------------


def test_dim_indicators(spark):
    staged = _staged(spark, [
        ("GDP", _month(0), 1.0),
        ("GDP", _month(1), 1.0),
        ("OTHER", _month(0), 1.0),
        ("GDP", _month(2), 1.0, None, None, "Renamed"),
    ])
    dims = marts.dim_indicators(staged, default_catalogue(spark), NOW)
    assert schema_drift(dims, DIM_INDICATORS) == []
    assert sorted(tuple(r)[:4] for r in dims.collect()) == [
        ("GDP", "GDP", "Output", "Quarterly/Monthly"),
        ("GDP", "Renamed", "Output", "Quarterly/Monthly"),
        ("OTHER", "OTHER", None, None),
    ]


def test_dim_time(spark):
    dims = marts.dim_time(_staged(spark, [("A", date(2024, 2, 10), 1.0), ("B", date(2024, 2, 10), 1.0)]))
    assert schema_drift(dims, DIM_TIME) == []
    assert [tuple(r)[2:] for r in dims.collect()] == [
        (2024, 1, 2, 10, 6, 41, date(2024, 2, 1), date(2024, 1, 1), date(2024, 1, 1), True)
    ]


def test_fact_lags(spark):
    rows = [("S", _month(i), float(i)) for i in range(14)] + [("S", None, 99.0)]
    random.Random(1).shuffle(rows)
    fact = marts.fct_observations(_staged(spark, rows), created_at=NOW)
    assert schema_drift(fact, FCT_OBSERVATIONS) == []
    by_date = {r["date_key"]: r for r in fact.collect()}
    assert by_date[_month(0)]["previous_value"] is None
    assert by_date[_month(1)]["previous_value"] == 0.0
    assert by_date[_month(1)]["period_change_pct"] is None
    assert by_date[_month(2)]["period_change_pct"] == 100.0
    assert by_date[_month(11)]["value_year_ago"] is None
    assert by_date[_month(13)]["value_year_ago"] == 1.0
    assert by_date[_month(13)]["yoy_change_pct"] == 1200.0
    assert by_date[None]["previous_value"] == 13.0


def test_unknown_vintage_mode(spark):
    with pytest.raises(ValueError, match="vintages"):
        marts.fct_observations(_staged(spark, [("S", _month(0), 1.0)]), "newest")


def _brute_force_lags(rows):
    """(series, date, as_of, ingested, name, value) rows with lag 1 and 12."""
    def order(r):
        return (r[1] is None, r[1] or date.min, r[2], r[3], r[5], r[4])

    found = []
    for series in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == series), key=order)
        for i, r in enumerate(ordered):
            found.append((*r, ordered[i - 1][5] if i else None, ordered[i - 12][5] if i > 11 else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 40])
@pytest.mark.parametrize("shape", ["hot series", "copies", "many series", "short"])
def test_lag_over_all_vintages(spark, partitions, shape):
    """Chunked lag against brute force, with chunks longer and far shorter
    than the twelve rows a row can look back."""
    rng = random.Random(f"{partitions} {shape}")
    n = {"hot series": 400, "copies": 300, "many series": 300, "short": 15}[shape]
    rows = []
    for _ in range(n):
        series = {
            "hot series": lambda: rng.choice(["HOT", "HOT", "HOT", "A", None]),
            "copies": lambda: "S",
            "many series": lambda: f"S{rng.randrange(60)}",
            "short": lambda: "S",
        }[shape]()
        copy = shape == "copies" and rng.random() < 0.7
        rows.append((
            series,
            date(2024, 1, 1) if copy else rng.choice([None, *(_month(i) for i in range(30))]),
            "2024-01-01" if copy else f"2024-01-{rng.randrange(1, 29):02d}",
            NOW if copy else NOW + timedelta(hours=rng.randrange(100)),
            "name",
            1.0 if copy else float(rng.randrange(50)),
        ))
    staged = _staged(spark, [(s, d, v, a, at, name) for s, d, a, at, name, v in rows])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lagged = lagging.chunked_lag(
            staged.drop("transformed_at"),
            "series_id",
            ["observation_date", *staging.VINTAGE_ORDER],
            "value",
            {"lag_1": 1, "lag_12": 12},
            ["observation_date"],
        )
        found = lagged.select(
            "series_id", "observation_date", "data_as_of_date", "ingested_at", "series_name",
            "value", "lag_1", "lag_12",
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, found), key=str) == _brute_force_lags(rows)


def test_a_group_of_copies_is_spread_over_chunks(spark, monkeypatch):
    """Chunks stay even when two thirds of all rows are the same row."""
    chunks = []

    def spy(df, name):
        chunks.extend(r["count"] for r in df.groupBy("chunk").count().collect())
        return df

    monkeypatch.setattr(lagging, "materialise", spy)
    staged = _staged(spark, [("S", _month(0), 1.0)]).crossJoin(spark.range(8000)).drop("id")
    staged = staged.union(_staged(spark, [("S", _month(i % 24), float(i)) for i in range(4000)]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marts.fct_observations(staged, "all")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(chunks) == 12_000
    assert len(chunks) == 8
    assert max(chunks) < 2 * 12_000 / 8


def test_chunks_follow_the_size_of_the_input(spark, monkeypatch, tmp_path):
    spark.range(100_000).selectExpr("id", "uuid() AS text").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert lagging._chunks(table) == []
    monkeypatch.setattr(lagging, "CHUNK_BYTES", 100_000)
    (many,) = lagging._chunks(table)
    assert many > 20


def test_no_task_sorts_more_rows_than_a_chunk_has(spark, monkeypatch):
    """Rows that compress to next to nothing are still many rows in a sort; AQE is on."""
    kept = []
    chunks = lagging.sorted_chunks
    monkeypatch.setattr(lagging, "sorted_chunks", lambda *a: kept.append(chunks(*a)) or kept[-1])
    staged = _staged(spark, [("S", _month(i % 24), float(i % 50)) for i in range(600)]).crossJoin(spark.range(20)).drop("id")
    shown = lambda df: sorted((tuple(r) for r in df.drop("created_at").collect()), key=str)
    whole = shown(marts.fct_observations(staged, "all"))
    monkeypatch.setattr(lagging, "CHUNK_ROWS", 1000, raising=False)
    fact = marts.fct_observations(staged, "all")
    assert shown(fact) == whole
    written = [r["count"] for r in kept[1].groupBy("chunk").count().collect()]
    windowed = [r["count"] for r in fact.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    for sizes in (written, windowed):
        assert sum(sizes) == 12_000 and len(sizes) >= 10 and max(sizes) < 2_000


def test_calendar_yoy(spark):
    rows = [
        ("S", date(2023, 2, 28), 100.0),
        ("S", date(2024, 2, 28), 110.0),
        ("S", date(2024, 2, 29), 120.0),
        ("S", date(2024, 3, 31), 130.0),
        ("S", None, 5.0),
        ("T", date(2023, 3, 31), 7.0),
    ]
    found = {
        (r["indicator_id"], r["date_key"]): (r["value_12_months_ago"], r["yoy_calendar_pct"])
        for r in marts.yoy_calendar(_staged(spark, rows)).collect()
    }
    assert found[("S", date(2024, 2, 28))] == (100.0, 10.0)
    assert found[("S", date(2024, 2, 29))] == (100.0, 20.0)
    assert found[("S", date(2024, 3, 31))] == (None, None)
    assert found[("S", None)] == (None, None)
    assert len(found) == len(rows)


def test_resample(spark):
    rows = [
        ("S", date(2024, 1, 1), 1.0, "2024-01-02"),
        ("S", date(2024, 1, 1), 2.0, "2024-01-03"),
        ("S", date(2024, 1, 31), 4.0),
        ("S", date(2024, 2, 1), 9.0),
        ("S", None, 100.0),
    ]
    found = marts.resample(_staged(spark, rows), "month").orderBy("period_start").collect()
    assert [tuple(r) for r in found] == [
        ("S", date(2024, 1, 1), 2, 2.0, 4.0, 2.0, 4.0, 3.0),
        ("S", date(2024, 2, 1), 1, 9.0, 9.0, 9.0, 9.0, 9.0),
    ]
    (year,) = marts.resample(_staged(spark, rows), "year").collect()
    assert year["n_observations"] == 3 and year["last_value"] == 9.0
    with pytest.raises(ValueError, match="unit"):
        marts.resample(_staged(spark, rows), "week")


def test_indicator_history(spark):
    day = _month(0)
    rows = [
        ("S", day, 1.0, "2024-01-01", NOW, "Old"),
        ("S", day, 1.0, "2024-01-02", NOW, "Old"),
        ("S", day, 1.0, "2024-01-03", NOW, "Mid"),
        ("S", day, 1.0, "2024-01-03", NOW + timedelta(hours=1), "New"),
        ("S", day, 1.0, "2024-01-04", NOW, "New"),
        ("S", day, 1.0, "2024-01-05", NOW, "Old"),
        ("T", day, 1.0, "2024-01-04", NOW, "Only"),
    ]
    found = marts.indicator_history(_staged(spark, rows)).collect()
    assert sorted(map(tuple, found)) == [
        ("S", "New", "2024-01-03", "2024-01-05", False),
        ("S", "Old", "2024-01-01", "2024-01-03", False),
        ("S", "Old", "2024-01-05", None, True),
        ("T", "Only", "2024-01-04", None, True),
    ]


# --- Dashboard --------------------------------------------------------------


@pytest.fixture(scope="module")
def gold(spark):
    rows = [(s, _month(i), float(i * k + 1)) for s, k in (("GDP", 1), ("DFF", 2)) for i in range(30)]
    staged = _staged(spark, rows)
    return (
        marts.fct_observations(staged, created_at=NOW),
        marts.dim_indicators(staged, default_catalogue(spark), NOW),
        marts.dim_time(staged),
    )


def test_star(gold):
    assert dashboard.star(*gold).columns == dashboard.STAR
    assert dashboard.star(*gold).count() == 60
    assert dashboard.star(*gold, ["GDP", "NONE"]).count() == 30
    with pytest.raises(ValueError, match="at least one"):
        dashboard.star(*gold, [])


def test_star_drops_rows_without_a_dimension(gold):
    fct, indicators, time = gold
    assert dashboard.star(fct, indicators.filter("indicator_id = 'GDP'"), time).count() == 30
    assert dashboard.star(fct, indicators, time.filter("year = 2020")).count() == 24


def test_dashboard_over_empty_gold(spark):
    empty = [spark.createDataFrame([], s) for s in (FCT_OBSERVATIONS, DIM_INDICATORS, DIM_TIME)]
    data = dashboard.star(*empty, with_age=True)
    assert tuple(dashboard.date_bounds(data).first()) == (None, None)
    deduped = dashboard.dedupe_last(data)
    for result in (
        dashboard.indicator_list(empty[1]),
        dashboard.filter_range(data, _month(0), _month(1)),
        dashboard.latest_metrics(data),
        dashboard.time_series(data),
        dashboard.yoy_series(data),
        dashboard.top_recent(data),
        deduped,
        dashboard.pivot_wide(deduped, {"a": "a"}),
    ):
        assert result.count() == 0
    assert set(_matrix(correlation.corr_matrix(deduped, ["a", "b"])).values()) == {(0, None)}


def test_filter_range(gold):
    data = dashboard.star(*gold)
    assert dashboard.filter_range(data, _month(1), _month(3)).count() == 6
    assert dashboard.filter_range(data, _month(1), None).count() == 60
    assert dashboard.filter_range(data, None, None).count() == 60
    bounds = dashboard.date_bounds(data).first()
    assert tuple(bounds) == (_month(0), _month(29))


def test_latest_metrics(gold):
    data = dashboard.star(*gold)
    found = {r["indicator_id"]: r for r in dashboard.latest_metrics(data).collect()}
    assert found["GDP"]["latest_value"] == 30.0
    assert found["GDP"]["value_label"] == "30.00"
    assert found["GDP"]["change_label"] == "66.67% YoY"
    early = dashboard.latest_metrics(dashboard.filter_range(data, _month(0), _month(2)))
    assert {r["change_label"] for r in early.collect()} == {"N/A"}
    nothing = dashboard.filter_range(data.filter("indicator_id = 'GDP'"), _month(0), _month(2))
    assert [r["indicator_id"] for r in dashboard.latest_metrics(nothing).collect()] == ["GDP"]


def test_newest_vintage_counts_not_the_largest_value(spark):
    staged = _staged(spark, [
        ("GDP", _month(0), 9.0, "2024-01-02", datetime(2024, 1, 2)),
        ("GDP", _month(0), 5.0, "2024-01-20", datetime(2024, 1, 20)),
    ])
    indicators, time = marts.dim_indicators(staged, default_catalogue(spark), NOW), marts.dim_time(staged)
    for vintages in ("current", "all"):
        fact = marts.fct_observations(staged, vintages, NOW)
        data = dashboard.star(fact, indicators, time, with_age=True)
        assert [r["latest_value"] for r in dashboard.latest_metrics(data).collect()] == [5.0]
        assert dashboard.top_recent(data).first()["observation_value"] == 5.0


def test_series_and_yoy(gold):
    data = dashboard.star(*gold)
    days = [r["date_key"] for r in dashboard.time_series(data.filter("indicator_id = 'GDP'")).collect()]
    assert days == sorted(days) and len(days) == 30
    assert dashboard.yoy_series(data).count() == 36
    with_nan = data.withColumn("yoy_change_pct", F.lit(math.nan))
    assert dashboard.yoy_series(with_nan).count() == 0


def test_top_recent(gold):
    top = dashboard.top_recent(dashboard.star(*gold), 3).collect()
    assert [r["date_key"] for r in top] == [_month(29), _month(29), _month(28)]
    assert dashboard.top_recent(dashboard.star(*gold)).count() == 50


def test_dedupe_last(spark):
    day = date(2024, 1, 1)
    rows = [
        ("S", "Name", day, 1.0, 5.0, "2024-01-02", NOW),
        ("S", "Name", day, 2.0, None, "2024-01-03", NOW),
        ("S", "Name", day, math.nan, math.nan, "2024-01-04", NOW),
        ("S", None, day, 3.0, 1.0, "2024-01-04", NOW),
        ("S", "Name", None, 4.0, 1.0, "2024-01-04", NOW),
    ]
    data = spark.createDataFrame(
        rows,
        "indicator_id string, indicator_name string, date_key date, observation_value double, "
        "yoy_change_pct double, data_as_of_date string, ingested_at timestamp_ntz",
    )
    found = dashboard.dedupe_last(data, ["observation_value", "yoy_change_pct"]).collect()
    assert [tuple(r) for r in found] == [(day, "Name", 2.0, 5.0)]


def _points(spark, series):
    rows = [(_month(i), name, v) for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date_key date, indicator_name string, observation_value double")


def test_pivot_wide(spark):
    points = _points(spark, {"a": [1.0, 2.0], "b": [3.0], "left out": [9.0]})
    wide = dashboard.pivot_wide(points, {"a": "a", "b": "b", "c": "c"})
    assert sorted(tuple(r) for r in wide.collect()) == [
        (_month(0), 1.0, 3.0, None),
        (_month(1), 2.0, None, None),
    ]


def _matrix(df):
    return {(r["indicator_x"], r["indicator_y"]): (r["n_pairs"], r["r"]) for r in df.collect()}


@pytest.fixture(params=["one block", "blocks"])
def corr_way(request, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(correlation, "BLOCK", 2)
        monkeypatch.setattr(correlation, "SLICE", 3)


def test_correlation_edges(spark, corr_way):
    points = _points(spark, {
        "up": [1.0, 2.0, 3.0, None],
        "down": [3.0, 2.0, 1.0, 7.0, math.nan],
        "flat": [0.1, 0.1, 0.1, 0.1],
        "one": [1.0],
        "later": [None, None, None, None, 2.0, 3.0],
        "flat where up": [0.1, 0.1, 0.1, 5.0],
    })
    names = ["up", "down", "flat", "one", "later", "flat where up"]
    found = _matrix(correlation.corr_matrix(points, names))
    assert len(found) == 36
    assert found[("up", "down")][0] == 3
    assert found[("up", "down")][1] == pytest.approx(-1.0)
    assert found[("up", "up")][1] == pytest.approx(1.0)
    assert found[("up", "flat")] == (3, None)
    assert found[("flat", "flat")] == (4, None)
    assert found[("one", "one")] == (1, None)
    assert found[("up", "one")] == (1, None)
    assert found[("up", "later")] == (0, None)
    assert found[("up", "flat where up")] == (3, None)
    assert found[("down", "flat where up")][0] == 4
    assert all(found[(x, y)] == found[(y, x)] for x, y in found)
    with pytest.raises(ValueError, match="at least two"):
        correlation.corr_matrix(points, ["up"])


def test_correlation_leaves_out_what_is_not_finite(spark):
    """As for any other missing value, and alike for few and for many series."""
    rng = random.Random(4)
    names = [f"s{i}" for i in range(10)]
    series = {n: [rng.gauss(5, 1) for _ in range(14)] for n in names}
    series["s0"][3], series["s0"][5], series["s1"][7] = math.inf, math.nan, -math.inf
    points = _points(spark, series)
    many = _matrix(correlation.corr_matrix(points, names))
    few = _matrix(correlation.corr_matrix(points.filter("indicator_name < 's5'"), names[:5]))
    assert many[("s0", "s1")][0] == 11 and many[("s0", "s2")][0] == 12
    assert many[("s0", "s0")][1] == pytest.approx(1.0)
    for pair, (n, r) in few.items():
        assert many[pair][0] == n and many[pair][1] == pytest.approx(r)


def test_correlation_plan_does_not_grow_with_the_blocks(spark, monkeypatch):
    points = _points(spark, {f"s{i}": [1.0, 2.0, float(i)] for i in range(8)})
    sizes = []
    for block in (8, 1):
        monkeypatch.setattr(correlation, "BLOCK", block)
        plan = correlation.corr_matrix(points, [f"s{i}" for i in range(8)])
        sizes.append(len(plan._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert sizes[0] == sizes[1]


def test_correlation_of_many_series(spark):
    rng = random.Random(3)
    names = [f"s{i:02d}" for i in range(30)]
    series = {n: [rng.choice([None, rng.gauss(1000, 1)]) for _ in range(60)] for n in names}
    found = _matrix(correlation.corr_matrix(_points(spark, series), names))
    assert len(found) == len(names) ** 2
    for x, y in found:
        both = [(a, b) for a, b in zip(series[x], series[y]) if a is not None and b is not None]
        n = len(both)
        mx, my = sum(a for a, _ in both) / n, sum(b for _, b in both) / n
        cov = sum((a - mx) * (b - my) for a, b in both)
        var = math.sqrt(sum((a - mx) ** 2 for a, _ in both) * sum((b - my) ** 2 for _, b in both))
        assert found[(x, y)][0] == n
        assert found[(x, y)][1] == pytest.approx(cov / var, abs=1e-9)


# --- Data tests -------------------------------------------------------------


def _report(spark, staged, indicators, time, fact):
    rows = quality.run_suite(staged, indicators, time, fact).collect()
    assert len(rows) == 13
    return {(r["test"], r["table_name"], r["column_name"]): r["failures"] for r in rows}


@pytest.fixture(scope="module")
def sound(spark):
    staged = _staged(spark, [("GDP", _month(i), float(i)) for i in range(3)])
    return (
        staged,
        spark.createDataFrame([("GDP", "G", None, None, NOW)], DIM_INDICATORS),
        marts.dim_time(staged),
        marts.fct_observations(staged, created_at=NOW),
    )


def test_suite_passes_on_sound_gold(spark, sound):
    assert set(_report(spark, *sound).values()) == {0}
    assert quality.failed(quality.run_suite(*sound)) == []


def test_suite_passes_on_empty_gold(spark, sound):
    empty = [df.filter("false") for df in sound]
    assert set(_report(spark, *empty).values()) == {0}


def _fact_row(spark, indicator, day, value=1.0):
    return spark.createDataFrame(
        [(indicator, day, value, None, None, None, None, "2024-01-01", NOW, NOW)], FCT_OBSERVATIONS
    )


@pytest.mark.parametrize(
    "fault, failing",
    [
        ("null staged value", {("not_null", "stg_observations", "value"): 1}),
        ("null staged date", {("not_null", "stg_observations", "observation_date"): 1}),
        ("null dim key", {("not_null", "dim_indicators", "indicator_id"): 1}),
        ("repeated indicator", {("unique", "dim_indicators", "indicator_id"): 1}),
        ("repeated date", {("unique", "dim_time", "date_key"): 3}),
        ("null fact key", {("not_null", "fct_observations", "indicator_id"): 1}),
        ("null fact value", {("not_null", "fct_observations", "observation_value"): 1}),
        ("orphan indicator", {("relationships", "fct_observations", "indicator_id"): 2}),
        ("orphan date", {("relationships", "fct_observations", "date_key"): 1}),
    ],
)
def test_suite_finds_each_fault(spark, sound, fault, failing):
    staged, indicators, time, fact = sound
    if fault == "null staged value":
        staged = staged.union(_staged(spark, [("GDP", _month(9), None)]))
    elif fault == "null staged date":
        staged = staged.union(_staged(spark, [("GDP", None, 1.0)]))
    elif fault == "null dim key":
        indicators = indicators.union(spark.createDataFrame([(None, "N", None, None, NOW)], DIM_INDICATORS))
    elif fault == "repeated indicator":
        indicators = indicators.union(indicators).union(indicators)
    elif fault == "repeated date":
        time = time.union(time)
    elif fault == "null fact key":
        fact = fact.union(_fact_row(spark, None, _month(0)))
    elif fault == "null fact value":
        fact = fact.union(_fact_row(spark, "GDP", _month(0), None))
    elif fault == "orphan indicator":
        fact = fact.union(_fact_row(spark, "NONE", _month(0))).union(_fact_row(spark, "NONE", _month(1)))
    elif fault == "orphan date":
        fact = fact.union(_fact_row(spark, "GDP", _month(20)))
    report = _report(spark, staged, indicators, time, fact)
    assert {k: v for k, v in report.items() if v} == failing


def test_in_range(spark):
    staged = _staged(spark, [("A", _month(i), float(i)) for i in range(5)] + [("B", _month(0), 99.0)])
    bounds = spark.createDataFrame(
        [("A", 1.0, 3.0), ("C", 0.0, 0.0)], "series_id string, min_value double, max_value double"
    )
    report = quality.in_range(staged, "staged", "series_id", "value", bounds)
    assert quality.failed(report) == ["in_range staged.value: 2 failures"]
    open_ended = bounds.withColumn("max_value", F.lit(None).cast("double"))
    report = quality.in_range(staged, "staged", "series_id", "value", open_ended)
    assert report.first()["failures"] == 1


def test_key_nulls_and_orphans(spark, sound):
    _, indicators, _, fact = sound
    bad = (
        fact.union(_fact_row(spark, None, _month(0)))
        .union(_fact_row(spark, "GDP", None))
        .union(_fact_row(spark, None, None))
        .union(_fact_row(spark, "NONE", _month(0)))
    )
    assert quality.key_nulls(bad, ["indicator_id", "date_key"]).first()["null_count"] == 3
    count = quality.orphans(bad, "indicator_id", indicators, "indicator_id").first()["orphan_count"]
    assert count == 3
    clean = quality.orphans(fact, "indicator_id", indicators, "indicator_id").first()
    assert clean["orphan_count"] == 0


# --- Streaming --------------------------------------------------------------


def _bronze(spark, ingest_date, rows):
    full = [("2024-02-01", "9999-12-31", d, v, s, f"{ingest_date}T06:00:00", ingest_date, s) for s, d, v in rows]
    return spark.createDataFrame(full, BRONZE_AT_REST)


def test_stream_takes_only_new_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("bronze", "silver", "state"))

    def run():
        silver_stream.stream_silver(spark, source, target, state, 1 << 30).awaitTermination()
        return sorted(
            (r["series_id"], r["value_raw"], r["is_valid"])
            for r in tables.read_silver(spark, target).collect()
        )

    bronze.write_bronze(_bronze(spark, "2024-02-01", [("A", "2024-01-01", "1"), ("B", "2024-01-01", ".")]), source)
    assert run() == [("A", "1", True), ("B", ".", False)]
    assert run() == [("A", "1", True), ("B", ".", False)]
    bronze.write_bronze(_bronze(spark, "2024-02-02", [("A", "2024-01-02", "2")]), source)
    assert run() == [("A", "1", True), ("A", "2", True), ("B", ".", False)]
    # A rerun of the first date withdraws a row and revises the other.
    bronze.write_bronze(_bronze(spark, "2024-02-01", [("A", "2024-01-01", "9")]), source)
    assert run() == [("A", "2", True), ("A", "9", True), ("B", ".", False)]
    batch = silver.clean(bronze.read_bronze(spark, source))
    streamed = tables.read_silver(spark, target)
    assert sorted(map(str, streamed.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


@pytest.mark.parametrize("layout", ["folders", "clustered"])
@pytest.mark.parametrize("vintages", ["current", "all"])
def test_refresh_keeps_other_series_and_completes_the_star(spark, tmp_path, layout, vintages):
    root = str(tmp_path)
    old = _staged(spark, [("A", _month(0), 1.0), ("B", _month(0), 5.0), ("C/d", _month(0), 6.0)])
    catalogue = default_catalogue(spark)
    tables.write_gold(marts.dim_indicators(old, catalogue, NOW), root, "dim_indicators")
    tables.write_gold(marts.dim_time(old), root, "dim_time")
    tables.write_gold(marts.fct_observations(old, vintages, NOW), root, "fct_observations", layout)
    assert tables.gold_layout(spark, root, "fct_observations") == layout
    new = _staged(spark, [("A", _month(0), 1.0), ("A", _month(1), 2.0), ("B", _month(0), 7.0), ("N", _month(2), 8.0)])
    touched = spark.createDataFrame([("A",), ("C/d",), ("N",)], "series_id string")
    silver_stream.refresh_gold(new, touched, catalogue, root, vintages, NOW)
    fact, indicators, time = (
        tables.read_gold(spark, root, t) for t in ("fct_observations", "dim_indicators", "dim_time")
    )
    assert sorted((r["indicator_id"], r["observation_value"], r["previous_value"] or 0) for r in fact.collect()) == [
        ("A", 1.0, 0),
        ("A", 2.0, 1.0),
        ("B", 5.0, 0),
        ("N", 8.0, 0),
    ]
    assert dashboard.star(fact, indicators, time).count() == 4
    assert tables.gold_layout(spark, root, "fct_observations") == layout


def test_row_order_does_not_matter(spark):
    rng = random.Random(5)
    rows = [("S", _month(rng.randrange(20)), float(i), f"2024-01-{rng.randrange(1, 29):02d}") for i in range(100)]
    results = []
    for _ in range(2):
        rng.shuffle(rows)
        staged = _staged(spark, rows)
        results.append([
            sorted(map(tuple, marts.fct_observations(staged, mode, NOW).collect()), key=str)
            for mode in ("current", "all")
        ])
    assert results[0] == results[1]


def test_catalogue_schema(spark):
    assert schema_drift(default_catalogue(spark), CATALOGUE) == []
    assert silver.clean(spark.createDataFrame([], BRONZE_AT_REST)).columns == SILVER.names
