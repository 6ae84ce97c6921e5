"""As-of joins and name intervals against plain Python."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tsmedallion.operators import lagging, marts, temporal
from tsmedallion.schemas import STAGING

NOW = datetime(2024, 2, 1, 6)
VINTAGES = "series_id string, observation_date date, data_as_of_date string, ingested_at timestamp_ntz, value double"
PROBES = "id long, series_id string, observation_date date, known_at string"


def _ask(spark, vintages, probes, partitions=4):
    found = temporal.as_of_join(
        spark.createDataFrame(probes, PROBES).repartition(partitions),
        spark.createDataFrame(vintages, VINTAGES).repartition(partitions),
        ["series_id", "observation_date"],
        "known_at",
        "data_as_of_date",
        ["value", "data_as_of_date"],
        ("ingested_at",),
    )
    return {r["id"]: (r["value"], r["data_as_of_date"]) for r in found.collect()}


def _by_hand(vintages, probes):
    out = {}
    for i, series, day, known in probes:
        held = [
            (as_of, at, value)
            for s, d, as_of, at, value in vintages
            if None not in (series, day, known, as_of) and (s, d) == (series, day) and as_of <= known
        ]
        newest = max(held, default=None)
        out[i] = (newest[2], newest[0]) if newest else (None, None)
    return out


@pytest.mark.parametrize("chunks", ["1", "3", "40"])
def test_probes_of_a_hot_key_in_any_number_of_chunks(spark, chunks):
    """Chunks of probes only, keys over many chunks, probes before the first vintage."""
    rng = random.Random(3)
    day = [date(2024, 1, 1) + timedelta(days=i) for i in range(4)]
    vintages = [("HOT", day[0], f"2024-02-{rng.randrange(1, 29):02d}", NOW + timedelta(hours=rng.randrange(5)), float(i)) for i in range(60)]
    vintages += [(rng.choice("ABC"), rng.choice(day), f"2024-0{rng.randrange(2, 5)}-10", NOW, float(i)) for i in range(40)]
    vintages += [("A", day[0], None, NOW, 1.0), (None, day[0], "2024-01-01", NOW, 2.0), ("A", None, "2024-01-01", NOW, 3.0)]
    probes = [(i, "HOT", day[0], f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d}") for i in range(300)]
    probes += [(300 + i, "LATE", day[0], "2024-12-31") for i in range(100)]  # no vintage at all
    probes += [(400 + i, rng.choice("ABC"), rng.choice(day), f"2024-0{rng.randrange(1, 6)}-15") for i in range(100)]
    probes += [(600, None, day[0], "2024-12-31"), (601, "A", None, "2024-12-31"), (602, "A", day[0], None)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", chunks)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _ask(spark, vintages, probes) == _by_hand(vintages, probes)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_sides(spark):
    day = date(2024, 1, 1)
    assert _ask(spark, [], [(1, "A", day, "2024-01-01")]) == {1: (None, None)}
    assert _ask(spark, [("A", day, "2024-01-01", NOW, 1.0)], []) == {}


def test_a_group_of_copies_does_not_stay_in_one_chunk(spark, monkeypatch):
    kept = []
    chunks = lagging.sorted_chunks
    monkeypatch.setattr(temporal, "sorted_chunks", lambda *a: kept.append(chunks(*a)) or kept[-1])
    monkeypatch.setattr(lagging, "_chunks", lambda df: [6])
    day = date(2024, 1, 1)
    found = temporal.as_of_join(
        spark.range(4_000).select(F.lit(1).cast("long").alias("id"), F.lit("A").alias("series_id"), F.lit(day).alias("observation_date"), F.lit("2024-03-01").alias("known_at")),
        spark.createDataFrame([("A", day, "2024-02-01", NOW, 5.0)], VINTAGES),
        ["series_id", "observation_date"], "known_at", "data_as_of_date", ["value"],
    )
    assert found.filter("value = 5.0").count() == 4_000
    sizes = [r["count"] for r in kept[0].groupBy("chunk").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3_000


def test_chunks_follow_the_rows_of_both_sides(spark, monkeypatch):
    kept = []
    chunks = lagging.sorted_chunks
    monkeypatch.setattr(temporal, "sorted_chunks", lambda *a: kept.append(chunks(*a)) or kept[-1])
    monkeypatch.setattr(lagging, "CHUNK_ROWS", 100, raising=False)
    day = date(2024, 1, 1)
    vintages = [("HOT", day, f"2024-{i // 28 + 1:02d}-{i % 28 + 1:02d}", NOW, float(i)) for i in range(200)]
    probes = [(i, "HOT", day, f"2024-{i % 12 + 1:02d}-15") for i in range(800)]
    assert _ask(spark, vintages, probes) == _by_hand(vintages, probes)
    sizes = [r["count"] for r in kept[0].groupBy("chunk").count().collect()]
    assert sum(sizes) == 1_000 and len(sizes) >= 8 and max(sizes) < 250


# --- Names ------------------------------------------------------------------


def _named(spark, rows):
    full = [(s, name, date(2024, 1, 1), 1.0, as_of, NOW + timedelta(hours=h), NOW) for s, as_of, name, h in rows]
    return spark.createDataFrame(full, STAGING)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_history_after_deltas_in_any_order_equals_a_rebuild(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["A", "B", None]), rng.choice([None, *(f"2024-{m:02d}-01" for m in range(1, 13))]), rng.choice(["x", "y"]), rng.randrange(9))
        for _ in range(24)
    ]
    first, deltas = rows[:8], (rows[8:14], rows[14:15], rows[15:])
    names = marts.names_by_date(_named(spark, first))
    history = marts.name_intervals(names)
    done = list(first)
    for delta in deltas:
        done += delta
        history, names = (spark.createDataFrame(df.collect(), df.schema) for df in temporal.refresh_history(history, names, _named(spark, delta)))
        assert _rows(history) == _rows(marts.indicator_history(_named(spark, done)))
        assert _rows(names) == _rows(marts.names_by_date(_named(spark, done)))


def test_an_empty_delta_changes_nothing(spark):
    staged = _named(spark, [("A", "2024-01-01", "x", 0), ("A", "2024-02-01", "y", 0)])
    names = marts.names_by_date(staged)
    history = marts.name_intervals(names)
    after = temporal.refresh_history(history, names, staged.limit(0))
    assert _rows(after[0]) == _rows(history) and _rows(after[1]) == _rows(names)


def test_rows_get_the_name_of_their_date(spark):
    history = marts.indicator_history(_named(spark, [("A", "2024-01-15", "x", 0), ("A", "2024-03-10", "y", 0), ("B", "2024-02-01", "z", 0)]))
    asked = [("A", d) for d in ("2024-01-14", "2024-01-15", "2024-02-20", "2024-03-09", "2024-03-10", "2025-06-01", None, "bad")] + [("B", "2024-02-01"), (None, "2024-02-01"), ("C", "2024-02-01")]
    found = temporal.names_valid_at(spark.createDataFrame(asked, "indicator_id string, at string"), history, "indicator_id", "at", "2025-06-01")
    got = {(r[0], r[1]): r["indicator_name"] for r in found.collect()}
    names = [None, "x", "x", "x", "y", "y", None, None, "z", None, None]
    assert got == dict(zip(asked, names))
