"""Newest vintages by keyed state: any order of arrival, restarts, withdrawn state."""

from __future__ import annotations

import random
import pytest

from tsmedallion.operators import silver, staging
from tsmedallion.schemas import BRONZE_AT_REST
from tsmedallion.sources import bronze
from tsmedallion.streaming import vintage_stream

ROWS = [
    (f"2024-01-{as_of:02d}", "9999-12-31", day, value, f"Series {s}", f"2024-02-{run:02d}T0{hour}:00:00", f"2024-02-{run:02d}", s)
    for s, day, as_of, run, hour, value in [
        ("A", "2023-01-01", 5, 1, 6, "1"), ("A", "2023-01-01", 7, 2, 6, "2"), ("A", "2023-01-01", 6, 3, 6, "3"),
        ("A", "2023-01-02", 5, 1, 6, "4"), ("A", "2023-01-02", 5, 2, 6, "5"), ("A", "2023-01-02", 5, 2, 7, "NaN"),
        ("B", "2023-01-01", 5, 1, 6, "."), ("B", "2023-01-01", 4, 3, 6, "6"), ("B", "no date", 4, 3, 6, "7"), ("B", "no date", 4, 2, 6, "8"),
    ]
]


def _found(df):
    return sorted((str(tuple(r)) for r in df.drop("transformed_at").collect()))


@pytest.mark.parametrize("seed", [None, 1])
def test_equals_the_batch_in_any_order_of_runs(spark, tmp_path, seed):
    source, target, state = (str(tmp_path / n) for n in ("bronze", "changes", "state"))
    runs = sorted({r[6] for r in ROWS}, reverse=True)
    if seed is not None:
        random.Random(seed).shuffle(runs)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    for run in runs:
        rows = spark.createDataFrame([r for r in ROWS if r[6] == run], BRONZE_AT_REST)
        bronze.write_bronze(rows, source)
        vintage_stream.stream_current_vintage(spark, source, target, state, max_bytes_per_trigger=1).awaitTermination()
    assert spark.conf.get(provider) == before
    batch = staging.current_vintage(staging.stage(silver.clean(spark.createDataFrame(ROWS, BRONZE_AT_REST))))
    assert _found(vintage_stream.read_current(spark, target)) == _found(batch)
    written = spark.read.parquet(target).count()
    # A run of the stream without new files writes nothing more.
    vintage_stream.stream_current_vintage(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == written


def test_an_older_vintage_is_not_emitted(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("bronze", "changes", "state"))
    newest_first = sorted((r for r in ROWS if r[2] == "2023-01-01" and r[7] == "A"), key=lambda r: r[0], reverse=True)
    for r in newest_first:
        bronze.write_bronze(spark.createDataFrame([r], BRONZE_AT_REST), source)
        vintage_stream.stream_current_vintage(spark, source, target, state).awaitTermination()
    assert [r.value_text for r in spark.read.parquet(target).collect()] == ["2.0"]


def test_ages_sort_as_in_the_batch():
    ages = [(None, None, None, None), (None, 1, "1.0", "x"), ("2024-01-01", None, "1.0", "x"), ("2024-01-01", 1, None, "x"), ("2024-01-01", 1, "-2.5", "x"),
            ("2024-01-01", 1, "10.0", None), ("2024-01-01", 1, "10.0", "x"), ("2024-01-01", 1, "Infinity", "x"), ("2024-01-01", 1, "NaN", "x"), ("2024-01-01", 2, "0.0", "x")]
    assert sorted(reversed(ages), key=vintage_stream.age) == ages
