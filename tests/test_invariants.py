"""Laws that hold on the driver's tables whatever their content."""

import os

import pytest
from pyspark.sql import functions as F

from tsmedallion.operators import correlation, dashboard, marts, silver, staging
from tsmedallion.plans import fixtures
from tsmedallion.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def raw(spark):
    return fixtures.obs_daily(fixtures.table(spark, SF_DIR, "lineitem"))


@pytest.fixture(scope="module")
def staged(raw):
    return staging.stage(silver.clean(raw))


def test_silver_keeps_every_row(raw):
    summary = silver.quality_summary(silver.clean(raw)).first()
    assert summary["total_records"] == raw.count()
    parts = ("valid_records", "missing_records", "unparseable_records")
    assert sum(summary[p] for p in parts) == summary["total_records"]
    assert all(summary[p] > 0 for p in parts)


def test_staging_holds_the_valid_rows(raw, staged):
    assert staged.count() == silver.quality_summary(silver.clean(raw)).first()["valid_records"]


def test_fact_has_one_row_per_current_vintage(staged):
    keys = staged.select("series_id", "observation_date").distinct().count()
    assert marts.fct_observations(staged).count() == keys
    assert marts.fct_observations(staged, "all").count() == staged.count()


def test_newest_vintage_is_as_of_the_end(staged):
    latest = staged.agg(F.max("data_as_of_date")).first()[0]
    ours = staging.current_vintage(staged)
    assert staging.as_of(staged, latest).exceptAll(ours).count() == 0


def test_correlations_are_bounded(spark):
    matrix = REGISTRY["corr_matrix"](spark, SF_DIR).collect()
    assert len(matrix) == len(fixtures.DAILY_SERIES) ** 2
    r = {(m["indicator_x"], m["indicator_y"]): m["r"] for m in matrix}
    assert all(-1 - 1e-9 <= v <= 1 + 1e-9 for v in r.values() if v is not None)
    assert all(r[(x, y)] == r[(y, x)] for x, y in r)


def test_faults_are_found(spark):
    """The data tests over the driver's tables include some that must fail."""
    for name in ("dq_not_null", "dq_unique", "dq_relationships"):
        failures = [row["failures"] for row in REGISTRY[name](spark, SF_DIR).collect()]
        assert 0 in failures and max(failures) > 0, name
    assert REGISTRY["dq_orphans"](spark, SF_DIR).first()["orphan_count"] > 0
    assert REGISTRY["dq_key_nulls"](spark, SF_DIR).first()["null_count"] > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, staged):
    """No Python node, no range exchange below a window, partitions pruned."""
    fact = _plan(marts.fct_observations(staged))
    assert "rangepartitioning" not in fact and "Python" not in fact
    assert fact.count("Exchange hashpartitioning") == 2
    assert _plan(marts.yoy_calendar(staged)).count("Exchange hashpartitioning") == 2

    star = _plan(REGISTRY["star_join"](spark, SF_DIR))
    assert "PartitionFilters: [indicator_id" in star
    assert "BroadcastHashJoin" in star and "SortMergeJoin" not in star

    ranged = _plan(REGISTRY["date_range_filter"](spark, SF_DIR))
    assert "GreaterThanOrEqual(date_key" in ranged
    assert "TakeOrderedAndProject" in _plan(REGISTRY["latest_50"](spark, SF_DIR))


def test_a_large_dimension_is_not_broadcast(spark):
    """Beyond the threshold the same query sort-merges, with the same result."""
    expected = sorted(map(tuple, REGISTRY["star_join"](spark, SF_DIR).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        star = REGISTRY["star_join"](spark, SF_DIR)
        assert "SortMergeJoin" in _plan(star) and "BroadcastHashJoin" not in _plan(star)
        assert sorted(map(tuple, star.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_dedupe_keeps_one_row_per_date_and_name(spark):
    rows = REGISTRY["dedupe_last"](spark, SF_DIR)
    assert rows.count() == rows.select("date_key", "indicator_name").distinct().count()
    names = sorted({r["indicator_name"] for r in rows.select("indicator_name").distinct().collect()})
    matrix = correlation.corr_matrix(rows, names)
    assert matrix.filter("indicator_x = indicator_y").count() == len(names)
    assert dashboard.pivot_wide(rows, {n: f"c{i}" for i, n in enumerate(names)}).count() > 0
