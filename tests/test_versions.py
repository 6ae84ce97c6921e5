"""Versioned gold: a refresh equals a rebuild, reads only what changes reach, and never harms a version."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.operators import incremental, marts
from tsmedallion.plans import fixtures
from tsmedallion.plans.daily import DailyRun, DataTestError, run_daily, run_versions
from tsmedallion.schemas import BRONZE_AT_REST, STAGING, default_catalogue
from tsmedallion.sources import landing, snapshots, tables

NOW = datetime(2024, 2, 1, 6)
BY_YEAR = T.StructType([*STAGING.fields, T.StructField("year", T.IntegerType())])


def _row(series, day, value, as_of="2024-01-01", name=None):
    return (series, name or f"Series {series}", day, value, as_of, NOW, NOW)


def _frame(spark, rows):
    return spark.createDataFrame(rows, STAGING)


def _staged(spark, path, rows):
    incremental.write_staged(_frame(spark, rows), str(path))
    return spark.read.schema(BY_YEAR).parquet(str(path))


def _content(snapshot):
    return {t: sorted((tuple(r) for r in snapshot.read(t).collect()), key=str) for t in ("fct_observations", "dim_indicators", "dim_time")}


def _rebuilt(spark, rows):
    staged, catalogue = _frame(spark, rows), default_catalogue(spark)
    tables = (marts.fct_observations(staged, "current", NOW), marts.dim_indicators(staged, catalogue, NOW), marts.dim_time(staged))
    return {
        t: sorted((tuple(r) for r in df.collect()), key=str)
        for t, df in zip(("fct_observations", "dim_indicators", "dim_time"), tables)
    }


def _daily(series, first, n, step=1, scale=1.0):
    return [_row(series, first + timedelta(days=i * step), scale * (i + 1)) for i in range(n)]


def test_refresh_equals_rebuild_under_random_changes(spark, tmp_path):
    rng = random.Random(11)
    rows = [
        *_daily("GDP", date(2015, 1, 1), 60, 40),
        *_daily("DFF", date(2019, 6, 1), 80, 9),
        *_daily("YEARLY", date(1990, 1, 1), 30, 365),
        *_daily(None, date(2020, 1, 1), 20, 30),
        *[_row("GDP", None, float(i)) for i in range(20)],
        _row("DFF", None, 1.5),
    ]
    catalogue, root = default_catalogue(spark), str(tmp_path / "gold")
    incremental.build_version(spark, root, _frame(spark, rows), catalogue, NOW)
    for step in range(3):
        gone = rng.sample(range(len(rows)), 6)
        deleted = [rows[i] for i in gone]
        new = [_row(r[0], r[2], rng.random(), f"2024-02-{step + 1:02d}", rng.choice([None, "renamed"])) for r in rng.sample(rows, 5)]
        new += [_row("GDP", date(2012 + step, 5, 5), 7.0), _row(f"NEW{step}", date(2021, 1, 1 + step), 8.0), _row("DFF", None, 9.0 + step)]
        rows = [r for i, r in enumerate(rows) if i not in gone] + new
        staged = _staged(spark, tmp_path / f"staged{step}", rows)
        number = incremental.refresh_version(
            spark, root, staged, _frame(spark, new), _frame(spark, deleted), catalogue, NOW, max_layers=2
        )
        assert number == step + 2
        assert _content(snapshots.open_snapshot(spark, root)) == _rebuilt(spark, rows), step


def test_years_that_no_change_reaches_are_not_read(spark, tmp_path):
    rows = [*_daily("GDP", date(2010, 1, 1), 400, 10), *_daily("DFF", date(2010, 1, 1), 400, 10)]
    root, catalogue = str(tmp_path / "gold"), default_catalogue(spark)
    incremental.build_version(spark, root, _frame(spark, rows), catalogue, NOW)
    new = [_row("GDP", date(2020, 7, 1), 5.0), _row("GDP", date(2020, 7, 2), 6.0)]
    staged = _staged(spark, tmp_path / "staged", rows + new)
    wanted = _rebuilt(spark, rows + new)["fct_observations"]
    # Files of the years before are no Parquet any more: opening one would fail.
    broken = [p for d in (tmp_path / "staged", *Path(root).glob("data/fct*")) for y in range(2010, 2019) for p in d.glob(f"year={y}/*.parquet")]
    assert len(broken) >= 18
    for p in broken:
        p.write_bytes(b"not parquet")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    incremental.refresh_version(spark, root, staged, _frame(spark, new), _frame(spark, []), catalogue, NOW)
    last = snapshots.open_snapshot(spark, root).tables["fct_observations"][-1]
    layer = snapshots.Snapshot(spark, root, 0, {"fct_observations": [{**last, "cuts": None}]})
    found = sorted((tuple(r) for r in layer.read("fct_observations").collect()), key=str)
    assert found == [r for r in wanted if r[0] == "GDP" and r[1] >= date(2020, 7, 1)]


def test_a_plan_prunes_by_year(spark, tmp_path):
    staged = _staged(spark, tmp_path / "staged", _daily("GDP", date(2010, 1, 1), 400, 10))
    plan = staged.filter((staged.year >= 2019) | staged.year.isNull())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((year" in plan


def test_a_run_that_dies_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    rows = _daily("GDP", date(2020, 1, 1), 30)
    root, catalogue = str(tmp_path / "gold"), default_catalogue(spark)
    incremental.build_version(spark, root, _frame(spark, rows), catalogue, NOW)
    before = _content(snapshots.open_snapshot(spark, root))
    new = [_row("GDP", date(2020, 1, 10), 99.0, "2024-03-01")]
    staged = _staged(spark, tmp_path / "staged", rows + new)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            incremental.refresh_version(spark, root, staged, _frame(spark, new), _frame(spark, []), catalogue, NOW)
    assert snapshots.versions(spark, root) == [1]
    assert _content(snapshots.open_snapshot(spark, root)) == before
    pinned = snapshots.open_snapshot(spark, root)
    assert incremental.refresh_version(spark, root, staged, _frame(spark, new), _frame(spark, []), catalogue, NOW) == 2
    assert _content(pinned) == before == _content(snapshots.open_snapshot(spark, root, 1))
    assert _content(snapshots.open_snapshot(spark, root)) == _rebuilt(spark, rows + new)


def test_of_two_runs_one_publishes(spark, tmp_path):
    root = str(tmp_path / "gold")
    layers = {"dim_time": [{"rows": "x", "cuts": None}]}
    assert snapshots.publish(spark, root, 0, layers) == 1
    with pytest.raises(snapshots.VersionTaken):
        snapshots.publish(spark, root, 0, {"dim_time": []})
    assert snapshots.open_snapshot(spark, root, 1).tables == layers


def test_expired_versions_go_with_the_folders_that_only_they_name(spark, tmp_path):
    rows = _daily("GDP", date(2020, 1, 1), 5)
    root, catalogue = str(tmp_path / "gold"), default_catalogue(spark)
    incremental.build_version(spark, root, _frame(spark, rows), catalogue, NOW)
    for i in range(2):
        new = [_row("GDP", date(2020, 2, 1 + i), float(i))]
        rows += new
        staged = _staged(spark, tmp_path / f"staged{i}", rows)
        incremental.refresh_version(spark, root, staged, _frame(spark, new), _frame(spark, []), catalogue, NOW)
    newest = snapshots.open_snapshot(spark, root)
    before = _content(newest)
    (Path(root) / "data" / "fct_observations-unpublished").mkdir()
    assert snapshots.expire(spark, root, 1, unused_for_hours=24)[:2] == [f"{n:020d}.json" for n in (1, 2)]
    assert len(list(Path(root).glob("data/*"))) == 12 and _content(newest) == before
    gone = snapshots.expire(spark, root, 1, unused_for_hours=0)
    assert sorted(n.partition("-")[0] for n in gone) == ["dim_indicators"] * 2 + ["dim_time"] * 2 + ["fct_observations"]
    assert snapshots.versions(spark, root) == [3] and _content(snapshots.open_snapshot(spark, root)) == before
    with pytest.raises(ValueError):
        snapshots.expire(spark, root, 0)


def test_nothing_changed_publishes_nothing(spark, tmp_path):
    rows = _daily("GDP", date(2020, 1, 1), 5)
    root, catalogue = str(tmp_path / "gold"), default_catalogue(spark)
    incremental.build_version(spark, root, _frame(spark, rows), catalogue, NOW)
    staged = _staged(spark, tmp_path / "staged", rows)
    assert incremental.refresh_version(spark, root, staged, _frame(spark, []), _frame(spark, []), catalogue, NOW) == 1
    assert snapshots.versions(spark, root) == [1]


# --- The daily run ----------------------------------------------------------


def _land(lake, ingest_date, **series):
    for name, observations in series.items():
        folder = lake / "landing" / f"ingest_date={ingest_date}" / f"series_id={name}"
        folder.mkdir(parents=True, exist_ok=True)
        rows = [{"realtime_start": ingest_date, "realtime_end": "9999-12-31", "date": d, "value": v} for d, v in observations]
        (folder / "doc.json").write_text(json.dumps({"observations": rows}))


def _run(lake, ingest_date, hour=6):
    at = datetime.fromisoformat(f"{ingest_date}T{hour:02d}:00:00").replace(tzinfo=timezone.utc)
    return DailyRun(landing=str(lake / "landing"), lake=str(lake / "lake"), ingest_date=ingest_date, run_at=at)


def _facts(snapshot):
    return sorted((tuple(r)[:8] for r in snapshot.read("fct_observations").collect()), key=str)


def test_daily_versions_equal_daily_rebuilds(spark, tmp_path):
    """New observations, revisions, a rerun that withdraws rows, and a run that adds nothing."""
    months = [f"{2020 + i // 12}-{i % 12 + 1:02d}-01" for i in range(30)]
    days = {
        "2024-02-01": {"GDP": [(m, str(100 + i)) for i, m in enumerate(months)], "DFF": [(m, str(i)) for i, m in enumerate(months[:20])]},
        "2024-02-02": {"GDP": [(months[25], "7"), ("2022-07-01", "8")], "UNRATE": [(months[3], "4"), ("bad", "."), (months[4], ".")]},
        "2024-02-03": {"DFF": [(m, str(i)) for i, m in enumerate(months[:20])]},
    }
    for day, series in days.items():
        _land(tmp_path, day, **series)
    root = str(tmp_path / "lake" / "versions")
    for number, day in enumerate(days, 1):
        assert run_versions(spark, _run(tmp_path, day))["version"] == number
        run_daily(spark, _run(tmp_path, day))
        gold = str(tmp_path / "lake" / "gold")
        found = snapshots.open_snapshot(spark, root)
        assert sorted(found.runs) == sorted(list(days)[:number])
        for table, n in (("fct_observations", 8), ("dim_indicators", 4), ("dim_time", 12)):
            wanted = sorted((tuple(r)[:n] for r in tables.read_gold(spark, gold, table).collect()), key=str)
            assert sorted((tuple(r)[:n] for r in found.read(table).collect()), key=str) == wanted, (day, table)
    # The second day comes again without the revision, the third as it was.
    before = _facts(snapshots.open_snapshot(spark, root))
    _land(tmp_path, "2024-02-02", GDP=[("2022-07-01", "8")], UNRATE=[(months[3], "4")])
    assert run_versions(spark, _run(tmp_path, "2024-02-02", 9))["version"] == 4
    after = snapshots.open_snapshot(spark, root)
    revised = date(2022, 2, 1)
    assert {r[2] for r in before if r[:2] == ("GDP", revised)} == {7.0}
    assert {r[2] for r in _facts(after) if r[:2] == ("GDP", revised)} == {125.0}
    staged = after.read("stg_observations").collect()
    assert len(staged) == 30 + 20 + 1 + 1 + 20


def test_only_the_years_of_a_run_are_transformed_again(spark, tmp_path):
    _land(tmp_path, "2024-02-01", GDP=[(f"{2000 + i // 12}-{i % 12 + 1:02d}-01", str(i)) for i in range(288)])
    run = _run(tmp_path, "2024-02-01")
    run = DailyRun(**{**run.__dict__, "observation_start": None})
    run_versions(spark, run)
    _land(tmp_path, "2024-02-02", GDP=[("2024-01-01", "5")])
    second = DailyRun(**{**run.__dict__, "ingest_date": "2024-02-02"})
    run_versions(spark, second)
    layers = snapshots.open_snapshot(spark, str(tmp_path / "lake" / "versions")).tables
    assert layers["stg_observations"][-1]["years"] == [2024]
    assert [p.name for p in Path(layers["fct_observations"][-1]["rows"]).glob("year=*")] == ["year=2024"]


def test_raw_rows_of_a_run_are_written_once(spark, tmp_path, monkeypatch):
    """The audit reads the folder that the version names; nothing holds the rows a second time."""
    written = []
    writer = type(_frame(spark, []).write)
    parquet = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **k: written.append((self._df.columns, path)) or parquet(self, path, *a, **k))
    _land(tmp_path, "2024-02-01", GDP=[("2024-01-01", "5"), ("2024-01-02", ".")])
    assert run_versions(spark, _run(tmp_path, "2024-02-01"))["quality"]["total_records"] == 2
    (raw,) = [path for columns, path in written if columns == BRONZE_AT_REST.names]
    found = snapshots.open_snapshot(spark, str(tmp_path / "lake" / "versions"))
    assert found.runs == {"2024-02-01": raw}
    assert sorted((r["date"], r["value"]) for r in found.run("2024-02-01").collect()) == [("2024-01-01", "5"), ("2024-01-02", ".")]


def test_landed_documents_are_small_and_read_back_whole(spark, tmp_path):
    day, columns = F.expr("cast(date_add(date'2020-01-01', cast(id % 900 as int)) as string)"), ["series_id", "realtime_start", "realtime_end", "date", "value"]
    raw = spark.range(9_000).select(
        day.alias("realtime_start"), F.lit("9999-12-31").alias("realtime_end"), day.alias("date"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("value"),
        F.when(F.col("id") % 3 > 0, "GDP").alias("series_id"), F.floor(F.col("id") / 500).alias("page"),
    )
    docs = fixtures.documents(raw, "2024-02-01")
    path = fixtures.land(docs, str(tmp_path / "landing"))
    back = landing.explode_documents(landing.read_documents(spark, path, "2024-02-01", multi_line=False))
    assert sorted(map(str, back.select(*columns).collect())) == sorted(map(str, raw.select(*columns).collect()))
    plain = docs.select(F.sum(F.length(F.to_json("observations")))).first()[0]
    assert sum(p.stat().st_size for p in Path(path).rglob("part-*")) < plain / 3


def test_a_version_that_fails_its_tests_is_not_published(spark, tmp_path):
    _land(tmp_path, "2024-02-01", GDP=[("2024-01-01", "5")])
    run_versions(spark, _run(tmp_path, "2024-02-01"))
    root = str(tmp_path / "lake" / "versions")
    before = _content(snapshots.open_snapshot(spark, root))
    _land(tmp_path, "2024-02-02", GDP=[("2024-01-02", "6"), ("no date", "7")])
    with pytest.raises(DataTestError, match="observation_date"):
        run_versions(spark, _run(tmp_path, "2024-02-02"))
    assert snapshots.versions(spark, root) == [1]
    assert _content(snapshots.open_snapshot(spark, root)) == before
    _land(tmp_path, "2024-02-02", GDP=[("2024-01-02", "6")])
    assert run_versions(spark, _run(tmp_path, "2024-02-02"))["version"] == 2
    assert len(_facts(snapshots.open_snapshot(spark, root))) == 2
