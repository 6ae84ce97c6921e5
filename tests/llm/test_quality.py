from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tsmedallion.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_labels_are_predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = quality.classify(docs, labels.where(~out)).join(labels.where(out), "doc_id").toPandas()
    good = found["quality"] == 1
    assert ((found["score"] >= 0.5) == good).mean() > 0.93
    rank = found["score"].rank()
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.93
    assert abs(found["score"].mean() - good.mean()) < 0.05  # calibrated
    assert found["score"].between(0, 1).all()


def test_the_sample_bound_and_the_partitions_do_not_change_who_is_scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = quality.classify(docs, labels, max_labelled=150).toPandas().set_index("doc_id").sort_index()
    two = quality.classify(docs.repartition(5), labels, max_labelled=150).toPandas().set_index("doc_id").sort_index()
    assert len(one) == docs.count()
    assert np.allclose(one["score"], two["score"], atol=1e-6)


def test_one_class_alone_gives_the_share_of_good_labels(spark):
    docs = spark.createDataFrame([(1, "x", "en", "s", 1), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs, label([(1, 1), (1, 1)])).collect()} == {1.0}
    assert {r.score for r in quality.classify(docs, label([])).collect()} == {0.5}


def test_confident_documents_teach_the_other_view(spark):
    """The metadata view learns what the few labelled rows do not show of it."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        good = i % 2
        text = " ".join(rng.choice(["plain", "words", "here"], 30)) if good else "### $$$ %%% " * 12
        rows.append((i, text, "en", f"site{good}" if i >= 40 else "unknown", 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    vectors = quality.features(docs, "doc_id", "text", "source", "lang", "n_chars")
    view = quality.co_train(quality.with_labels(vectors, labels, "doc_id", "quality")).views[1]
    odds = {s: view.log_odds(quality.meta_features(s, b"en", 100)[None])[0] for s in (b"site0", b"site1")}
    assert odds[b"site1"] > 1 and odds[b"site0"] < -1
    found = quality.classify(docs, labels).where("doc_id >= 40").toPandas()
    assert ((found["score"] >= 0.5) == (found["doc_id"] % 2 == 1)).all()


def _vectors(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return quality.with_labels(
        quality.features(docs, "doc_id", "text", "source", "lang", "n_chars"), spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "quality"
    )


def test_rounds_against_plain_numpy_over_all_rows(spark):
    """Every round hands over the surest rows of all that were not handed over, copies once."""
    vectors = _vectors(spark, "/root/testdata/sf0.01").repartition(6)
    vectors = vectors.unionByName(vectors.where("id % 50 = 0").withColumn("id", vectors.id + 10**6))  # copies
    rows = vectors.where("y is null").select("id", "text_view", "meta_view").collect()
    sample = vectors.where("y is not null").collect()
    y = np.array([r.y for r in sample], float)
    views = tuple(
        quality.fit(quality._matrix([r[c] for r in sample], size), y)
        for c, size in (("text_view", quality.TEXT_SIZE), ("meta_view", quality.META_SIZE))
    )
    n, taught = {0: 40, 1: 25}, (set(), set())
    odds = [
        v.log_odds(quality._matrix([r[c] for r in rows], size))
        for v, c, size in zip(views, ("text_view", "meta_view"), (quality.TEXT_SIZE, quality.META_SIZE))
    ]
    pool = vectors.where("y is null").select("id", "text_view", "meta_view")
    for _ in range(3):
        got = quality._surest(pool, views, n, taught, 5).to_pylist()
        for view in (0, 1):
            for label in (0, 1):
                sure = odds[view] if label else -odds[view]
                best = {}
                for s, r in zip(sure, rows):
                    key = quality._features_key(r.text_view, r.meta_view)
                    if s >= np.log(19) - 1e-12 and key not in taught[view]:
                        low, first = best.get(key, (0.0, r.id))
                        best[key] = (min(low, -s), min(first, r.id))
                want = [i for _, i in sorted(best.values())[: n[label]]]
                assert [g["id"] for g in got if (g["view"], g["y"]) == (view, label)] == want
        assert got
        for g in got:
            taught[g["view"]].add(quality._features_key(g["text_view"], g["meta_view"]))
    assert len(taught[0]) > 65  # the third round still found others


def test_the_sample_has_the_smallest_hashes(spark):
    labelled = spark.range(50_000).selectExpr("id", "cast('t' as binary) text_view", "cast('m' as binary) meta_view", "1 as y")
    got = quality._sample(labelled, 300).column("id").to_pylist()
    want = [r.id for r in labelled.orderBy(F.xxhash64("id")).limit(300).collect()]
    assert got == want
    plan_rows = labelled.where(F.xxhash64("id") < F.lit(round(-(2**63) + (300 + 8 * 300**0.5 + 64) / 50_000 * 2**64)).cast("long")).count()
    assert 300 <= plan_rows < 1_000
