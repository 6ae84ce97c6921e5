from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest

from tsmedallion.llm import mixing
from tsmedallion.llm.queries import op8_mixing

SF = "/root/testdata/sf0.01"


def plain_targets(totals):
    """Shared by weight, cut at twice the size, the excess shared anew until none is above."""
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(totals.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * totals[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = 2.0 * totals[s]
            left -= target[s]
        open_ -= above
    return target


def check(rows, docs, slack=0.02):
    sizes = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t, _ in docs}
    totals, taken = defaultdict(int), defaultdict(int)
    for i, _, s in docs:
        totals[s] += sizes[i]
    want = plain_targets(totals)
    source = {i: s for i, _, s in docs}
    for r in rows:
        s = source[r.doc_id]
        assert r.size == sizes[r.doc_id] and r.source_size == totals[s]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(2, slack * target), (s, taken[s], target)


def test_query_over_the_documents(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op8_mixing(spark, SF).collect()
    assert len(rows) == len(docs)
    check(rows, docs)


def test_hot_and_uneven_sources(spark, write_tables):
    rng = random.Random(8)
    text = lambda n: " ".join(["w"] * n)
    docs = [(i, text(50), "hot") for i in range(400)]  # copies: one size
    docs += [(1000 + i, text(int(rng.lognormvariate(4, 1)) + 1), f"s{i % 5}") for i in range(500)]
    docs += [(3000, None, "null"), (3001, "", "empty"), (3002, text(9), None), (3003, text(7), "Ω"), (3004, text(7), "Z")]
    sf = write_tables(documents=[(i, t, "en", s, 1) for i, t, s in docs])
    rows = op8_mixing(spark, sf).collect()
    check(rows, docs, slack=0.03)
    spark.read.parquet(f"{sf}/documents.parquet").repartition(7).write.parquet(f"{sf}/other/documents.parquet")
    again = op8_mixing(spark, f"{sf}/other").collect()
    assert sorted(rows) == sorted(again)
    hot = [r.copies for r in rows if r.doc_id < 400]
    assert max(hot) - min(hot) <= 1  # copies of one size differ by one at most


def test_rates_are_the_exponential_tilt_that_meets_the_target(spark):
    rng = random.Random(9)
    sizes = [(f"0s{k}", s, rng.randint(1, 5)) for k in range(4) for s in rng.sample(range(1, 900), 60)]
    frame = spark.createDataFrame(sizes, "key string, size long, n long")
    total = defaultdict(int)
    for key, s, n in sizes:
        total[key] += s * n
    share = dict(zip(sorted(total), (0.1, 0.8, 1.7, 2.0)))
    sources = spark.createDataFrame([(k, t, share[k] * t) for k, t in total.items()], "key string, total long, target double")
    for r in mixing.balance(frame, sources).collect():
        if r.full:
            assert share[r.key] == 2.0
            continue
        got = sum(n * s * min(2.0, math.exp(min(5, r.tilt * s / r.mean))) for key, s, n in sizes if key == r.key)
        assert got == pytest.approx(r.target, rel=1e-6)
