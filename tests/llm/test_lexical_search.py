"""Lexical search against one score after the other, in whole numbers."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tsmedallion.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            score = 0
            for t, n in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
                    score += n * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


DOCS = [
    (5, "Alpha beta GAMMA alpha-beta 42"),
    (3, "Alpha beta GAMMA alpha-beta 42"),
    (9, "alpha"),
    (9, "alpha"),
    (None, "alpha"),
    (1, "ÄPFEL äpfel Äpfel"),
    (2, "a_b\x00c d\x7fe"),
    (4, None),
    (6, ""),
    (7, "beta " * 500),
    (8, "x" * 3000 + " alpha"),
    *((100 + i, f"word{i % 7} alpha beta{i % 3}") for i in range(40)),
]
ITEMS = [
    (1, "alpha Beta beta"), (1, "alpha Beta beta"), (2, "äpfel ÄPFEL"), (3, "nothing here"), (4, None), (5, ""), (6, "c d e"),
    (7, "alpha"), (8, "word1 word2 word3 " * 30), (None, "gamma 42"), (9, "42"),
]


@pytest.mark.parametrize("more", [{}, {"docs_per_tile": 3, "items_per_block": 2, "terms_per_tile": 1, "pairs_at_once": 4}])
@pytest.mark.parametrize("k", [4])
def test_scores_ranks_and_ties(spark, more, k):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = ls.lexical_search(docs, items, k, **more)
    assert [(c, t) for c, t in found.dtypes] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_hand(DOCS, ITEMS, k)


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    text = ("Ünder the-sea 12 " * 4_000).encode()
    whole = [t for some in ls.terms(text) for t in some]
    monkeypatch.setattr(ls, "BYTES_AT_ONCE", 1_000)
    assert len(list(ls.terms(text))) > 20 and [t for some in ls.terms(text) for t in some] == whole
    assert [t.decode() for t in whole] == TERM.findall(text.decode().translate(LOWER))


def test_sums_beyond_float64_stay_exact():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 1 << 20, 12)
    n[4] = 1 << 40  # its products alone are beyond 2^53
    block = ls.Block(np.array([7]), np.zeros(12, np.int64), np.arange(12), n)
    weight, impact = rng.integers(20_000, 28_000, 12), rng.integers(999_000, 1_000_000, 12)
    weight[4] = 3
    got = ls.tile_scores(block, weight, 1, np.zeros(12, np.int64), np.arange(12), impact, 2_048)
    assert int(got[0, 0]) == sum(int(a) * int(b) * int(c) for a, b, c in zip(n, weight, impact))
    ranges = list(ls._tiles((n * weight).tolist(), 2_048))
    assert len(ranges) > 2 and [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]]


def test_impacts_of_a_very_large_corpus():
    corpus = ls.Corpus(10**12, 10**15, np.ones(1, np.int64))
    tf, n = np.array([3, 1]), np.array([10**9, 5])
    wanted = [(10**9 * t) // (1000 * t + 8 * (25 + 75 * m * 10**12 // 10**15)) for t, m in ((3, 10**9), (1, 5))]
    assert corpus.impacts(tf, n).tolist() == wanted
