from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsmedallion.llm.hamming_search import SegmentIndex, hamming_top_k, sign_code

MASK = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def brute(rows, queries, k):
    rows, out = set(rows), []
    for q, code in set(queries):
        near = sorted(((code ^ c) & MASK).bit_count() * 10**9 + i for i, c in rows if i != q)[:k]
        out += [(q, r, d % 10**9, d // 10**9) for r, d in enumerate(near, 1)]
    return sorted(out)


def check(spark, rows, queries, k, **blocks):
    frame = lambda x: spark.createDataFrame([(i, signed(c)) for i, c in x], "id long, code long")
    found = hamming_top_k(frame(rows), frame(queries), k, **blocks)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, queries, k)


def test_random_clustered_and_hot_codes(spark):
    rng = random.Random(5)
    far = [rng.getrandbits(64) for _ in range(300)]
    near = [far[i % 7] ^ sum(1 << b for b in rng.sample(range(64), i % 5)) for i in range(200)]
    rows = list(enumerate(far + near + [far[0]] * 250))
    rng.shuffle(rows)
    check(spark, rows, rows[::20], 10, entries_per_block=100, queries_per_block=7)
    check(spark, rows, [(i, c) for i, c in rows if c == far[0]][:40], 3)


def test_fewer_rows_than_asked_for_and_far_codes(spark):
    check(spark, [(1, 0), (2, MASK), (3, 5)], [(1, 0)], 10)
    check(spark, [(1, 0)], [(1, 0)], 4)
    check(spark, [(1, 0), (2, 3)], [(9, 1), (1, 0)], 1)


def test_the_index_prunes_and_the_more_the_larger_it_is():
    rng = np.random.default_rng(1)
    shares = []
    for n in (8_192, 131_072):
        codes = rng.integers(0, 1 << 32, (2, n)).astype(np.uint64)
        codes = codes[0] << np.uint64(32) | codes[1]
        index = SegmentIndex(codes, np.ones(n, np.int64))
        for q in codes[:20]:
            hit, distance = index.nearest(q, 11)
            every = np.sort(np.bitwise_count(codes ^ q))
            assert np.array_equal(np.sort(distance), every[every <= every[10]])
        shares.append(index.verified / 20 / n)
    assert shares[1] < 0.1 < shares[0] < 0.25


def test_vectors_longer_than_the_code_are_refused(spark):
    code = lambda n: spark.createDataFrame([([1.0] * n,), (None,)], "v array<double>").select(sign_code(F.col("v"))).collect()
    assert [r[0] for r in code(64)] == [-1, None] and [r[0] for r in code(3)] == [7, None]
    with pytest.raises(Exception, match="vector of 65"):
        code(65)
