"""Exact k nearest binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits, each with its own index from a value to the codes that
have it. A query probes every segment at radius 0, then 1, and so on. Once radius r is
done in the first a segments and r - 1 in the others, every code within s * r + a - 1
bits (s segments) has been seen, since a code further in all of them differs in more.
The search stops as soon as the k-th verified distance is so covered.

Rows with one code are one entry with its ``k + 1`` smallest ids (no more can be asked
for), kept by a grouped limit that Spark applies before it shuffles, so that a code of a
third of all rows costs no more than another. Entries and query codes are dealt into
blocks of bounded size; a task indexes one block of entries and searches it for one
block of queries, and the blocks' answers are merged by distance and id. The more entries a
block has, the nearer is its k-th and the smaller the share of it that is verified (of random codes
13 % of 32,768 and 8 % of 262,144, in about the same time), so blocks are large.

* A null vector is neither indexed nor asked for; a null element or NaN is a zero bit.
* Ties go to the smaller id. A row is not its own neighbour; a repeated id is one row.
* An empty table gives no rows; with fewer than k others, all of them are returned.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.session import materialise

SEGMENT = 16
BITS = 64
SEGMENTS = BITS // SEGMENT
ENTRIES_PER_BLOCK = 262_144
QUERIES_PER_BLOCK = 16_384
LEAST_QUERIES_PER_BLOCK = 512
QUERY_BLOCKS = 32  # as many at least, where there are queries for them


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """One bit per dimension, set where it is above zero, as a long.

    A vector of more dimensions than ``bits`` is an error, as its code would be that of a prefix.
    """
    if not 1 <= bits <= BITS:
        raise ValueError(f"a code has 1 to {BITS} bits, not {bits}")
    code = F.lit(0).cast("long")
    for i in range(bits):
        value = F.get(vector, F.lit(i))
        above = (value > 0) & ~F.isnan(value)
        code = code.bitwiseOR(F.when(above, F.lit(np.int64(np.uint64(1 << i).view(np.int64)).item())).otherwise(F.lit(0).cast("long")))
    error = F.raise_error(F.concat(F.lit(f"a code of {bits} bits cannot hold a vector of "), F.size(vector).cast("string")))
    return F.when(F.size(vector) > bits, error.cast("long")).when(vector.isNotNull(), code)


@lru_cache(maxsize=None)
def masks(radius: int) -> np.ndarray:
    """Every segment value of ``radius`` set bits."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(SEGMENT), radius)], np.uint32)


class SegmentIndex:
    """The codes of one block, by the value of each segment."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes, self.sizes = codes, sizes
        self.verified = 0
        self.order, self.first = [], []
        for s in range(SEGMENTS):
            part = self._part(codes, s)
            self.order.append(np.argsort(part, kind="stable"))
            self.first.append(np.concatenate([[0], np.cumsum(np.bincount(part, minlength=1 << SEGMENT))]))

    @staticmethod
    def _part(codes, s: int):
        return ((codes >> np.uint64(s * SEGMENT)) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64)

    def _probe(self, s: int, values: np.ndarray) -> np.ndarray:
        start, stop = self.first[s][values], self.first[s][values + 1]
        n = stop - start
        full = n > 0
        start, n = start[full], n[full]
        if not len(n):
            return np.empty(0, np.int64)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.order[s][np.repeat(start, n) + inside]

    def nearest(self, query: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries that hold the k nearest rows and all at the last of their distances."""
        seen = np.zeros(len(self.codes), bool)
        rows_at = np.zeros(BITS + 1, np.int64)
        hits, distances = [], []
        for radius in range(SEGMENT + 1):
            for s in range(SEGMENTS):
                found = self._probe(s, int(self._part(query, s)) ^ masks(radius).astype(np.int64))
                found = found[~seen[found]]  # within one segment an entry is met once
                seen[found] = True
                self.verified += len(found)
                d = np.bitwise_count(self.codes[found] ^ query).astype(np.int64)
                hits.append(found)
                distances.append(d)
                rows_at += np.bincount(d, self.sizes[found], BITS + 1).astype(np.int64)
                covered = SEGMENTS * radius + s
                if rows_at[: min(covered, BITS) + 1].sum() >= k:
                    break
            else:
                continue
            break
        hit, distance = np.concatenate(hits), np.concatenate(distances)
        total = np.cumsum(rows_at)
        last = int(np.searchsorted(total, min(k, total[-1])))
        near = distance <= last
        return hit[near], distance[near]


def hamming_top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    entries_per_block: int = ENTRIES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The k rows nearest to each query; both frames have ``id`` and ``code`` (longs).

    Returns query_id, rank (from 1), neighbor_id, distance.
    """
    smallest = Window.partitionBy("code").orderBy("id")
    entries = materialise(
        rows.where("id is not null and code is not null")
        .distinct()
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= k + 1)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "hamming-entries",
    )
    asked = materialise(
        queries.where("id is not null and code is not null").select("id", "code").distinct(), "hamming-queries"
    )
    codes = asked.select("code").distinct()
    n_blocks = max(1, -(-entries.count() // entries_per_block))
    n_codes = codes.count()
    per_block = min(queries_per_block, max(LEAST_QUERIES_PER_BLOCK, n_codes // QUERY_BLOCKS))
    n_asked = max(1, -(-n_codes // per_block))
    block = F.pmod(F.xxhash64("code"), F.lit(n_blocks)).cast("int")
    part = F.pmod(F.xxhash64("code"), F.lit(n_asked)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select("code", part.alias("part"), every(n_blocks).alias("block"))
    right = entries.select("code", "ids", block.alias("block"), every(n_asked).alias("part"))

    def search(asked: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(entries):
            held = entries["ids"].tolist()
            sizes = np.array([len(x) for x in held], np.int64)
            index = SegmentIndex(entries["code"].to_numpy(np.int64).view(np.uint64), sizes)
            for code in asked["code"].to_numpy(np.int64):
                hit, distance = index.nearest(code.view(np.uint64), k + 1)
                order = np.argsort(distance, kind="stable")
                near = [(int(distance[i]), int(x)) for i in order for x in held[hit[i]]]
                out += [(int(code), d, x) for d, x in sorted(near)[: k + 1]]
        return pd.DataFrame(out, columns=["code", "distance", "neighbor_id"])

    keys = ["block", "part"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(search, "code long, distance int, neighbor_id long")
    )
    by_code = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    best = found.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= k + 1)
    ranked = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        asked.withColumnRenamed("id", "query_id")
        .join(best.drop("place"), "code")
        .where("neighbor_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "neighbor_id", "distance")
    )
