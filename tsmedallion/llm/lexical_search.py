"""Ranked lexical search by dense blocked matrix products, with exact integer scores.

Only terms of the items matter. Documents are cut into terms once; what they hold of the items'
vocabulary, with their length, is written to the shared scratch folder. The written
table gives the corpus counts (documents, terms, documents with each term) and is then scored:

* A task takes a tile of documents and a block of items. The terms that both hold make a
  compact vocabulary, cut into tiles. A dense documents x terms tile of impacts times a
  dense terms x items tile of weights is one BLAS product in float64.
* Impacts and weights are integers. A vocabulary tile is closed before the sum of its largest
  products could reach 2^53, so every partial sum is exact in float64 in any order; partial
  products are added as 64-bit integers. A term whose products alone reach it is multiplied in integers.
* Of a tile's scores an item keeps those that reach its k-th best so far, ties
  included, and then the k first by score and id. A task sends k rows an item at most.

The items' (item, term) pairs are sent to every task, at most ``pairs_at_once`` of them
(or one item's); more items take further passes over the documents.

With N documents that have a term, L terms in all, n in a document, df documents that hold a
term and tf occurrences in the document, a term's weight is floor(1000 ln((2N + 2) / (2df + 1))), a
document's m is 25 + 75 n N div L, and a score the sum over the item's terms, repeats included, of
weight x (10^9 tf div (1000 tf + 8 m)).

* A null text has no terms. An item without terms, or whose terms no document holds, has no rows.
* Rows of ``items`` equal in id and text are one item; each other row is ranked by itself.
* Every row of ``docs`` is a document, so repeated rows are ranked side by side. Of equal
  scores the smaller id comes first, and a null id last.
* A long text is cut into terms by slices. Empty tables give no rows.
* Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.llm.common import utf8
from tsmedallion.session import materialise

DOCS_PER_TILE = 2_048
ITEMS_PER_BLOCK = 256
TERMS_PER_TILE = 2_048
PAIRS_AT_ONCE = 4_000_000
BYTES_AT_ONCE = 1 << 20
SALTS = 1_024
EXACT = 1 << 53
MOST_IMPACT = 1_000_000  # 10^9 tf div (1000 tf + 8 m), as m is not negative

# Digits, letters and all bytes of characters beyond ASCII make terms; A-Z as a-z.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    data = text.translate(TERM_BYTES)
    start = 0
    while len(data) - start > BYTES_AT_ONCE:
        cut = data.find(b" ", start + BYTES_AT_ONCE)
        if cut < 0:
            break
        yield data[start:cut].split()
        start = cut
    yield data[start:].split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            held: dict[bytes, int] = {}
            for some in terms(text):
                for t in some:
                    held[t] = held.get(t, 0) + 1
            rows += [(item, t, n) for t, n in held.items()]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int64(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "term", "n"])


@dataclass
class Block:
    """Some items: each one's terms, by place in the vocabulary, and how often it has them."""

    items: np.ndarray
    row: np.ndarray
    term: np.ndarray
    n: np.ndarray


def _blocks(held: pa.Table, vocabulary: dict[bytes, int], items_per_block: int) -> list[Block]:
    items, row = np.unique(held.column("item").to_numpy(), return_inverse=True)
    term = np.array([vocabulary[t] for t in held.column("term").to_pylist()], np.int64)
    n = held.column("n").to_numpy()
    out = []
    for low in range(0, len(items), items_per_block):
        own = (row >= low) & (row < low + items_per_block)
        out.append(Block(items[low : low + items_per_block], row[own] - low, term[own], n[own]))
    return out


@dataclass
class Corpus:
    """Counts over all documents."""

    n_docs: int
    n_terms: int
    weight: np.ndarray  # of each term of the vocabulary

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of each occurrence, given its document's length."""
        if len(n) and 75 * int(n.max()) * self.n_docs >= 1 << 63:
            share = np.array([75 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        else:
            share = 75 * n * self.n_docs // max(1, self.n_terms)
        return 1_000_000_000 * tf // (1_000 * tf + 8 * (25 + share))


def _tiles(largest: list[int], terms_per_tile: int) -> Iterator[tuple[int, int]]:
    """Ranges of terms of which all sums of products stay below 2^53.

    ``largest``: each term's largest weight in an item. A term that is too large
    by itself has a range of its own.
    """
    start, total = 0, 0
    for i, w in enumerate(largest):
        if i > start and (i - start == terms_per_tile or total + w * MOST_IMPACT >= EXACT):
            yield start, i
            start, total = i, 0
        total += w * MOST_IMPACT
    if len(largest) > start:
        yield start, len(largest)


def tile_scores(
    block: Block, weight: np.ndarray, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms_per_tile: int
) -> np.ndarray:
    """(document, item): exact scores of a tile of documents, given by their postings."""
    scores = np.zeros((n_docs, len(block.items)), np.int64)
    shared = np.intersect1d(term, block.term)
    if not len(shared):
        return scores
    at = np.searchsorted(shared, block.term).clip(max=len(shared) - 1)
    own = shared[at] == block.term
    value = block.n[own] * weight[block.term[own]]
    column, row = at[own], block.row[own]
    largest = np.zeros(len(shared), np.int64)
    np.maximum.at(largest, column, value)
    place = np.searchsorted(shared, term).clip(max=len(shared) - 1)
    held = shared[place] == term
    place, doc, impact = place[held], doc[held], impact[held]
    for low, high in _tiles(largest.tolist(), terms_per_tile):
        exact = int(largest[low:high].sum()) * MOST_IMPACT < EXACT
        kind = np.float64 if exact else np.int64
        weights = np.zeros((high - low, len(block.items)), kind)
        inside = (column >= low) & (column < high)
        weights[column[inside] - low, row[inside]] = value[inside]
        impacts = np.zeros((n_docs, high - low), kind)
        inside = (place >= low) & (place < high)
        impacts[doc[inside], place[inside] - low] = impact[inside]
        scores += (impacts @ weights).astype(np.int64)
    return scores


class Best:
    """The k best documents of every item of a block so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)  # a score that still counts
        empty = np.empty(0, np.int64)
        self.held = [(empty, empty, np.empty(0, bool))] * n_items

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        for i in np.nonzero((scores >= self.least).any(axis=0))[0].tolist():
            reach = np.nonzero(scores[:, i] >= self.least[i])[0]
            if len(reach) > self.k:
                kth = np.partition(scores[reach, i], len(reach) - self.k)[len(reach) - self.k]
                reach = reach[scores[reach, i] >= kth]
            old = self.held[i]
            score, doc, none = (np.concatenate(x) for x in zip(old, (scores[reach, i], ids[reach], no_id[reach])))
            first = np.lexsort((doc, none, -score))[: self.k]
            self.held[i] = (score[first], doc[first], none[first])
            if len(first) == self.k:
                self.least[i] = score[first[-1]]


def _shares(pairs: DataFrame, most: int) -> int:
    """Into how many shares, by hash of the item, pairs must go so that none has over
    ``most``, unless it is a single item's."""
    n = max(1, -(-pairs.count() // most))
    while n > 1:
        share = F.pmod(F.xxhash64("item"), F.lit(n))
        sizes = pairs.groupBy("item").agg(F.count("*").alias("n")).groupBy(share.alias("share"))
        over = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("items")).where((F.col("n") > most) & (F.col("items") > 1))
        if over.isEmpty():
            break
        n *= 2
    return n


def _postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for batch in batches:
            lengths, held, counts, offsets = [], [], [], [0]
            for text in utf8(batch.column(1)):
                n, found = 0, []
                for some in terms(text):
                    n += len(some)
                    found.append(np.array([x for x in map(place, some) if x is not None], np.int32))
                own, tf = np.unique(np.concatenate(found), return_counts=True)
                lengths.append(n)
                held.append(own)
                counts.append(tf)
                offsets.append(offsets[-1] + len(own))
            flat = lambda x, kind: pa.array(np.concatenate([np.empty(0, kind), *x]).astype(kind))
            lists = lambda values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), lists(flat(held, np.int32)), lists(flat(counts, np.int64))],
                names=["doc_id", "n", "terms", "tf"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def _searched(
    docs: DataFrame, pairs: pa.Table, k: int, id_col: str, text_col: str, docs_per_tile: int, items_per_block: int, terms_per_tile: int
) -> DataFrame:
    """One pass: item, doc_id and score of each task's best documents."""
    vocabulary = {t: i for i, t in enumerate(sorted(set(pairs.column("term").to_pylist())))}
    postings = materialise(_postings(docs, id_col, text_col, vocabulary), "lexical-postings")
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    found = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    blocks = _blocks(pairs, vocabulary, items_per_block)
    shared = docs.sparkSession.sparkContext.broadcast((blocks, Corpus(n_docs, n_terms, weight)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, corpus = shared.value
        best = [Best(len(b.items), k) for b in blocks]
        for batch in batches:
            for low in range(0, batch.num_rows, docs_per_tile):
                tile = batch.slice(low, docs_per_tile)
                lists = tile.column(2)
                size = np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(tile.num_rows), size)
                n = tile.column(1).to_numpy()[doc]
                impact = corpus.impacts(tile.column(3).flatten().to_numpy(), n)
                term = lists.flatten().to_numpy()
                ids = tile.column(0).fill_null(0).to_numpy()
                no_id = np.asarray(tile.column(0).is_null())
                for block, kept in zip(blocks, best):
                    kept.add(tile_scores(block, corpus.weight, tile.num_rows, doc, term, impact, terms_per_tile), ids, no_id)
        for block, kept in zip(blocks, best):
            item = np.repeat(block.items, [len(s) for s, _, _ in kept.held])
            scores, ids, none = (np.concatenate(x) for x in zip(*kept.held))
            columns = [pa.array(item), pa.array(ids, mask=none), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return postings.where(F.size("terms") > 0).mapInArrow(score, "item long, doc_id long, score long")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    docs_per_tile: int = DOCS_PER_TILE,
    items_per_block: int = ITEMS_PER_BLOCK,
    terms_per_tile: int = TERMS_PER_TILE,
    pairs_at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """The k highest-scoring documents of every item: item_id, rank (from 1), doc_id, score."""
    asked = materialise(
        items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
        .distinct()
        .withColumn("item", F.monotonically_increasing_id()),
        "lexical-items",
    )
    pairs = materialise(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary, n long"), "lexical-pairs")
    n_shares = _shares(pairs, pairs_at_once)
    found = None
    for share in range(n_shares):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(n_shares)) == share).toArrow()
        best = _searched(docs, own, k, id_col, text_col, docs_per_tile, items_per_block, terms_per_tile)
        found = best if found is None else found.unionByName(best)
    # Tasks' answers are merged by salt before the items' own merge, as tasks grow with the corpus.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    for keys in (["item", "salt"], ["item"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("rank", place).where(F.col("rank") <= k)
    return salted.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
