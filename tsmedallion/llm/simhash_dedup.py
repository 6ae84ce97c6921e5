"""SimHash near-duplicates by Golay-code fuzzy hashing.

Two texts are linked if their 64-bit fingerprints differ in at most four bits. The perfect
binary Golay code (23 bits, 4096 codewords, radius 3) decodes any 23-bit word to one
codeword. The keys of a word are the codeword indices of the word itself and of every word
one bit away: one key or six. If two words differ in at most two bits, some word is within
one bit of both, so they share a key.

The fingerprint is cut into segments of 23, 23 and 18 bits. Of at most four errors

* some segment has none, and of the other two one has at most two: the pair agrees in that
  segment's exact bits and shares a Golay key of the other (six ordered choices), or
* every segment has at least one, so two have exactly one and the third has one or two: the
  pair shares a Golay key of the third and agrees in a half of each of the others (three
  choices of the third, four of the halves).

So a fingerprint has about 90 keys of over 32 bits, and linked fingerprints share at least one. Candidates
are joined by key and verified by their distance. Only connectivity is asked for, so a bucket
that is one component after the first step is not paired out; one of many components is,
but for the pairs within its commonest:

1. every fingerprint is compared with the smallest one of its bucket (a star), and the
   components of the verified links are found;
2. a bucket whose members are all in one component can add nothing. In any other, the
   members outside its commonest component are compared with all members of another
   component, which tests every pair that is still open.

Equal fingerprints are one entry throughout, so a group of copies costs one row.

* A null or empty text has no words and fingerprint zero, linked like any other.
* Rows without an id belong to their component but do not name it; a component of only
  such rows has a null ``component_id``. Repeated rows are returned as often as given.
* An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.llm.common import unused, utf8
from tsmedallion.session import materialise

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
PRINTS_PER_TASK = 16_384

# The generator polynomial of the binary Golay code, and the segments'
# first bits and widths.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half the hashes of the text's word shingles."""
    words = text.lower().split()  # of bytes: A-Z only, and cut at \x20 \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes) + np.arange(len(words))
    n = max(1, len(words) - shingle + 1)
    starts, ends = (ends - sizes)[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, n, SHINGLES_AT_ONCE):
        spans = list(zip(starts[i : i + SHINGLES_AT_ONCE], ends[i : i + SHINGLES_AT_ONCE]))
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", len(spans))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of the upper twelve bits, and the error pattern of each syndrome."""
    upper = np.array([_syndrome(i << 11) for i in range(4096)], np.int64)
    error = np.zeros(2048, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            error[_syndrome(pattern)] = pattern
    return upper, error


UPPER, ERROR = _tables()


def golay_index(words: np.ndarray) -> np.ndarray:
    """The index (0 to 4095) of the codeword within three bits of each 23-bit word."""
    return (words ^ ERROR[UPPER[words >> 11] ^ (words & 2047)]) >> 11


def golay_keys(words: np.ndarray, width: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each word: (its position, key). Only ``width`` bits can differ."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.int64)
    keys = np.sort(golay_index(words[:, None] ^ flips), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(new)[0], keys[new]


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All join keys of the fingerprints (uint64): (position, key)."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64) for at, w in SEGMENTS]
    golay = [golay_keys(p, w) for p, (_, w) in zip(parts, SEGMENTS)]
    rows, keys = [], []
    for a in range(3):
        for b in range(3):
            if a != b:
                row, key = golay[a]
                rows.append(row)
                keys.append((np.int64(3 * a + b) << 40) | (key << 23) | parts[b][row])
    halves = [(p & ((1 << w // 2) - 1), p >> w // 2) for p, (_, w) in zip(parts, SEGMENTS)]
    for third, (row, key) in enumerate(golay):
        x, y = (i for i in range(3) if i != third)
        for i in range(2):
            for j in range(2):
                rows.append(row)
                tag = np.int64(9 + 4 * third + 2 * i + j) << 40
                keys.append(tag | (key << 24) | (halves[x][i][row] << 12) | halves[y][j][row])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """id, fp (a signed long) and text_hash of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in utf8(batch.column(1))]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, batch.column(2)], names=["id", "fp", "text_hash"])

    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, fp long, text_hash long")


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node: edges (u, v) give rows (node, root).

    Large-star and small-star steps in turn: every node hands its neighbours to the
    smallest of them, until nothing changes. Only minima are aggregated and joined, so no
    task holds the neighbours of a node. Each round is written to the scratch folder.
    """
    edges = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def link_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the distinct fingerprints ``prints`` (column fp)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} bits, not {max_bits}")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0)).astype(np.int64)
            rows, keys = fuzzy_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", "fp"])

    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    prints = materialise(prints, "prints")
    dealt = prints.repartition(prints.count() // PRINTS_PER_TASK + 1, "fp")  # each row becomes 90
    keyed = materialise(dealt.mapInArrow(expand, "key long, fp long"), "keys")
    heads = keyed.groupBy("key").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = materialise(keyed.join(heads.drop("n"), "key"), "shared-keys")

    stars = shared.where(F.col("fp") != F.col("head")).where(near("fp", "head"))
    first = components(stars.select(F.col("fp").alias("u"), F.col("head").alias("v")))
    placed = materialise(
        shared.drop("head")
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("comp", F.coalesce("root", "fp"))
        .drop("root"),
        "placed-keys",
    )
    mixed = (
        placed.groupBy("key", "comp")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps"))
        .where("comps > 1")
        .drop("comps")
    )
    still = materialise(placed.join(mixed, "key"), "open-keys")
    one = still.where("comp <> main").select("key", F.col("fp").alias("fp_a"), F.col("comp").alias("u"))
    other = still.select("key", F.col("fp").alias("fp_b"), F.col("comp").alias("v"))
    rest = one.join(other, (one.key == other.key) & (F.col("u") != F.col("v")) & near("fp_a", "fp_b"))
    second = components(rest.select("u", "v").distinct())
    return (
        prints.join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("comp", F.coalesce("root", "fp"))
        .drop("root")
        .join(second.withColumnRenamed("node", "comp"), "comp", "left")
        .select("fp", F.coalesce("root", "comp").alias("root"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Of every row: id, fp, component_id, root (names the component) and text_hash."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    roots = materialise(link_components(prints.select("fp").distinct(), max_bits), "roots")
    smallest = prints.groupBy("fp").agg(F.min("id").alias("smallest"))
    names = roots.join(smallest, "fp").groupBy("root").agg(F.min("smallest").alias("component_id"))
    labels = materialise(roots.join(names, "root"), "labels")
    return prints.join(labels, "fp").select("id", "fp", "component_id", "root", "text_hash")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The row with the smallest id of each component, with the columns of ``docs``.

    Of rows with that id the one with the smallest text hash stays; rows without an id come
    last. Where whole rows repeat, one is kept.
    """
    id_key, hash_key, place = unused(docs, "id_key", "hash_key", "place")
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    key = lambda c: F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("#"), c.cast("string")))
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    )
    kept = kept.select(key(F.col("first.id")).alias(id_key), F.col("first.text_hash").alias(hash_key)).distinct()
    keyed = docs.withColumns({id_key: key(F.col(id_col)), hash_key: F.xxhash64(text_col)})
    rows = keyed.join(kept, [id_key, hash_key], "left_semi")
    order = Window.partitionBy(id_key, hash_key).orderBy(*sortable(docs, id_col, text_col))
    return (
        rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
    )


def sortable(docs: DataFrame, *known: str) -> list:
    """An order that tells rows of one id and text apart by their other columns."""
    plain = {"string", "bigint", "int", "double", "float", "boolean", "date", "timestamp", "smallint", "tinyint"}
    named = [c for c, t in docs.dtypes if c not in known and t in plain]
    return [F.col(f"`{c}`") for c in named] or [F.lit(0)]
