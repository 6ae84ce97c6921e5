"""Quality classifier by co-training on two views of a document.

The text view has the content (shares of characters and of hashed character pairs, word
and line statistics); the metadata view has source, language and length, hashed. Each view
trains a logistic regression on labelled documents. In every round both score all unlabelled
documents, and each hands the documents it is surest of, with their pseudo-labels, to the
other's training set. At the end each view is calibrated on labelled documents held out of
training, and the calibrated log odds are added (less the prior that both contain).

Features are computed once, joined with the labels and written to the scratch folder; a
round is one pass over them without a join, in which a task keeps its surest documents and
Spark merges these, by salts and then as a whole, to the surest of all. Copies are one: of equal
features the smallest id counts. What a view has been taught leaves the pool of the view that
taught it, so that each round hands over others.
The driver fits on a bounded sample: at most ``MAX_LABELLED`` labelled documents (those with
the smallest hash of their id, of which hardly more are sorted) and ``PSEUDO`` pseudo-labelled ones a
view and round. Neither bound grows with the corpus. The scoring, the choice of pseudo-labels and the
statistics cover every document.

* A null text is an empty text; null metadata is a value of its own.
* Labels that are null are not used; of several labels for one id the mean decides, a tie
  is good. Repeated documents are each scored. A null id is never labelled.
* With no labels of one of the two classes the score is the share of good labels (0.5
  without any) for every document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.llm.common import utf8
from tsmedallion.session import materialise

MAX_LABELLED = 20_000
ROUNDS = 3
PSEUDO = 400
SURE = 0.95
ROWS_PER_SALT = 1_000_000
LEAST_SALTS = 16
HELD_PART = 5  # one in so many labelled documents calibrates
RIDGE = 1.0
PAIR_BUCKETS = 64
TEXT_SIZE = 128 + 4 + PAIR_BUCKETS + 8
META_SIZE = 32 + 16 + 4


def text_features(text: bytes) -> np.ndarray:
    out = np.zeros(TEXT_SIZE, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    counts = np.bincount(raw, minlength=256)
    out[:128] = np.sqrt(counts[:128] / len(raw))
    out[128:132] = np.sqrt(counts[128:].reshape(4, 32).sum(axis=1) / len(raw))
    pairs = (raw[:-1].astype(np.uint32) * 31 + raw[1:] * np.uint32(7)) % PAIR_BUCKETS
    out[132 : 132 + PAIR_BUCKETS] = np.sqrt(np.bincount(pairs, minlength=PAIR_BUCKETS) / len(raw))
    words, lines = text.split(), text.split(b"\n")
    rest = out[132 + PAIR_BUCKETS :]
    rest[0] = np.log1p(len(raw)) / 10
    rest[1] = np.log1p(len(words)) / 10
    rest[2] = len(raw) / max(1, len(words)) / 10
    rest[3] = len(set(words)) / max(1, len(words))
    rest[4] = len(set(lines)) / len(lines)
    rest[5] = counts[65:91].sum() / len(raw)
    rest[6] = counts[48:58].sum() / len(raw)
    rest[7] = (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / len(raw)
    return out


def meta_features(source: bytes | None, lang: bytes | None, length: float | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    out[zlib.crc32(b"-" if source is None else b"+" + source) % 32] = 1
    out[32 + zlib.crc32(b"-" if lang is None else b"+" + lang) % 16] = 1
    if length is None:
        out[48] = 1
    else:
        size = np.log1p(max(0.0, float(length))) / 10
        out[49:] = size, size * size, size < 0.5
    return out


@dataclass
class Logistic:
    """Weights with the intercept last, and the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton steps, halved while they do not improve."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float64)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)

    def loss(w):
        m = z @ w
        return np.logaddexp(0, m).sum() - y @ m + (penalty * w * w).sum() / 2

    w = np.zeros(z.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), slope)
        size = 1.0
        while size > 1e-4 and (new := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-4 or now - new < 1e-8 * max(1.0, abs(now)):
            break
        w, now = w - size * step, new
    return Logistic(mean, scale, w)


@dataclass
class CoModel:
    """Both views with their calibrations; ``prior`` alone decides if a class had no labels."""

    prior: float
    views: tuple[Logistic, Logistic] | None = None
    calibrations: tuple[Logistic, Logistic] | None = None

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good by text, by metadata, and by both."""
        if self.views is None:
            flat = np.full(len(text), self.prior)
            return flat, flat, flat
        odds = [c.log_odds(v.log_odds(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, (text, meta))]
        both = odds[0] + odds[1] - np.log(self.prior / (1 - self.prior))
        return tuple(1 / (1 + np.exp(-np.clip(o, -50, 50))) for o in (*odds, both))


def features(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, length_col: str
) -> DataFrame:
    """id and both feature vectors, as bytes of float32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, lang = (batch.column(i).cast(pa.large_binary()).to_pylist() for i in (2, 3))
            length = batch.column(4).to_pylist()
            text = [text_features(t).tobytes() for t in utf8(batch.column(1))]
            meta = [meta_features(*m).tobytes() for m in zip(source, lang, length)]
            columns = [batch.column(0), pa.array(text, pa.binary()), pa.array(meta, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_view", "meta_view"])

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(length_col).cast("double").alias("length"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text_view binary, meta_view binary")


def with_labels(vectors: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``vectors`` with y: 1 or 0, or null where there is no label."""
    marked = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    )
    return vectors.join(marked, "id", "left").select("id", "text_view", "meta_view", "y")


def _matrix(column: list[bytes] | pa.ChunkedArray, size: int) -> np.ndarray:
    values = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(values), np.float32).reshape(-1, size)


def _features_key(text: bytes, meta: bytes) -> int:
    """Tells features apart; signed, as Spark's longs are."""
    return int.from_bytes(hashlib.blake2b(text + meta, digest_size=8).digest(), "big", signed=True)


class _Surest:
    """The surest documents of one view and class so far, one for each feature vector."""

    def __init__(self, n: int, taught: set[int]):
        self.n, self.taught = n, taught
        self.held: dict[int, tuple] = {}  # by features: (-sureness, id, text, meta)

    def add(self, sure: np.ndarray, ids: list, texts: list[bytes], metas: list[bytes], bound: float) -> None:
        least = bound if len(self.held) < self.n else max(bound, -max(self.held.values())[0])
        for i in np.nonzero(sure >= least)[0].tolist():
            key = _features_key(texts[i], metas[i])
            if key in self.taught:
                continue
            low, first, *_ = self.held.get(key, (0.0, ids[i]))
            self.held[key] = (min(low, -float(sure[i])), min(first, ids[i]), texts[i], metas[i])
            if len(self.held) > 4 * self.n:
                self._cut()
        self._cut()

    def _cut(self) -> None:
        self.held = dict(sorted(self.held.items(), key=lambda x: x[1][:2])[: self.n])


def _surest(
    rows: DataFrame, views: tuple[Logistic, Logistic], n: dict[int, int], taught: tuple[set[int], set[int]], salts: int
) -> pa.Table:
    """The unlabelled documents that each view is surest of, of each class, at most ``n[class]``.

    ``taught`` has what each view has handed over before. Of equal sureness the smaller id goes first.
    """
    bound = float(np.log(SURE / (1 - SURE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(view, y): _Surest(n[y], taught[view]) for view in (0, 1) for y in (0, 1)}
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            ids, texts, metas = (c.to_pylist() for c in batch.columns)
            text, meta = _matrix(texts, TEXT_SIZE), _matrix(metas, META_SIZE)
            for view, odds in enumerate(v.log_odds(x) for v, x in zip(views, (text, meta))):
                for y in (0, 1):
                    best[view, y].add(odds if y else -odds, ids, texts, metas, bound)
        held = [(view, y, -low, i, key, t, m) for (view, y), b in best.items() for key, (low, i, t, m) in b.held.items()]
        if held:
            kinds = (pa.int32(), pa.int32(), pa.float64(), kind, pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["view", "y", "odds", "id", "key", "text_view", "meta_view"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"view int, y int, odds double, id {kind}, key long, text_view binary, meta_view binary")
    # Equal features of several tasks, then the surest by salt, then of all.
    found = found.groupBy("view", "y", "key").agg(
        F.max("odds").alias("odds"), F.min("id").alias("id"), F.min("text_view").alias("text_view"), F.min("meta_view").alias("meta_view")
    )
    salt = F.pmod(F.xxhash64("key"), F.lit(salts))
    for keys in (["view", "y", salt], ["view", "y"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("odds"), "id")
        found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(n.values()))
    most = F.when(F.col("y") == 1, F.lit(n[1])).otherwise(F.lit(n[0]))
    return found.where(F.col("place") <= most).select("view", "y", "id", "text_view", "meta_view").orderBy("view", "y", "place").toArrow()


def _sample(labelled: DataFrame, most: int) -> pa.Table:
    """The ``most`` labelled rows with the smallest hashes of their ids.

    A bound on the hash, from the number of rows, leaves little more than that to be sorted.
    """
    n = labelled.count()
    share = (most + 8 * most**0.5 + 64) / max(1, n)
    near = labelled
    if share < 1:
        near = labelled.where(F.xxhash64("id") < F.lit(round(-(2**63) + share * 2**64)).cast("long"))
    return near.orderBy(F.xxhash64("id"), "id", "text_view", "meta_view").limit(most).toArrow()


def co_train(
    vectors: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, pseudo: int = PSEUDO
) -> CoModel:
    """Learn from the labelled and the unlabelled rows of ``vectors`` (written features)."""
    sample = _sample(vectors.where("y is not null"), max_labelled)
    y = sample.column("y").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return CoModel(float(y.mean()) if len(y) else 0.5)
    prior = float(y.mean())
    x = [_matrix(sample.column("text_view"), TEXT_SIZE), _matrix(sample.column("meta_view"), META_SIZE)]
    held = np.array([zlib.crc32(str(i).encode()) % HELD_PART == 0 for i in sample.column("id").to_pylist()])
    if not all((y[part] == c).any() for part in (held, ~held) for c in (0, 1)):
        held = np.zeros(len(y), bool)  # too few labels to hold any out
    train_x = [v[~held] for v in x]
    train_y = [y[~held], y[~held]]
    views = tuple(fit(a, b) for a, b in zip(train_x, train_y))
    unlabelled = vectors.where("id is not null and y is null").select("id", "text_view", "meta_view")
    salts = max(LEAST_SALTS, unlabelled.count() // ROWS_PER_SALT)
    n = {1: max(1, round(pseudo * prior)), 0: max(1, round(pseudo * (1 - prior)))}
    taught: tuple[set[int], set[int]] = (set(), set())
    for _ in range(rounds):
        found = _surest(unlabelled, views, n, taught, salts)
        teacher, new_y = found.column("view").to_numpy(), found.column("y").to_numpy().astype(np.float64)
        texts, metas = found.column("text_view").to_pylist(), found.column("meta_view").to_pylist()
        for view, text, meta in zip(teacher.tolist(), texts, metas):
            taught[view].add(_features_key(text, meta))
        new = [_matrix(texts, TEXT_SIZE), _matrix(metas, META_SIZE)]
        train_x = [np.vstack([train_x[v], new[v][teacher != v]]) for v in (0, 1)]
        train_y = [np.append(train_y[v], new_y[teacher != v]) for v in (0, 1)]
        views = tuple(fit(a, b) for a, b in zip(train_x, train_y))
    fold = held if held.any() else ~held
    calibrations = tuple(fit(v.log_odds(a[fold])[:, None], y[fold]) for v, a in zip(views, x))
    return CoModel(prior, views, calibrations)


def score(vectors: DataFrame, model: CoModel, id_col: str = "doc_id") -> DataFrame:
    """id, text_score, meta_score and score (all probabilities of good) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, meta = _matrix(batch.column(1).to_pylist(), TEXT_SIZE), _matrix(batch.column(2).to_pylist(), META_SIZE)
            columns = [batch.column(0), *map(pa.array, model.scores(text, meta))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "text_score", "meta_score", "score"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "text_view", "meta_view").mapInArrow(
        run, f"`{id_col}` {kind}, text_score double, meta_score double, score double"
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    length_col: str = "n_chars",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Co-train on ``docs`` and ``labels`` and score every row of ``docs``."""
    vectors = features(docs, id_col, text_col, source_col, lang_col, length_col)
    vectors = materialise(with_labels(vectors, labels, id_col, label_col), "quality-features")
    return score(vectors, co_train(vectors, max_labelled), id_col)
