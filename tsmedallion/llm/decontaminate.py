"""Benchmark decontamination by q-gram lemma filtering and bit-parallel alignment.

Texts are compared in a normal form: A-Z in lower case, and every run of other ASCII
characters than letters and digits as one blank. The windows of a benchmark item are its
stretches of ``WINDOW`` characters at every place; a shorter item is one window. A window of
m characters occurs in a document if some stretch of it is within e edits (one per
``CHARS_PER_EDIT`` of the window). So every passage of ``WINDOW`` characters is found with its
whole budget wherever it is cut from the item, and a verbatim one also if it is e shorter.

The lemma: such a stretch shares at least m - q + 1 - q * e of the window's q-grams, all on
diagonals at most e apart; q is so small that this is above zero at every length. The q-grams of a document that any item has are gathered per
item and diagonal band; bands are 2 * e + 2 wide, or more, and overlap by half, so that
every such set of diagonals is within one band. The windows of a band that hold so many of
its q-grams are verified by Myers' bit-parallel alignment with the region of the band, in
which the window must be used whole and the stretch may begin and end anywhere. Nothing
within the budget is missed.

Items are indexed in pieces of ``PIECE`` windows that overlap, so each window is in one piece.

Documents stay where they are: there is no shuffle, and all columns are passed through.
The items are sent to every task in blocks, at most ``BLOCK_CHARS`` characters (or
one item) each, and ``BLOCKS_PER_PASS`` blocks at most at a time. A larger benchmark takes
further passes over the documents, which are written in between, so that neither the driver
nor a task holds more of it.

* Characters are UTF-8 bytes, so that a replaced accented letter costs up to two edits.
* A null or empty text matches nothing. Items whose normal form is shorter than
  ``LEAST_CHARS`` are too short to tell a leak from chance and are not searched; null items
  are skipped. Equal items each match; rows of one id are one item with the windows of all.
  Repeated documents are each marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.llm.common import runs, utf8
from tsmedallion.session import materialise

Q = 10
WINDOW = 64
PIECE = 1 << 10
CHARS_PER_EDIT = 16
LEAST_CHARS = 24
BLOCK_CHARS = 4_000_000
BLOCKS_PER_PASS = 8
CHARS_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 4_096
HITS_AT_ONCE = 1 << 22
BITMAP_BITS = 22
REACH = WINDOW + WINDOW // CHARS_PER_EDIT

_KEPT = bytes(range(48, 58)) + bytes(range(97, 123))
_TABLE = bytes(
    c if c >= 128 or c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(_TABLE).split())


def budget(size: int) -> int:
    """The largest number of edits for a window of ``size`` characters."""
    return size // CHARS_PER_EDIT


def windows(text: bytes) -> list[bytes]:
    """The windows of a normal form, one at every place."""
    if len(text) <= WINDOW:
        return [text] if len(text) >= LEAST_CHARS else []
    return [text[s : s + WINDOW] for s in range(len(text) - WINDOW + 1)]


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q-gram at each place of a byte buffer."""
    n = len(buffer) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    raw = np.ascontiguousarray(buffer)
    head = np.ndarray((n,), "<u8", raw.data, 0, (1,))
    tail = np.ndarray((n,), "<u2", raw.data, 8, (1,)).astype(np.uint64)
    mixed = head * np.uint64(0x9E3779B97F4A7C15) + tail * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITMAP_BITS)


@dataclass
class WindowIndex:
    """The windows of one block of items, by the q-grams of the items' pieces."""

    owner: np.ndarray  # item of each piece, as its place in ids
    ids: list[int]
    texts: list[bytes]  # the pieces

    def __post_init__(self):
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.first = np.cumsum(lengths) - lengths  # of each piece: its place in chars
        self.chars = np.frombuffer(b"".join(self.texts) + b"\0" * WINDOW, np.uint8)
        self.size = np.minimum(lengths, WINDOW)  # of a window of the piece
        self.edits = self.size // CHARS_PER_EDIT
        self.last = lengths - self.size  # where the last window of the piece begins
        self.bound = self.size - Q + 1 - Q * self.edits
        self.step = np.maximum(8, self.edits + 1)  # bands are two steps wide
        hashes, piece, at = [], [], []
        for k, text in enumerate(self.texts):
            own = gram_hashes(np.frombuffer(text, np.uint8))
            hashes.append(own)
            piece.append(np.full(len(own), k))
            at.append(np.arange(len(own)))
        grams = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.piece = np.concatenate(piece)[order] if piece else np.empty(0, np.int64)
        self.at = np.concatenate(at)[order] if at else np.empty(0, np.int64)
        self.grams, rank = np.unique(grams[order], return_inverse=True)
        self.entry = rank * len(self.texts) + self.piece  # ascending: by q-gram, then piece
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[_slot(self.grams)] = True

    def candidates(self, buffer: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, piece, first diagonal, first and last window) of stretches of windows
        that reach the bound.

        ``starts``: where each document begins in ``buffer``.
        """
        hashes = gram_hashes(buffer)
        place = np.nonzero(self.bitmap[_slot(hashes)])[0]
        if not len(place) or not len(self.grams):
            return
        found = np.minimum(np.searchsorted(self.grams, hashes[place]), len(self.grams) - 1)
        real = self.grams[found] == hashes[place]
        place, found = place[real], found[real]
        doc = np.searchsorted(starts, place, side="right") - 1
        yield from self._bands(doc, place - starts[doc], found, 0, len(self.texts))

    def _bands(
        self, doc: np.ndarray, place: np.ndarray, gram: np.ndarray, low: int, high: int
    ) -> Iterator[tuple[np.ndarray, ...]]:
        """``candidates`` of the q-grams at ``place`` of ``doc`` among the pieces low to high.

        A q-gram that many items have makes many hits. Beyond ``HITS_AT_ONCE`` the documents
        are halved, then the pieces, then the places of the document, in halves that share
        ``REACH`` places: no stretch is longer, so each is whole in one half.
        """
        first = np.searchsorted(self.entry, gram * len(self.texts) + low)
        n = np.searchsorted(self.entry, gram * len(self.texts) + high) - first
        total = int(n.sum())
        if not total:
            return
        if total > HITS_AT_ONCE and doc[0] != doc[-1]:
            cut = np.searchsorted(doc, (doc[0] + doc[-1]) // 2, side="right")
            for part in (slice(None, cut), slice(cut, None)):
                yield from self._bands(doc[part], place[part], gram[part], low, high)
            return
        if total > HITS_AT_ONCE and high - low > 1:
            middle = (low + high) // 2
            yield from self._bands(doc, place, gram, low, middle)
            yield from self._bands(doc, place, gram, middle, high)
            return
        if total > HITS_AT_ONCE and place[-1] - place[0] > 4 * REACH:
            middle = (place[0] + place[-1]) // 2
            for part in (place <= middle + REACH, place > middle):
                yield from self._bands(doc[part], place[part], gram[part], low, high)
            return
        hit = np.repeat(first, n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        doc, piece, at = np.repeat(doc, n), self.piece[hit], self.at[hit]
        # A diagonal is the place in the document less the place in the piece.
        band = (np.repeat(place, n) - at) // self.step[piece]
        least = int(band.min()) - 1
        span = int(band.max()) - least + 1
        if (int(doc[-1]) + 1) * len(self.texts) * span >= 1 << 62:
            raise OverflowError("too many bands in one piece; lower CHARS_AT_ONCE or BLOCK_CHARS")
        # Band b has the diagonals of steps b and b + 1; each q-gram is in two bands.
        one = (doc * len(self.texts) + piece) * span - least
        keys = np.concatenate([one + band, one + band - 1])
        _, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
        enough = np.nonzero(counts[group] >= np.tile(self.bound[piece], 2))[0]
        keys, at = keys[enough], at[enough % total]
        order = np.lexsort((at, keys))
        keys, at = keys[order], at[order]
        piece = keys // span % len(self.texts)
        # A window has the bound's number of q-grams if so many in a row fit in it.
        end = np.arange(len(keys)) + self.bound[piece] - 1
        there = np.minimum(end, len(keys) - 1)
        reach = self.size[piece] - Q
        fits = (end == there) & (keys[there] == keys) & (at[there] - at <= reach)
        first, last = np.maximum(0, at[there] - reach)[fits], np.minimum(at, self.last[piece])[fits]
        keys, piece = keys[fits], piece[fits]
        doc, diagonal = keys // span // len(self.texts), (keys % span + least) * self.step[piece]
        # Both ends ascend within a band, so a window is left out if one before has had it.
        again = np.concatenate([[False], keys[1:] == keys[:-1]]) if len(keys) else np.empty(0, bool)
        first = np.where(again, np.maximum(first, np.concatenate([[0], last[:-1] + 1])[: len(last)]), first)
        some = first <= last
        yield doc[some], piece[some], diagonal[some], first[some], last[some]

    def matches(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Verified (document, piece, place of the window in the piece, edits)."""
        for doc, piece, diagonal, first, last in self.candidates(buffer, starts):
            ends = np.cumsum(last - first + 1)
            for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS_AT_ONCE):
                pair = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
                k = np.searchsorted(ends, pair, side="right")
                at = last[k] - (ends[k] - 1 - pair)
                edits = self._align(buffer, starts[doc[k]], sizes[doc[k]], piece[k], at, diagonal[k])
                good = edits <= self.edits[piece[k]]
                yield doc[k][good], piece[k][good], at[good], edits[good]

    def _align(self, buffer, starts, limit, piece, at, diagonal):
        """Fewest edits between each whole window and any stretch near its band.

        Myers' algorithm: bit i of the words stands for character i of the window, and one
        step takes one character of the document for all pairs.
        """
        pairs = np.arange(len(piece))
        masks = np.zeros((len(piece), 256), np.uint64)
        for i in range(int(self.size[piece].max(initial=0))):
            inside = pairs[i < self.size[piece]]
            masks[inside, self.chars[(self.first[piece] + at + i)[inside]]] |= np.uint64(1 << i)
        one = np.uint64(1)
        top = (self.size[piece] - 1).astype(np.uint64)
        cost = self.size[piece].copy()
        best = cost.copy()
        up, down = np.full(len(piece), ~np.uint64(0)), np.zeros(len(piece), np.uint64)
        slack = int(self.edits[piece].max(initial=0))
        low = diagonal + at - slack
        length = int((self.size[piece] + 2 * self.step[piece]).max(initial=0)) + 2 * slack
        for i in range(length):
            place = low + i
            inside = (place >= 0) & (place < limit)
            char = np.where(inside, buffer[np.where(inside, starts + place, 0)], 0)  # no window has a zero
            same = masks[pairs, char]
            vertical = same | down
            flat = (((same & up) + up) ^ up) | same
            more, less = down | ~(flat | up), up & flat
            cost += ((more >> top) & one).astype(np.int64) - ((less >> top) & one).astype(np.int64)
            np.minimum(best, cost, out=best)
            more, less = more << one, less << one  # a stretch may begin anywhere
            up, down = less | ~(vertical | more), more & vertical
        return best


MATCHES = T.ArrayType(
    T.StructType(
        [T.StructField("item_id", T.LongType()), T.StructField("windows", T.LongType()), T.StructField("edits", T.LongType())]
    )
)
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("windows", pa.int64()), ("edits", pa.int64())]))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of at most ``block_chars`` characters (or one item), in item order.

    The driver holds one partition's items at a time, never the benchmark.
    """
    rows = benchmark.where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long"), F.col(text_col)
    )
    block, chars = [], 0
    for item, text in rows.toLocalIterator():
        form = normal(text.encode())
        if block and chars + len(form) > block_chars:
            yield block
            block, chars = [], 0
        block.append((item, form))
        chars += len(form)
    if block:
        yield block


def _index(block: list[tuple[int, bytes]]) -> WindowIndex:
    cut = [
        (i, text[s : s + PIECE + WINDOW - 1])
        for i, (_, text) in enumerate(block)
        if len(text) >= LEAST_CHARS
        for s in range(0, max(1, len(text) - WINDOW + 1), PIECE)
    ]
    return WindowIndex(np.array([i for i, _ in cut], np.int64), [item for item, _ in block], [t for _, t in cut])


def mark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    matches_col: str = "leaks",
    block_chars: int = BLOCK_CHARS,
    blocks_per_pass: int = BLOCKS_PER_PASS,
) -> DataFrame:
    """``docs`` with ``matches_col``: per matched item the windows found and their edits.

    Rows are not dropped; the array is empty for a clean document.
    """
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_col, item_text_col, block_chars)
    marked = docs.withColumn(matches_col, F.array().cast(MATCHES))
    group = list(islice(blocks, blocks_per_pass))
    while group:
        shared = [context.broadcast(b) for b in group]
        marked = _search(marked, docs.columns.index(text_col), shared)
        group = list(islice(blocks, blocks_per_pass))
        if group:
            marked = materialise(marked, "marked")
            for block in shared:
                block.destroy()
    return marked


def _search(marked: DataFrame, place: int, shared: list[Broadcast]) -> DataFrame:
    """Add the matches of the blocks ``shared`` to the last column."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _index(shared[0].value) if len(shared) == 1 else None
        for batch in batches:
            texts = [normal(t) for t in utf8(batch.column(place))]
            known = [{m["item_id"]: (m["windows"], m["edits"]) for m in row} for row in batch.columns[-1].to_pylist()]
            for block in shared:
                index = held or _index(block.value)
                for low, high in runs(map(len, texts), CHARS_AT_ONCE):
                    found: list[dict[int, tuple[set[int], int]]] = [{} for _ in range(low, high)]
                    _collect(index, texts[low:high], found)
                    for before, new in zip(known[low:high], found):
                        for item, (windows, edits) in new.items():
                            n, fewest = before.get(item, (0, edits))
                            before[item] = n + len(windows), min(fewest, edits)
            rows = [[{"item_id": i, "windows": n, "edits": e} for i, (n, e) in sorted(k.items())] for k in known]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, _ARROW)], names=batch.schema.names)

    return marked.mapInArrow(search, marked.schema)


def _collect(index: WindowIndex, texts: list[bytes], found: list[dict]) -> None:
    """Add the matches of ``texts`` to ``found``: item -> (its windows, fewest edits)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    buffer = np.frombuffer(b"\0".join(texts) + b"\0" * (Q + 8), np.uint8)  # no normal form has a zero
    for docs, pieces, ats, edits in index.matches(buffer, starts, sizes):
        windows_ = (index.first[pieces] + ats).tolist()
        for doc, owner, window, n in zip(docs.tolist(), index.owner[pieces].tolist(), windows_, edits.tolist()):
            item = index.ids[owner]
            seen, fewest = found[doc].get(item, (set(), n))
            seen.add(window)
            found[doc][item] = (seen, min(n, fewest))
