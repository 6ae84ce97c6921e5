"""Alignment of two tokenizers' tokens, with corpus-wide document counts of aligned pairs.

Both tokenizers cut the same bytes (the text behind one space). Places where both end a token
cut the text into groups; two tokens whose byte ranges overlap are linked. The number of
documents that hold an id pair linked says how usual that pair is, and each id of the
first tokenizer has a best partner, that with the highest number.

Texts are cut into words at spaces between two non-spaces: no token of either side crosses such
a place, so a task encodes each distinct word of a run once.

Counting is external, by spilled runs:

1. A task cuts its documents into runs of bounded size. It gathers the pair-document records
   of a run, sorts its pairs by side (first id, then second) and radix-partitions them by the
   first id into zstd blocks of ascending pairs, each with its number of documents.
   Documents keep their records as places in the run's list of pairs. Both are written once,
   to the shared scratch folder.
2. A group of at most ``FAN_IN`` runs of one radix is merged through a heap that holds the
   last pair of each run's open block. More runs than that are first merged into longer ones,
   as often as it takes.
3. The last merge has whole counts. It is in side-major order, so when the first id
   changes, the maximum of the last one is known, and the counts are streamed back to the runs
   that were merged, in their own order, then down to the first runs and their documents.

A run's pairs go to a radix at most once, however often a pair occurs, and the pairs of
a radix are bounded by the vocabularies; no task holds more than ``FAN_IN`` blocks' worth
of one radix, or one run.

* A null or empty text, or one that a tokenizer does not give back byte by byte (it
  normalises it), has no tokens: all numbers are 0 and its groups are the empty text.
* Every row is a document, so repeated rows and rows without an id count each.
* A long text is cut and encoded by slices. A single word is encoded whole, however long.
* An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tsmedallion.session import materialise

RADIXES = 256
FAN_IN = 128
BLOCK_PAIRS = 8_192
CHARS_PER_RUN = 6_000_000
CHARS_AT_ONCE = 1_000_000
WORDS_AT_ONCE = 1_000
MAX_VOCABULARY = 1 << 20

# A space between two other characters that are no white space.
WORD_CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"


def _unicode_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters are their own bytes; the other bytes follow from 256 on.
    """
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their entries, and how texts may be cut for them."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=pieces)
        byte_of = _unicode_bytes()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        written = [entries.get(i, "") for i in range(max(entries, default=-1) + 1)]
        self.a_bytes = [bytes(byte_of[c] for c in t if c in byte_of) for t in written]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(names)
        ]
        if max(len(self.a_bytes), len(self.b_bytes)) > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary has over {MAX_VOCABULARY} entries")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # A piece that goes on behind an inner space would cross words.
        cut = (json.loads(byte_level).get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.by_word = cut and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in names)
        # A token's id in a written group, with what follows it.
        self.shown = [b"%d%s" % (i, x) for i in range(max(len(self.a_bytes), len(self.b_bytes))) for x in (b",", b"|", b";")]
        self.shown_size = np.array([len(x) for x in self.shown], np.int64)

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text in order, some at a time."""
        start = 0
        while self.by_word and len(text) - start > CHARS_AT_ONCE:
            cut = WORD_CUT.search(text, start + CHARS_AT_ONCE)
            if cut is None:
                break
            yield WORD_CUT.split(text[start : cut.start()])
            start = cut.end()
        rest = text[start:] if start else text
        yield WORD_CUT.split(rest) if self.by_word else [rest]

    def encode(self, words: list[str]) -> tuple[list[int], list[int]] | None:
        """Ids of the words, each behind a space; None if they are not their bytes."""
        joined = " ".join(words)
        a = self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids
        b = self.b.encode(joined, num_threads=1) if joined else []
        wanted = (" " + joined).encode()
        if any(b"".join(map(t.__getitem__, ids)) != wanted for t, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        return a, b


@dataclass
class Words:
    """Aligned tokens of the distinct words of a run."""

    sound: np.ndarray  # of each word: whether it has its bytes
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    first: np.ndarray  # of each word, and at the end: its first link
    pairs: np.ndarray  # of each link: first id << 32 | second id
    groups: list[bytes]  # of each word, as written


def align_words(tokenizers: Tokenizers, words: list[str]) -> Words:
    # Words that begin or end with white space must not be joined to others.
    plain = [i for i, w in enumerate(words) if w and not (w[0].isspace() or w[-1].isspace())]
    lone = sorted(set(range(len(words))) - set(plain))
    todo = [plain[i : i + WORDS_AT_ONCE] for i in range(0, len(plain), WORDS_AT_ONCE)] + [[i] for i in lone]
    order, a, b, sound = [], [], [], np.zeros(len(words), bool)
    while todo:
        own = todo.pop()
        found = tokenizers.encode([words[i] for i in own])
        if found is None and len(own) > 1:
            half = len(own) // 2
            todo += [own[:half], own[half:]]
            continue
        order += own
        if found is not None:
            sound[own] = True
            a.append(np.array(found[0], np.int64))
            b.append(np.array(found[1], np.int64))
    a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (a, b))
    sizes = np.array([1 + len(words[i].encode()) if sound[i] else 0 for i in order], np.int64)
    end_a, end_b = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
    cut_a, cut_b = (np.zeros(int(sizes.sum()) + 1, bool) for _ in "ab")
    cut_a[end_a], cut_b[end_b] = True, True
    both = cut_a & cut_b
    upto_a, upto_b, upto_both, upto_any = (np.cumsum(x) for x in (cut_a, cut_b, both, cut_a | cut_b))

    # Between two neighbouring cuts there is one token of each side: one link.
    at = np.nonzero(cut_a | cut_b)[0]
    pairs = a[upto_a[at] - cut_a[at]] << 32 | b[upto_b[at] - cut_b[at]]

    # The tokens as they are written: a group's first side, then its second.
    ends = np.nonzero(both)[0]
    starts = np.concatenate([[0], ends])
    group_a, group_b = upto_both[end_a] - both[end_a], upto_both[end_b] - both[end_b]
    shown = np.empty(len(a) + len(b), np.int64)
    shown[np.arange(len(a)) + upto_b[starts[group_a]]] = a * 3 + both[end_a]
    shown[np.arange(len(b)) + upto_a[ends[group_b]]] = b * 3 + 2 * both[end_b]
    text = b"".join(map(tokenizers.shown.__getitem__, shown.tolist()))
    byte = np.concatenate([[0], np.cumsum(tokenizers.shown_size[shown])])

    stop = np.cumsum(sizes)
    start = stop - sizes
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    low, high = start[place], stop[place]
    written = zip(byte[upto_a[low] + upto_b[low]].tolist(), byte[upto_a[high] + upto_b[high]].tolist())
    link_low, n_links = upto_any[low], upto_any[high] - upto_any[low]
    first = np.concatenate([[0], np.cumsum(n_links)])
    return Words(
        sound,
        upto_a[high] - upto_a[low],
        upto_b[high] - upto_b[low],
        upto_both[high] - upto_both[low],
        first,
        pairs[_ranges(link_low, n_links)],
        [text[x : y - 1] if y > x else b"" for x, y in written],
    )


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each of ``first`` on, ``n`` of them, one after the other."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def _pack(*columns: np.ndarray) -> bytes:
    from zstandard import ZstdCompressor

    return ZstdCompressor(level=3).compress(b"".join(np.asarray(c, np.int64).tobytes() for c in columns))


def _unpack(blob: bytes, n_columns: int) -> list[np.ndarray]:
    from zstandard import ZstdDecompressor

    return list(np.frombuffer(ZstdDecompressor().decompress(blob), np.int64).reshape(n_columns, -1))


def _blocks(pairs: np.ndarray, *more: np.ndarray, block_pairs: int) -> list[bytes]:
    """Ascending pairs, and numbers with them, as blocks."""
    out = []
    for low in range(0, len(pairs), block_pairs):
        part = pairs[low : low + block_pairs]
        out.append(_pack(np.diff(part, prepend=0), *(m[low : low + block_pairs] for m in more)))
    return out


def _pairs_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, n = _unpack(blob, 2)
    return np.cumsum(step), n


@dataclass
class Run:
    """Documents gathered by one task, up to a bounded number of characters."""

    tokenizers: Tokenizers
    with_groups: bool
    chars: int = 0

    def __post_init__(self):
        self.index: dict[str, int] = {}
        self.ids: list = []
        self.words: list[np.ndarray] = []  # of each document

    def add(self, doc_id, text: str | None) -> None:
        index, found = self.index, []
        if text:
            for some in self.tokenizers.words(text):
                found.append(np.array([index.setdefault(w, len(index)) for w in some], np.int64))
            self.chars += len(text)
        self.ids.append(doc_id)
        self.words.append(np.concatenate([np.empty(0, np.int64), *found]))

    def rows(self, run: int, radixes: int, block_pairs: int) -> Iterator[dict]:
        aligned = align_words(self.tokenizers, list(self.index))
        whole = [len(w) > 0 and bool(aligned.sound[w].all()) for w in self.words]
        words = [w if ok else w[:0] for w, ok in zip(self.words, whole)]

        # Pair-document records: each document's pairs with its number of links of each.
        used, local = np.unique(aligned.pairs, return_inverse=True)
        order = np.lexsort((used, (used >> 32) % radixes))
        place = np.empty(len(used), np.int64)
        place[order] = np.arange(len(used))
        local, used = place[local], used[order]
        doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
        key, n = np.unique(doc * max(1, len(self.index)) + np.concatenate([np.empty(0, np.int64), *words]), return_counts=True)
        doc, word = np.divmod(key, max(1, len(self.index)))
        links = np.diff(aligned.first)[word]
        record = np.repeat(doc, links) * max(1, len(used)) + local[_ranges(aligned.first[word], links)]
        sort = np.argsort(record)
        record, n = record[sort], np.repeat(n, links)[sort]
        begins = np.nonzero(np.diff(record, prepend=-1))[0]
        n = np.add.reduceat(n, begins) if len(begins) else n
        doc, pair = np.divmod(record[begins], max(1, len(used)))
        held = np.bincount(pair, minlength=len(used))

        # A word of a document that is not sound may have pairs that no document holds.
        keep = held > 0
        pair, used, held = (np.cumsum(keep) - 1)[pair], used[keep], held[keep]
        cuts = np.searchsorted((used >> 32) % radixes, np.arange(radixes + 1))
        for radix in np.nonzero(np.diff(cuts))[0].tolist():
            own = slice(cuts[radix], cuts[radix + 1])
            yield {"kind": "pairs", "run": run, "radix": radix, "blocks": _blocks(used[own], held[own], block_pairs=block_pairs)}
        bounds = np.searchsorted(doc, np.arange(len(words) + 1))
        for i, (own, ok) in enumerate(zip(words, whole)):
            groups = b";".join([aligned.groups[w] for w in own.tolist()])
            low, high = bounds[i], bounds[i + 1]
            yield {
                "kind": "documents",
                "run": run,
                "id": self.ids[i],
                "n_a": int(aligned.n_a[own].sum()),
                "n_b": int(aligned.n_b[own].sum()),
                "n_groups": int(aligned.n_groups[own].sum()),
                "n_links": int(n[low:high].sum()),
                "groups_sha256": hashlib.sha256(groups).hexdigest() if ok else "",
                "groups": groups.decode() if self.with_groups else None,
                "blocks": [_pack(np.diff(pair[low:high], prepend=0), n[low:high])],
            }


def _merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """Ascending stretches of pairs with their numbers of documents, and each run's own pairs
    of the stretch.

    The heap has the last pair of each run's open block. Up to the least of these, all pairs
    of all runs are in open blocks.
    """
    heap, open_, nexts = [], {}, [iter(r) for r in runs]

    def load(run: int) -> None:
        blob = next(nexts[run], None)
        if blob is None:
            open_.pop(run, None)
        else:
            open_[run] = _pairs_of(blob)
            heapq.heappush(heap, (int(open_[run][0][-1]), run))

    for run in range(len(runs)):
        load(run)
    while heap:
        bound = heap[0][0]
        parts = []
        for run, (pairs, n) in open_.items():
            cut = int(np.searchsorted(pairs, bound, side="right"))
            if cut:
                parts.append((run, pairs[:cut], n[:cut]))
                open_[run] = (pairs[cut:], n[cut:])
        while heap and heap[0][0] <= bound:
            load(heapq.heappop(heap)[1])
        keys, inverse = np.unique(np.concatenate([p for _, p, _ in parts]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, inverse, np.concatenate([n for _, _, n in parts]))
        yield keys, total, [(run, p) for run, p, _ in parts]


def _by_side(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """``_merged`` by whole first ids: pairs, counts, whether a count is its first id's highest,
    and each run's own pairs."""
    held: list = []

    def done(rows: list):
        keys, total = (np.concatenate(x) for x in list(zip(*rows))[:2])
        begins = np.nonzero(np.diff(keys >> 32, prepend=-1))[0]
        most = np.repeat(np.maximum.reduceat(total, begins), np.diff(np.append(begins, len(keys))))
        return keys, total, total == most, [x for _, _, parts in rows for x in parts]

    for keys, total, parts in _merged(runs):
        cut = int(np.searchsorted(keys, keys[-1] >> 32 << 32))
        if cut or held and held[-1][0][-1] >> 32 != keys[0] >> 32:
            # The last first id may go on; all before it are whole.
            split = [(run, np.searchsorted(p, keys[-1] >> 32 << 32), p) for run, p in parts]
            if cut:
                held.append((keys[:cut], total[:cut], [(run, p[:c]) for run, c, p in split if c]))
            yield done(held)
            held = []
            parts = [(run, p[c:]) for run, c, p in split if c < len(p)]
        held.append((keys[cut:], total[cut:], parts))
    if held:
        yield done(held)


def _streamed_back(stretches, n_runs: int) -> list[list[bytes]]:
    """Of each run: the counts of its pairs and whether they are the best, as blocks in its order."""
    out: list[list[bytes]] = [[] for _ in range(n_runs)]
    for keys, total, best, parts in stretches:
        for run, pairs in parts:
            at = np.searchsorted(keys, pairs)
            out[run].append(_pack(total[at], best[at]))
    return out


def _back(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [_unpack(b, 2) for b in blocks]
    return tuple(np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else ([], [])))


@dataclass
class Alignment:
    documents: DataFrame
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups if asked for."""
    pairs: DataFrame
    """a, b, n_docs, is_best: every linked id pair of the corpus."""


SEGMENTS = "radix int, run long, blocks array<binary>"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def align(
    docs: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
    radixes: int = RADIXES,
    fan_in: int = FAN_IN,
    chars_per_run: int = CHARS_PER_RUN,
    block_pairs: int = BLOCK_PAIRS,
) -> Alignment:
    """Align the tokens of a byte-level vocabulary (tokenizers) with those of a SentencePiece model.

    The files, of a few MB, are read by the driver and sent to every task.
    """
    with open(byte_level_path, "rb") as a, open(pieces_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    kind = docs.schema[id_col].dataType
    ids = to_arrow_type(kind)
    schema = (
        f"kind string, run long, radix int, id {kind.simpleString()}, {', '.join(f'{n} long' for n in NUMBERS)}, "
        "groups_sha256 string, groups string, blocks array<binary>"
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, run, number = Tokenizers(*files.value), None, TaskContext.get().partitionId() << 32
        arrow = pa.schema(
            [("kind", pa.string()), ("run", pa.int64()), ("radix", pa.int32()), ("id", ids), *((n, pa.int64()) for n in NUMBERS)]
            + [("groups_sha256", pa.string()), ("groups", pa.string()), ("blocks", pa.list_(pa.binary()))]
        )
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                run = run or Run(tokenizers, with_groups)
                run.add(doc_id.as_py(), text.as_py())
                if run.chars >= chars_per_run:
                    yield pa.RecordBatch.from_pylist(list(run.rows(number, radixes, block_pairs)), schema=arrow)
                    run, number = None, number + 1
        if run is not None:
            yield pa.RecordBatch.from_pylist(list(run.rows(number, radixes, block_pairs)), schema=arrow)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spilled = materialise(rows.mapInArrow(gather, schema), "alignment-runs", "kind")
    own = spilled.where("kind = 'documents'").drop("kind", "radix")

    # Merges of at most ``fan_in`` runs, until the last one has them all.
    levels, n_runs = [spilled.where("kind = 'pairs'").select("radix", "run", "blocks")], own.select("run").distinct().count()
    into: list[Column] = []
    while n_runs > fan_in:
        n_runs = -(-n_runs // max(2, fan_in // 2))  # hashing is uneven
        into.append(F.pmod(F.xxhash64("run"), F.lit(n_runs)))

        def merge(key, group: pd.DataFrame) -> pd.DataFrame:
            blocks = []
            for keys, total, _ in _merged([list(b) for b in group["blocks"]]):
                blocks += _blocks(keys, total, block_pairs=block_pairs)
            return pd.DataFrame({"radix": [key[0]], "run": [key[1]], "blocks": [blocks]})

        longer = levels[-1].withColumn("parent", into[-1]).groupBy("radix", "parent").applyInPandas(merge, SEGMENTS)
        levels.append(materialise(longer, "alignment-merge"))

    def last(key, group: pd.DataFrame) -> pd.DataFrame:
        runs = [list(b) for b in group["blocks"]]
        return group[["radix", "run"]].assign(blocks=_streamed_back(_by_side(runs), len(runs)))

    def hand_down(longer: pd.DataFrame, shorter: pd.DataFrame) -> pd.DataFrame:
        pairs = np.concatenate([_pairs_of(b)[0] for b in longer["blocks"].iloc[0]])
        total, best = _back(longer["back"].iloc[0])
        found = []
        for blocks in shorter["blocks"]:
            at = [np.searchsorted(pairs, _pairs_of(b)[0]) for b in blocks]
            found.append([_pack(total[x], best[x]) for x in at])
        return shorter[["radix", "run"]].assign(blocks=found)

    back = levels[-1].groupBy("radix").applyInPandas(last, SEGMENTS)
    for shorter, longer, parent in zip(levels[-2::-1], levels[:0:-1], into[::-1]):
        above = longer.join(back.withColumnRenamed("blocks", "back"), ["radix", "run"])
        members = shorter.withColumn("parent", parent)
        back = above.groupBy("radix", "run").cogroup(members.groupBy("radix", "parent")).applyInPandas(hand_down, SEGMENTS)

    names = ["id", *NUMBERS, "n_best", "count_sum", "groups_sha256", "groups"]
    out_schema = f"id {kind.simpleString()}, {', '.join(f'{n} long' for n in names[1:-2])}, groups_sha256 string, groups string"

    def finish(documents: pa.Table, counts: pa.Table) -> pa.Table:
        by_radix = sorted(zip(counts.column("radix").to_pylist(), counts.column("blocks").to_pylist()), key=lambda x: x[0])
        total, best = _back([b for _, blocks in by_radix for b in blocks])
        n_best, count_sum = [], []
        for (blob,) in documents.column("blocks").to_pylist():
            step, n = _unpack(blob, 2)
            pair = np.cumsum(step)
            n_best.append(int(n[best[pair] > 0].sum()))
            count_sum.append(int((n * total[pair]).sum()))
        found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([found[n] if n in found else documents.column(n) for n in names], names=names)

    documents = own.groupBy("run").cogroup(back.groupBy("run")).applyInArrow(finish, out_schema)

    def listed(key, group: pd.DataFrame) -> pd.DataFrame:
        found = [(k, t, b) for k, t, b, _ in _by_side([list(b) for b in group["blocks"]])]
        keys, total, best = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"a": keys >> 32, "b": keys & 0xFFFFFFFF, "n_docs": total, "is_best": best})

    pairs = levels[-1].groupBy("radix").applyInPandas(listed, "a int, b int, n_docs long, is_best boolean")
    return Alignment(documents if with_groups else documents.drop("groups"), pairs)
