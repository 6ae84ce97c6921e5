"""Chat formatting of conversations as prefix trees, packed into training sequences.

A turn is written as ``### role: text</turn>`` and a line break. Control strings inside a
role or text are broken by escapes that can be taken back: a backslash is doubled, and
the first character of ``###`` and ``</turn>`` gets a name (``\\h``, ``\\l``; in a role
also ``\\c`` for a colon), so the marks stand nowhere else.

Conversations that share their first turns share a path of a prefix tree. Sorted by the
hashes of their turns, they come in the order of a depth-first walk, so one pass over
sorted rows emits the tree: a turn that the path of the conversation before has is not
emitted again. What is emitted is one row a turn:

* ``tokens``, and ``first``, their place in the sequence ``pack``;
* ``position``, the position id of the first token, which counts along the path;
* ``attends``, the intervals of the sequence that hold the turn's ancestors: its tokens see these
  and what precedes them in the turn itself;
* ``loss_first``, ``loss_end``: the places under the loss mask, the text of a trained role.

A row with ``closes`` ends each conversation; its ``attends`` is the conversation's whole path.

A pack is closed at the first conversation that finds it filled (``pack_tokens``), and what the next
pack shares with it is emitted there anew, as a sequence sees no other. So a tree
of any size spreads over packs, and a range exchange on the paths over tasks; a first turn of a third
of all conversations, or as many copies of one, are split like any others. Turns stream: no
conversation is held, only the path's first ``depth`` turns and the token places of its ends.
Turns behind these are not merged. One conversation is one sequence and so stays in one task.

* A null role or text is empty. Rows without a conversation id are one conversation.
* Turns go by number, nulls first; rows of one number by role, then by a hash. A repeated row is a turn.
* A long text is tokenized by slices. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tsmedallion.session import materialise

OPEN, NAMED, CLOSE = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"
PACK_TOKENS = 32_768
DEPTH = 128
CHARS_AT_ONCE = 1 << 16

_TEXT_ESCAPE = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ROLE_ESCAPE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_NAMES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
_CHARACTERS = {v[1]: k for k, v in _NAMES.items()}
_WORD_START = re.compile(r"(?<=\S) (?=\S)")

# Fixed value: how a byte-level vocabulary cuts text before it merges.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def escape(text: str) -> str:
    return _TEXT_ESCAPE.sub(lambda m: _NAMES[m[0]], text)


def escape_role(role: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: _NAMES[m[0]], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _CHARACTERS[m[1]], text)


def read_turn(text: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, mark, rest = text.removeprefix(OPEN).partition(NAMED)
    if not (text.startswith(OPEN) and mark and rest.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    return unescape(role), unescape(rest.removesuffix(CLOSE))


class Codec:
    """Text to tokens and back, by a file of base64 tokens and ranks."""

    def __init__(self, file: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines())}
        self.encoding = tiktoken.Encoding("chat", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.heads: dict[str, list[int]] = {}
        self.close = self.encode(CLOSE)

    def encode(self, text: str) -> list[int]:
        """By slices that begin at a word where there is one, else anywhere."""
        out, start = [], 0
        while len(text) - start > 2 * CHARS_AT_ONCE:
            cut = _WORD_START.search(text, start + CHARS_AT_ONCE, start + 2 * CHARS_AT_ONCE)
            end = cut.start() if cut else start + CHARS_AT_ONCE
            out += self.encoding.encode_ordinary(text[start:end])
            start = end
        return out + self.encoding.encode_ordinary(text[start:] if start else text)

    def head(self, role: str) -> list[int]:
        found = self.heads.get(role)
        if found is None:
            if len(self.heads) > 10_000:
                self.heads.clear()
            found = self.heads[role] = self.encode(OPEN + escape_role(role) + NAMED)
        return found

    def decode(self, tokens: list[int]) -> str:
        return self.encoding.decode_bytes(tokens).decode()


@dataclass
class Node:
    digest: str
    first: int  # place of its tokens in the pack
    end: int
    position: int  # position id behind its last token


def _joined(spans: list[tuple[int, int]], first: int, end: int) -> list[tuple[int, int]]:
    if spans and spans[-1][1] == first:
        return [*spans[:-1], (spans[-1][0], end)]
    return [*spans, (first, end)]


@dataclass
class Packer:
    """Emits the turns of sorted conversations; holds one path."""

    codec: Codec
    pack: int
    pack_tokens: int
    depth: int
    trained_role: str
    size: int = 0
    seq: int = 0
    path: list[Node] = field(default_factory=list)
    place: int = 0  # turns of the conversation so far
    shared: bool = True  # whether all of them were on the path
    position: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def begin(self) -> None:
        if self.size >= self.pack_tokens:
            self.pack, self.size, self.seq, self.path = self.pack + 1, 0, 0, []
        self.place, self.shared, self.position, self.spans = 0, True, 0, []

    def turn(self, conv_id, role: str, text: str, digest: str) -> dict | None:
        i, self.place = self.place, self.place + 1
        if self.shared and i < len(self.path) and self.path[i].digest == digest:
            node = self.path[i]
            self.position, self.spans = node.position, _joined(self.spans, node.first, node.end)
            return None
        if self.shared:
            self.shared = False
            del self.path[i:]
        head, body = self.codec.head(role), self.codec.encode(escape(text))
        tokens = head + body + self.codec.close
        trained = role == self.trained_role
        first, end = self.size, self.size + len(tokens)
        row = self._row(conv_id, first=first, tokens=tokens, closes=False)
        if trained:
            row |= {"loss_first": first + len(head), "loss_end": first + len(head) + len(body)}
        self.size, self.position = end, self.position + len(tokens)
        self.spans = _joined(self.spans, first, end)
        if i < self.depth:
            self.path.append(Node(digest, first, end, self.position))
        return row

    def close(self, conv_id) -> dict:
        return self._row(conv_id, first=None, tokens=[], closes=True)

    def _row(self, conv_id, **more) -> dict:
        self.seq += 1
        row = {"pack": self.pack, "seq": self.seq, "conv_id": conv_id, "position": self.position, "attends": self.spans}
        return row | {"loss_first": None, "loss_end": None} | more


def pack_conversations(
    turns: DataFrame,
    vocabulary_path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    pack_tokens: int = PACK_TOKENS,
    depth: int = DEPTH,
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """The packs, a row for each turn emitted and for each conversation closed, by (pack, seq).

    The vocabulary file, of a MB, is read by the driver and sent to every task.
    """
    with open(vocabulary_path, "rb") as f:
        file = turns.sparkSession.sparkContext.broadcast(f.read())
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")
    ).withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))

    # The first turns of each conversation, as numbers to sort by; cut down before the shuffle.
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    by_turn = Window.partitionBy("conv_id").orderBy(*order)
    step = F.struct("place", F.xxhash64("digest").alias("step"))
    paths = (
        rows.select("conv_id", "turn", "role", "digest")
        .withColumn("place", F.row_number().over(by_turn))
        .where(F.col("place") <= depth)
        .groupBy(F.col("conv_id").alias("path_of"))
        .agg(F.transform(F.array_sort(F.collect_list(step)), lambda s: s.step).alias("path"))
    )
    sorted_ = (
        rows.join(paths, F.col("conv_id").eqNullSafe(F.col("path_of")))
        .repartitionByRange("path", "conv_id")
        .sortWithinPartitions("path", "conv_id", *order)
        .select("conv_id", "role", "text", "digest")
    )
    kind = turns.schema[conv_col].dataType
    ids = to_arrow_type(kind)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        schema = pa.schema(
            [("pack", pa.int64()), ("seq", pa.int64()), ("conv_id", ids), ("closes", pa.bool_()), ("first", pa.int64())]
            + [("position", pa.int64()), ("attends", span), ("tokens", pa.list_(pa.int32()))]
            + [("loss_first", pa.int64()), ("loss_end", pa.int64())]
        )

        def table(rows: list[dict]) -> pa.RecordBatch:
            found = {c: pa.array([r[c] for r in rows], schema.field(c).type) for c in schema.names if c not in ("attends", "tokens")}
            ends = np.array([b for r in rows for b in r["attends"]], np.int64).reshape(-1, 2)
            parts = pa.StructArray.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["first", "end"])
            flat = np.concatenate([np.empty(0, np.int32), *(np.array(r["tokens"], np.int32) for r in rows)])
            for name, values in (("attends", parts), ("tokens", pa.array(flat))):
                offsets = np.concatenate([[0], np.cumsum([len(r[name]) for r in rows], dtype=np.int64)])
                found[name] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            return pa.RecordBatch.from_arrays([found[c] for c in schema.names], names=schema.names)

        packer = Packer(Codec(file.value), TaskContext.get().partitionId() << 32, pack_tokens, depth, trained_role)
        open_, last = False, None
        for batch in batches:
            out = []
            for conv_id, role, text, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or conv_id != last:
                    if open_:
                        out.append(packer.close(last))
                    packer.begin()
                    open_, last = True, conv_id
                row = packer.turn(conv_id, role, text, digest)
                if row is not None:
                    out.append(row)
            yield table(out)
        if open_:
            yield table([packer.close(last)])

    span = "array<struct<first: long, end: long>>"
    packs = sorted_.mapInArrow(
        emit,
        f"pack long, seq long, conv_id {kind.simpleString()}, closes boolean, first long, position long, "
        f"attends {span}, tokens array<int>, loss_first long, loss_end long",
    )
    return materialise(packs, "chat-packs")


@dataclass
class Read:
    """What is known at the end of a turn of the current path."""

    position: int = 0
    n_turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def then(self, turn: str, loss: str, n_tokens: int) -> Read:
        role, text = read_turn(turn)
        turns, masked = self.turns.copy(), self.loss.copy()
        turns.update(f"{role}\n{text}\n".encode())
        masked.update(loss.encode())
        return Read(self.position + n_tokens, self.n_turns + 1, self.chars + len(turn), self.loss_chars + len(loss), turns, masked)


def read_back(packs: DataFrame, vocabulary_path: str, depth: int = DEPTH) -> DataFrame:
    """Each conversation as its pack has it, with digests of its turns and of what is under the loss mask.

    A pack's rows stream in order. A turn goes on from the turn of the path that ends at its
    position; what it attends must be that path's tokens.
    """
    with open(vocabulary_path, "rb") as f:
        file = packs.sparkSession.sparkContext.broadcast(f.read())
    kind = packs.schema["conv_id"].dataType
    ids = to_arrow_type(kind)
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, pack, path = Codec(file.value), None, [Read()]
        for batch in batches:
            out = []
            tokens, spans = batch.column("tokens"), batch.column("attends")
            token_at, span_at = tokens.offsets.to_pylist(), spans.offsets.to_numpy()
            tokens, spans = tokens.values.to_numpy(), spans.values
            lengths = np.concatenate([[0], np.cumsum(spans.field("end").to_numpy() - spans.field("first").to_numpy())])
            attended = (lengths[span_at[1:]] - lengths[span_at[:-1]]).tolist()
            plain = ("pack", "seq", "conv_id", "closes", "first", "position", "loss_first", "loss_end")
            rows = zip(*(batch.column(c).to_pylist() for c in plain), attended, token_at, token_at[1:])
            for own, seq, conv_id, closes, first, position, loss_first, loss_end, n_attended, low, high in rows:
                if own != pack:
                    pack, path = own, [Read()]
                at = next((i for i in range(len(path) - 1, -1, -1) if path[i].position == position), None)
                if at is None or n_attended != position:
                    raise ValueError(f"pack {pack} has no path to row {seq}")
                if closes:
                    end = path[at]
                    out.append((conv_id, end.n_turns, end.turns.hexdigest(), end.loss_chars, end.loss.hexdigest(), end.chars))
                    continue
                turn, loss = tokens[low:high].tolist(), ""
                if loss_first is not None:
                    loss = unescape(codec.decode(turn[loss_first - first : loss_end - first]))
                after = path[at].then(codec.decode(turn), loss, len(turn))
                # Behind the turns that can be shared, only the last one is gone on from.
                path[min(at, depth) + 1 :] = [after]
            kinds = (ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", *names])

    rows = packs.select("pack", "seq", "conv_id", "closes", "first", "position", "attends", "tokens", "loss_first", "loss_end")
    schema = f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.repartition("pack").sortWithinPartitions("pack", "seq").mapInArrow(read, schema)
