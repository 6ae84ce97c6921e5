"""Unigram token counts by dynamic programming over a trie of pre-tokens.

A text is cut at white space; each word, with the mark for a word's start before it,
is a pre-token. Its token count is that of its best segmentation into vocabulary
pieces, by the sum of the pieces' log probabilities. Pre-tokens repeat and share
prefixes, so a task keeps them in a trie: the forward score of a prefix is computed
once, when its node is made, and a pre-token's count is read at its last node.

Texts are independent, so there is no shuffle. The trie of a task has at most
``max_nodes`` nodes; a full one is begun anew, which costs time and changes nothing. A word of
over ``longest_word`` characters, which hardly ever repeats, is not put into the trie: its forward
scores go through a window as long as the longest piece.

* A null or empty text has no words and no tokens; repeated rows are counted each.
* A character that no piece covers costs its UTF-8 bytes, as with byte fallback.
* Of equal scores the segmentation with fewer tokens counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from tsmedallion.llm.common import strings

WORD_START = "▁"
MAX_PIECES = 1_000_000
MAX_NODES = 1_000_000
LONGEST_WORD = 1_000
UNKNOWN_BELOW = 10.0  # an unknown character scores so far below the rarest piece


def load_pieces(path: str, max_pieces: int = MAX_PIECES) -> dict[str, float]:
    """Pieces of a SentencePiece file with unigram log probabilities.

    The file's own scores only order its pieces, so that the probability of the piece
    with rank r is taken by Zipf's law as proportional to 1 / (r + 1). The vocabulary
    is sent to every task; one of more than ``max_pieces`` is refused.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > max_pieces:
        raise ValueError(f"{path} has over {max_pieces} pieces")
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 1) for r in range(len(ids))))
    return {model.id_to_piece(i): -math.log(r + 1) - total for r, i in enumerate(ids)}


class ForwardTrie:
    """Pre-tokens, with the best score and its token count at every prefix."""

    def __init__(self, pieces: Mapping[str, float], max_nodes: int = MAX_NODES, longest_word: int = LONGEST_WORD):
        self.max_nodes, self.longest_word = max_nodes, min(longest_word, max_nodes)
        self.longest_piece = max(map(len, pieces), default=1)
        # Every end of a piece, with its score if it is a piece itself: a search for the
        # pieces that end at a place stops at the first end that none has.
        self.ends: dict[str, float | None] = {p[i:]: None for p in pieces for i in range(len(p))}
        self.ends.update(pieces)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_BELOW
        self._clear()

    def _clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of ``word``, inserted at its first occurrence."""
        if (found := self.terminal.get(word)) is not None:
            return found
        if len(word) >= self.longest_word:
            return self._count_long(word)
        if len(self.score) + len(word) > self.max_nodes:
            self._clear()
        path = [0]
        for end, char in enumerate(word, 1):
            edge = (path[-1], char)
            node = self.child.get(edge)
            if node is None:
                node = self.child[edge] = self._forward(word, end, path)
            path.append(node)
        self.terminal[word] = tokens = self.tokens[path[-1]]
        return tokens

    def _count_long(self, word: str) -> int:
        """The same for a word that is not kept, with the last prefixes' scores alone."""
        keep = self.longest_piece + 1
        score, tokens = [0.0] * keep, [0] * keep  # of the prefix of n characters, at n % keep
        for end in range(1, len(word) + 1):
            best = score[(end - 1) % keep] + self.unknown
            n = tokens[(end - 1) % keep] + len(word[end - 1].encode())
            for start in range(end - 1, -1, -1):
                part = word[start:end]
                if part not in self.ends:
                    break
                piece = self.ends[part]
                if piece is not None:
                    own, count = score[start % keep] + piece, tokens[start % keep] + 1
                    if own > best or own == best and count < n:
                        best, n = own, count
            score[end % keep], tokens[end % keep] = best, n
        return tokens[len(word) % keep]

    def _forward(self, word: str, end: int, path: list[int]) -> int:
        """A node for ``word[:end]``; ``path`` has the nodes of its shorter prefixes."""
        before = path[end - 1]
        best = self.score[before] + self.unknown
        tokens = self.tokens[before] + len(word[end - 1].encode())
        for start in range(end - 1, -1, -1):
            part = word[start:end]
            if part not in self.ends:
                break
            piece = self.ends[part]
            if piece is not None:
                score, n = self.score[path[start]] + piece, self.tokens[path[start]] + 1
                if score > best or score == best and n < tokens:
                    best, tokens = score, n
        self.score.append(best)
        self.tokens.append(tokens)
        return len(self.score) - 1


def token_counts(
    docs: DataFrame,
    pieces: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_bytes and n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ForwardTrie(shared.value, max_nodes)
        for batch in batches:
            words, sizes, tokens = [], [], []
            for text in strings(batch.column(1)):
                found = Counter(text.split())
                words.append(found.total())
                sizes.append(len(text.encode()))
                tokens.append(sum(n * trie.count(WORD_START + w) for w, n in found.items()))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, sizes, tokens))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_words long, n_bytes long, n_tokens long"
    )
