from __future__ import annotations

import itertools
import random

from tokenizers import Tokenizer, models, pre_tokenizers

from tsmedallion.llm.queries import VOCABULARY
from tsmedallion.llm.token_counts import UNKNOWN_BELOW, WORD_START, ForwardTrie, load_pieces, token_counts


def brute(word: str, pieces: dict[str, float]) -> int:
    """Over all ways to cut the word."""
    unknown = min(pieces.values()) - UNKNOWN_BELOW
    best = None
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        score = tokens = 0
        for a, b in zip(at, at[1:]):
            part = word[a:b]
            if part in pieces:
                score, tokens = score + pieces[part], tokens + 1
            elif b - a == 1:
                score, tokens = score + unknown, tokens + len(part.encode())
            else:
                break
        else:
            if best is None or (-score, tokens) < best:
                best = (-score, tokens)
    return best[1]


def test_counts_are_those_of_the_best_of_all_segmentations():
    rng = random.Random(3)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 3))): rng.uniform(-9, -1) for _ in range(25)}
    pieces.pop("b", None)  # a character that no piece covers by itself
    trie = ForwardTrie(pieces)
    for _ in range(300):
        word = "".join(rng.choices("abcé", k=rng.randint(1, 9)))
        assert trie.count(word) == brute(word, pieces)


def test_a_full_trie_is_begun_anew_without_changing_counts():
    pieces = {"a": -1.0, "ab": -1.5, "b": -2.0}
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("ab", repeat=n)]
    small, large = ForwardTrie(pieces, max_nodes=10), ForwardTrie(pieces)
    assert [small.count(w) for w in words] == [large.count(w) for w in words]


def test_long_words_are_counted_without_the_trie():
    rng = random.Random(8)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.uniform(-9, -1) for _ in range(40)}
    window, trie = ForwardTrie(pieces, longest_word=1), ForwardTrie(pieces)
    for _ in range(200):
        word = "".join(rng.choices("abcé", k=rng.randint(1, 60)))
        assert window.count(word) == trie.count(word)
    assert len(window.score) == 1 and not window.terminal
    assert window.count("ab" * 100_000) > 0  # a word of any length, in the memory of its longest piece


def test_prefixes_are_scored_once():
    trie = ForwardTrie({"a": -1.0, "b": -1.0})
    trie.count("aaaa")
    trie.count("aaab")
    trie.count("aaa")
    assert len(trie.score) == 1 + 4 + 1


def test_agrees_with_a_unigram_tokenizer(spark):
    pieces = load_pieces(VOCABULARY)
    other = Tokenizer(models.Unigram([*pieces.items(), ("<unk>", 0.0)], unk_id=len(pieces)))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in token_counts(docs, pieces).collect()}
    known = lambda t: all(c in pieces for c in set("".join(t.split())))
    checked = 0
    for i, text in texts.items():
        words = text.split()
        assert found[i].n_words == len(words) and found[i].n_bytes == len(text.encode())
        if known(text):
            checked += 1
            marked = " ".join(WORD_START + w for w in words)
            assert found[i].n_tokens == len(other.encode(marked).ids)
    assert checked > len(texts) / 2
