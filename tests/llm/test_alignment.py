"""Token alignment against whole-text encoding and a plain count over all documents."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from tsmedallion.llm import alignment
from tsmedallion.llm.queries import BYTE_LEVEL, REGISTRY, VOCABULARY

ODD = [
    "a", " ", "  ", " a", "a ", "a  b", "a \n b\t c", "x  y  z", "▁x y▁ z", "a▁ b", "▁", "é ́x",
    "<0x41> <s> </s> <unk> <|endoftext|> it's we'll", "\x00 b \x1c c \x85 d", "ﬁ ① 中文 日本語", "\U0001f600 \U0001f468‍\U0001f469 ok",
    "def f(x):\n    return x  # twice\n", "the the the the", "café naïve über", "a b", "a b", "1 22 333 4444", "word " * 50 + "end", None, "",
]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(open(BYTE_LEVEL, "rb").read(), open(VOCABULARY, "rb").read())


def by_hand(tokenizers, rows):
    """Each row's answer, from whole texts and one pair after the other."""
    docs, holders = [], Counter()
    for doc_id, text in rows:
        spans = []
        if text:
            for ids, table in (
                (tokenizers.a.encode(" " + text, add_special_tokens=False).ids, tokenizers.a_bytes),
                (tokenizers.b.encode(text), tokenizers.b_bytes),
            ):
                end, own = 0, []
                for i in ids:
                    own.append((end, end := end + len(table[i]), i))
                spans.append(own if b"".join(table[i] for i in ids) == (" " + text).encode() else None)
        if not text or None in spans:
            docs.append((doc_id, None, []))
            continue
        a, b = spans
        links = [(i, k) for s, e, i in a for u, v, k in b if s < v and u < e] if len(a) < 400 else None
        if links is None:
            links, j = [], 0
            for s, e, i in a:
                while b[j][1] <= s:
                    j += 1
                k = j
                while k < len(b) and b[k][0] < e:
                    links.append((i, b[k][2]))
                    k += 1
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, start = [], 0
        at = defaultdict(lambda: ([], []))
        cut = iter(ends)
        for side, own in enumerate(spans):
            g = 0
            for _, e, i in own:
                at[g][side].append(i)
                g += e == ends[g]
        groups = ";".join(",".join(map(str, at[g][0])) + "|" + ",".join(map(str, at[g][1])) for g in range(len(ends)))
        docs.append((doc_id, (len(a), len(b), len(ends), len(links), groups), links))
        holders.update(set(links))
    most = Counter()
    for (i, _), n in holders.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, found, links in docs:
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        *numbers, groups = found
        best = sum(holders[x] == most[x[0]] for x in links)
        out.append((doc_id, *numbers, best, sum(holders[x] for x in links), hashlib.sha256(groups.encode()).hexdigest()))
    return out, holders, most


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def answer(df, id_col="id"):
    return sorted(((r[id_col], *(r[c] for c in COLUMNS)) for r in df.collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_odd_texts_and_merges_of_many_runs(spark, tokenizers, small):
    rows = list(enumerate(ODD)) + [(None, "no id at all"), (3, " a"), (None, None)]
    more = {"chars_per_run": 20, "fan_in": 4, "block_pairs": 2, "radixes": 4} if small else {}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = alignment.align(docs, BYTE_LEVEL, VOCABULARY, **more)
    wanted, holders, most = by_hand(tokenizers, rows)
    assert answer(found.documents) == sorted(wanted, key=str)
    pairs = {(r.a, r.b): (r.n_docs, r.is_best) for r in found.pairs.collect()}
    assert pairs == {x: (n, n == most[x[0]]) for x, n in holders.items()}


def test_query_matches_whole_texts(spark, tokenizers):
    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    wanted, _, _ = by_hand(tokenizers, zip(*(c.to_pylist() for c in table.columns)))
    assert answer(REGISTRY["op13_token_alignment"](spark, folder), "doc_id") == sorted(wanted, key=str)


def test_groups_are_given_on_request(spark):
    docs = spark.createDataFrame([(1, "unbelievable things")], "doc_id long, text string")
    (row,) = alignment.align(docs, BYTE_LEVEL, VOCABULARY, with_groups=True).documents.collect()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") == row.n_groups - 1


def test_long_texts_are_cut_without_a_trace(tokenizers, monkeypatch):
    text = " ".join(f"word{i % 97} of\nthe  text" for i in range(3_000))
    whole = [w for some in tokenizers.words(text) for w in some]
    monkeypatch.setattr(alignment, "CHARS_AT_ONCE", 500)
    parts = list(tokenizers.words(text))
    assert len(parts) > 50 and [w for some in parts for w in some] == whole


def test_merge_keeps_maxima_over_block_bounds():
    import numpy as np

    rng = np.random.default_rng(5)
    runs, total = [], Counter()
    for _ in range(7):
        keys = np.unique(rng.integers(0, 6, 40) << 32 | rng.integers(0, 30, 40))
        n = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), n.tolist())))
        runs.append(alignment._blocks(keys, n, block_pairs=3))
    most = Counter()
    for k, n in total.items():
        most[k >> 32] = max(most[k >> 32], n)
    found = {}
    for keys, counts, best, _ in alignment._by_side(runs):
        assert not set(keys.tolist()) & set(found)
        found |= {k: (c, b) for k, c, b in zip(keys.tolist(), counts.tolist(), best.tolist())}
    assert found == {k: (n, n == most[k >> 32]) for k, n in total.items()}
    back = alignment._streamed_back(alignment._by_side(runs), len(runs))
    for blocks, given in zip(runs, back):
        keys = np.concatenate([alignment._pairs_of(b)[0] for b in blocks])
        counts, best = alignment._back(given)
        assert counts.tolist() == [total[k] for k in keys.tolist()]
        assert best.tolist() == [int(total[k] == most[k >> 32]) for k in keys.tolist()]
