from __future__ import annotations

import random

import numpy as np

from tsmedallion.llm import decontaminate as dc
from tsmedallion.llm.queries import op9_decontamination


def sellers(pattern: bytes, text: bytes) -> int:
    """Fewest edits between the whole pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def plain(docs, items):
    out = {}
    for i, text in docs:
        form = dc.normal((text or "").encode())
        for item, bench in items:
            cut = set(dc.windows(dc.normal(bench.encode()))) if bench else set()
            n = sum(sellers(w, form) <= dc.budget(len(w)) for w in cut)
            if n:
                out[i, item] = n
    return out


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("qxz")
        elif kind == 1:
            out.insert(at, rng.choice("qxz"))
        else:
            del out[at]
    return "".join(out)


def prose(rng, n):
    return " ".join(rng.choice(["the", "tion", "ing", "en", "der", "was", "thble", "ea"]) + rng.choice(["", "s", "th", "ed"]) for _ in range(n))


def test_query_against_alignment_of_every_window(spark, write_tables):
    rng = random.Random(10)
    items = [(i, prose(rng, rng.choice([3, 8, 14, 20, 40]))) for i in range(12)]
    docs = []
    for i in range(60):
        item = items[i % len(items)][1]
        part = item if i % 3 else item[: max(30, len(item) // 2)]
        docs.append((i, prose(rng, 15) + " " + edited(rng, part, i % 9).upper() + ", " + prose(rng, 15)))
    docs += [(100 + i, prose(rng, 60)) for i in range(20)]
    docs += [(200, items[3][1]), (201, None), (202, ""), (203, (items[4][1] + "! ") * 5)]
    sf = write_tables(documents=[(i, t, "en", "s", 1) for i, t in docs], benchmark=[*items, (50, items[3][1]), (51, None), (52, "short")])
    found = {(r.doc_id, r.item_id): r.windows for r in op9_decontamination(spark, sf).collect()}
    want = plain(docs, [*items, (50, items[3][1])])
    assert set(found) == set(want) and len(want) > 40
    assert all(found[k] >= n for k, n in want.items())  # equal windows of one item count each


def test_windows_at_the_edit_budget_are_found_and_beyond_it_not():
    rng = random.Random(11)
    item = prose(rng, 40).encode()[: dc.WINDOW]
    index = dc._index([(1, dc.normal(item))])
    for edits in range(0, 9):
        for _ in range(30):
            text = dc.normal((prose(rng, 10) + " " + edited(rng, item.decode(), edits) + " " + prose(rng, 10)).encode())
            found = [{}]
            dc._collect(index, [text], found)
            assert bool(found[0]) == (sellers(index.texts[0], text) <= dc.budget(len(index.texts[0])))


def test_windows_of_every_length_keep_their_whole_budget():
    rng = random.Random(12)
    for size in range(dc.LEAST_CHARS, dc.WINDOW + 1):
        pool = prose(rng, 40).replace(" ", "")
        item, edits = pool[:size].encode(), dc.budget(size)
        index = dc._index([(1, item)])
        even = list(item)
        for k in range(edits):  # one edit in the middle of each of edits + 1 equal parts' ends
            even[(k + 1) * size // (edits + 1)] = ord("z")
        text = b"qq " + bytes(even) + b" qq"
        found = [{}]
        dc._collect(index, [text], found)
        assert found[0], size


def test_a_bound_on_hits_at_once_changes_nothing(monkeypatch):
    rng = random.Random(13)
    phrase = "which of the following statements is true "
    items = [(i, dc.normal((phrase + prose(rng, 9)).encode())) for i in range(30)]
    texts = [dc.normal((prose(rng, 5) + " " + edited(rng, items[i][1].decode(), i % 4) + phrase * (i % 3)).encode()) for i in range(30)]

    def search():
        found = [{} for _ in texts]
        dc._collect(dc._index(items), texts, found)
        return found

    want = search()
    assert sum(map(bool, want)) > 15
    for most in (1, 7, 500):
        monkeypatch.setattr(dc, "HITS_AT_ONCE", most)
        assert search() == want


def test_blocks_of_items_change_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    one = dc.mark_leaks(docs, bench).select("doc_id", "leaks").collect()
    many = dc.mark_leaks(docs, bench, block_chars=700).select("doc_id", "leaks").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    passes = dc.mark_leaks(docs, bench, block_chars=2000, blocks_per_pass=3).select("doc_id", "leaks").collect()
    assert sorted(map(str, one)) == sorted(map(str, passes)) and any(r.leaks for r in one)


def test_rows_of_one_item_count_alike_in_one_block_and_in_several(spark):
    first, second = ("alpha bravo charlie delta echo foxtrot golf hotel " * 2, "india juliett kilo lima mike november oscar papa " * 2)
    docs = spark.createDataFrame([(1, first + second), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, first), (7, second)], "item_id long, text string").coalesce(1)
    marks = [dc.mark_leaks(docs, bench, block_chars=n, blocks_per_pass=p).collect() for n, p in ((10_000, 8), (10, 8), (10, 1))]
    assert marks[0] == marks[1] == marks[2]
    assert [len(r.leaks) for r in sorted(marks[0])] == [1, 0]



def test_documents_that_have_a_whole_item_are_found_and_no_others(spark):
    sf = "/root/testdata/sf0.1"
    items = [dc.normal(r.text.encode()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r.doc_id: dc.normal(r.text.encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {i for i, t in docs.items() if any(x in t for x in items)}
    found = {r.doc_id for r in op9_decontamination(spark, sf).collect()}
    assert want <= found and len(found - want) <= 0.1 * len(want)


def test_gram_hashes_tell_all_grams_of_a_text_apart():
    text = np.frombuffer(prose(random.Random(1), 3000).encode(), np.uint8)
    grams = {bytes(text[i : i + dc.Q]) for i in range(len(text) - dc.Q + 1)}
    assert len(set(dc.gram_hashes(text).tolist())) == len(grams)


def letters(rng, n):
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(n)).encode()


def test_passages_cut_at_any_place_are_found():
    rng = random.Random(14)
    for size in (65, 95, 300, 2 * dc.PIECE + 200):
        item = letters(rng, size)
        index = dc._index([(1, item)])
        places = [*range(min(40, size - dc.WINDOW + 1)), *(rng.randrange(size - dc.WINDOW + 1) for _ in range(40))]
        places += [dc.PIECE + k for k in range(-66, 3) if dc.PIECE + k + dc.WINDOW <= size]
        texts = []
        for at in places:
            whole = bytearray(item[at : at + dc.WINDOW])
            for k in rng.sample(range(dc.WINDOW), dc.budget(dc.WINDOW)):
                whole[k] = ord("z")
            short = item[at : at + dc.WINDOW - dc.budget(dc.WINDOW)]
            texts += [b"qrs tuv " * 9 + bytes(x) + b" wxy zqr" * 9 for x in (whole, short, item[at : at + dc.WINDOW])]
        found = [{} for _ in texts]
        dc._collect(index, texts, found)
        assert all(1 in f for f in found), size
        assert all(f[1][1] == 0 for f in found[2::3])


def test_places_found_and_fewest_edits_against_alignment_of_each_place(monkeypatch):
    rng = random.Random(15)
    item = letters(rng, 50) + b" which of these is so " * 3 + letters(rng, 50)
    texts = [letters(rng, 20) + edited(rng, item[a : a + 75].decode(), n).encode() + letters(rng, 20) for n in range(9) for a in (3, 40, 77)]
    want = []
    for text in texts:
        edits = [sellers(w, text) for w in dc.windows(item)]
        good = [n for n in edits if n <= dc.budget(dc.WINDOW)]
        want.append((len(good), min(good, default=None)))
    assert sum(n == 0 for n, _ in want) > 3 and sum(n > 0 for n, _ in want) > 9
    for most in (dc.HITS_AT_ONCE, 3):
        monkeypatch.setattr(dc, "HITS_AT_ONCE", most)
        monkeypatch.setattr(dc, "PIECE", 32 if most == 3 else dc.PIECE)
        found = [{} for _ in texts]
        dc._collect(dc._index([(1, item)]), texts, found)
        # Pieces overlap in characters, not in windows, so their windows are told apart by place.
        assert [(len(f[1][0]), f[1][1]) if f else (0, None) for f in found] == want
