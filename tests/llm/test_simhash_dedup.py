from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from tsmedallion.llm import simhash_dedup as sh
from tsmedallion.llm.queries import op4_simhash_dedup


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_roots(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_every_word_decodes_to_a_codeword_within_three_bits():
    words = np.random.default_rng(1).integers(0, 1 << 23, 20_000)
    index = sh.golay_index(words)
    code = (np.arange(4096) << 11) | sh.UPPER
    assert max(int(x).bit_count() for x in words ^ code[index]) == 3
    assert min(int(c).bit_count() for c in code[1:]) == 7
    rows, _ = sh.golay_keys(words)
    assert set(np.bincount(rows)) == {1, 6}


def test_fingerprints_within_four_bits_share_a_key():
    rng = random.Random(2)
    pairs = []
    for _ in range(4000):
        x = rng.getrandbits(64)
        pairs.append((x, x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))))
    keys = []
    for side in zip(*pairs):
        rows, found = sh.fuzzy_keys(np.array(side, np.uint64))
        own = [set() for _ in pairs]
        for r, k in zip(rows, found):
            own[r].add(int(k))
        keys.append(own)
    assert all(a & b for a, b in zip(*keys))


def test_components_of_clustered_fingerprints(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(400):  # chains, stars and loners
        base = rng.choice(prints)
        prints.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 4, 9]))))
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64)
    frame = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    rows = {r.fp: r.root for r in sh.link_components(frame).collect()}
    assert len(rows) == len(prints)
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == y) for y in set(labels)}
    assert groups([rows[int(x)] for x in signed]) == groups(plain_roots(prints))


def test_query_against_all_pairs(spark, write_tables):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    texts = [" ".join(word() for _ in range(rng.choice([1, 3, 4, 60, 200]))) for _ in range(40)]
    for _ in range(60):
        words = rng.choice(texts[:40]).split(" ")
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [texts[0]] * 30 + [None, "", " \n", "Ä ö x \u001c y", texts[3].upper()]
    ids = list(range(100, 100 + len(texts)))
    sf = write_tables(documents=[(i, t, "en", "s", 1) for i, t in zip(ids, texts)])
    prints = [plain_fingerprint(t) for t in texts]
    roots = plain_roots(prints)
    want = {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash_dedup(spark, sf).collect()} == want
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = sh.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({ids[r] for r in roots})


def test_query_over_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    want = {r.doc_id: (f"{p:016x}", docs[k].doc_id) for r, p, k in zip(docs, prints, plain_roots(prints))}
    found = op4_simhash_dedup(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == want


def test_rows_of_one_id_are_one_document_each(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (None, "q r s t u v", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id_key string")
    assert sorted(map(str, sh.one_of_each(docs).collect())) == sorted(
        ["Row(doc_id=1, text='a b c d e f', id_key='x')", "Row(doc_id=None, text='q r s t u v', id_key='z')"]
    )
