"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from test_decontaminate import plain as plain_leaks
from test_line_dedup import plain as plain_lines
from test_mixing import check as check_mix
from test_simhash_dedup import plain_fingerprint, plain_roots

EN = "the house and the garden were quiet in the morning when they walked to the river with their old friends".split()
DE = "das haus und der garten waren ruhig am morgen als sie mit ihren alten freunden zum fluss gingen".split()


@pytest.fixture
def tables(write_tables):
    rng = random.Random(12)
    text = lambda words, n: " ".join(rng.choices(words, k=n))
    items = [(i, text(EN, 24)) for i in range(3)]
    docs = []
    for i in range(60):
        words, lang = (EN, "en") if i % 3 else (DE, "de")
        body = [f"menu of site {i % 2}", text(words, rng.randint(20, 60)), text(words, 30)]
        if i % 10 == 4:
            body.insert(1, items[i % 3][1])
        docs.append((i, "\n".join(body), lang, f"s{i % 2}", 1))
    docs += [(100 + i, docs[5][1], "en", "s1", 1) for i in range(6)]
    docs += [(200, "12 34 56", None, "s0", 8), (201, None, None, None, None), (202, "", "en", "s0", 0)]
    sf = write_tables(documents=docs, benchmark=items)
    return sf, docs, items


def test_stages_against_plain_python(spark, tables):
    sf, rows, items = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    take = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]

    first = stage["language_id"](spark, docs, sf)
    assert first.columns == docs.columns
    held = take(first)
    assert Counter(i for i, *_ in held) == Counter(i for i, *_ in rows if i not in (200, 201, 202))

    second = stage["line_dedup"](spark, first, sf)
    assert second.columns == docs.columns
    lined = take(second)
    assert {i: t for i, t, _ in lined} == plain_lines(held, 0.02, 5)
    assert not any("menu of site" in t for _, t, _ in lined)
    assert all(r.n_chars in (1, len(r.text)) for r in second.collect())

    third = stage["near_dedup"](spark, second, sf)
    assert third.columns == docs.columns
    lined.sort()
    roots = plain_roots([plain_fingerprint(t) for _, t, _ in lined])
    single = take(third)
    assert sorted(i for i, *_ in single) == sorted({lined[r][0] for r in roots})

    fourth = stage["decontamination"](spark, third, sf)
    assert fourth.columns == docs.columns
    leaks = {i for i, _ in plain_leaks([(i, t) for i, t, _ in single], items)}
    clean = take(fourth)
    assert leaks and sorted(i for i, *_ in clean) == sorted(i for i, *_ in single if i not in leaks)

    fifth = stage["mixing"](spark, fourth, sf)
    copies = Counter(r.doc_id for r in fifth.collect())

    class Row:
        def __init__(self, i, size, total, target):
            self.doc_id, self.size, self.source_size, self.target = i, size, total, target
            self.taken = size * copies[i]

    found = {r.doc_id: r for r in fifth.collect()}
    source = {s: (r.mix_source_size, r.mix_target) for i, _, s in clean if (r := found.get(i))}
    check_mix([Row(i, len(t.split()), *source[s]) for i, t, s in clean], clean, slack=0.1)


def test_run_is_the_stages_one_after_another_and_repeats(spark, tables):
    sf, _, _ = tables
    one = sorted(map(str, corpus_pipeline.run(spark, sf).collect()))
    assert one and one == sorted(map(str, corpus_pipeline.run(spark, sf).collect()))


def test_a_corpus_without_languages_keeps_what_has_letters(spark, write_tables):
    sf = write_tables(documents=[(1, "letters", None, "a", 7), (2, "12", None, "a", 2)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf).collect()] == [1]


def test_foreign_scripts_and_unlearned_languages_are_rejected_and_short_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    more = [
        (-1, "房子和花园早上很安静他们和朋友们一起走到河边"),
        (-2, "dom i ogród były ciche rano kiedy szli nad rzekę ze swoimi przyjaciółmi i rozmawiali o pogodzie"),
        (-3, "the and"),
        (-4, "der die das"),
    ]
    odd = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in more], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(odd), "").select("doc_id").collect()}
    assert {i for i in kept if i < 0} == {-3, -4}
    assert len(kept) >= 0.99 * docs.count()
