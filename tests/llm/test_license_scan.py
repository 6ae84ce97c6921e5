from __future__ import annotations

import itertools
import random
import re

import pytest

from tsmedallion.llm.license_scan import BASE, TEMPLATES, Scanner, compile_template, notices, wordings
from tsmedallion.llm.queries import op7_license_scan

FIXED = [
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License.",
    "under the terms of the mit license and under the MIT-license",
    "licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the gnu general public license either version 3 or at your option any later version",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this fine tool and associated documentation files",
    "under under the mit license the mit license",
    "ünder the mit license; under the mit license",
    "nothing here",
    "",
    None,
]


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain_base(words):
    out = []
    for phrase, label in BASE.items():
        parts = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return sorted(out)


def as_regex(markup):
    """The template as a regular expression over words that each end in a blank."""
    out = ""
    for part in re.split(r"(\[\[|\]\]|<<[^>]*>>)", markup):
        if part == "[[":
            out += "(?:"
        elif part == "]]":
            out += ")?"
        elif part.startswith("<<"):
            least, _, most = part[2:-2].rpartition("..")
            out += f"(?:[^ ]+ ){{{least or most},{most}}}"
        else:
            out += "".join(re.escape(w) + " " for w in plain_words(part))
    return re.compile(out)


def plain_accepted(words, templates):
    out, joined = [], "".join(w + " " for w in words)
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)][:-1]
    for label, markup in templates:
        pattern = as_regex(markup)
        out += [(at, label) for at, place in enumerate(starts) if pattern.match(joined, place)]
    return sorted(set(out))


def test_query_against_plain_python(spark, write_tables):
    rng = random.Random(7)
    vocabulary = sorted({w for _, t in notices() for w in re.findall("[a-z0-9]+", t)})
    texts = [*FIXED, *(" ".join(rng.choices(vocabulary, k=40)) for _ in range(30))]
    for label, markup in TEMPLATES:  # every template with all, and with no, optional wording
        whole = re.sub(r"<<.*?>>", "some", markup.replace("[[", "").replace("]]", ""))
        short = markup
        while "[[" in short:
            short = re.sub(r"\[\[[^\[\]]*\]\]", "", short)
        texts += [whole, re.sub(r"<<.*?>>", "x", short), whole.replace("under", "over")]
    sf = write_tables(documents=[(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    for r in op7_license_scan(spark, sf).collect():
        words = plain_words(texts[r.doc_id])
        base = plain_base(words)
        more = {x for _, x in plain_accepted(words, TEMPLATES)}
        own = {x for _, x in base}
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted(own)) and r.labels == ",".join(sorted(own | more))
        assert r.score == (1.0 if more else 0.5 if own else 0.0)
    assert {r.labels for r in op7_license_scan(spark, sf).collect()} >= {"", *(label for label, _ in TEMPLATES)}


def test_real_documents_against_plain_python(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = set()
    for r in op7_license_scan(spark, "/root/testdata/sf0.01").collect():
        words = plain_words(docs[r.doc_id])
        base = plain_base(words)
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(base), ",".join(sorted({x for _, x in base})))
        labels.add(r.labels)
    assert {"mit", "apache-2", "gpl-3", "cc-by-nc"} <= labels


def test_automata_against_regular_expressions():
    markups = ["a [[b]] c", "a <<0..2>> b", "a [[b <<1>> [[c]]]] a", "[[a]] b <<1..2>> [[c c]]", "a <<2>> [[a]]"]
    words = [b"a", b"b", b"c"]
    for markup in markups:
        made, pattern = compile_template("x", markup), as_regex(markup)
        for n in range(1, 7):
            for text in itertools.product(words, repeat=n):
                joined = b"".join(w + b" " for w in text).decode()
                ends = [e for e in range(n + 1) if pattern.fullmatch("".join(w.decode() + " " for w in text[:e]))]
                assert made.longest(list(text), 0) == (max(ends) if ends else None), (markup, joined)


def labels_of(text):
    return {label for *_, label in Scanner(BASE, TEMPLATES).scan(text.encode())[2]}


def spelt(markup):
    """A licence as its template has it, with some holder in the replaceable places."""
    return re.sub(r"<<(?:(\d+)\.\.)?(\d+)>>", lambda m: "the holder " if int(m[2]) > 1 else "holder ", markup.replace("[[", " ").replace("]]", " "))


@pytest.mark.parametrize("label, markup", wordings(), ids=lambda x: x if len(x) < 20 else "")
def test_a_changed_licence_is_refused(label, markup):
    text = spelt(markup)
    words = text.split()
    free = {"the", "holder", *" ".join(re.findall(r"\[\[(.*?)\]\]", markup)).split()}
    assert label in labels_of(text) and len(words) > 90
    assert label in labels_of("Copyright 2024\n\n" + text.upper() + "\nand more behind it")
    for at in (len(words) // 3, len(words) // 2, 3 * len(words) // 4, len(words) - 2):
        while words[at] in free or words[at] == words[at - 1]:
            at -= 1
        changed = (
            words[:at] + words[at + 1 :],  # a word dropped
            [*words[:at], "except", "for", "military", "use", "of", "any", "kind", "by", "anyone", "ever", "in", "any", "place", *words[at:]],
            words[:at],  # the opening alone
        )
        for one in changed:
            if plain_words(" ".join(one)) != plain_words(text):
                assert label not in labels_of(" ".join(one)), (label, at, one[at - 3 : at + 3])


def test_published_texts_of_other_packages_are_found():
    """Texts that other packages bring along, where they are installed."""
    import importlib.metadata as metadata

    wanted = {"pytz": "mit", "urllib3": "mit", "zstandard": "bsd-3", "charset-normalizer": "mit"}
    seen = 0
    for package, label in wanted.items():
        try:
            files = [f for f in metadata.files(package) or [] if re.search(r"licen[cs]e[^/]*$", str(f), re.I)]
        except metadata.PackageNotFoundError:
            continue
        for f in files:
            assert label in labels_of(f.read_text()), package
            seen += 1
    if not seen:
        pytest.skip("no package with a licence file")


def test_families_are_told_apart():
    assert len({label for label, _ in TEMPLATES}) >= 18
    assert labels_of("licensed under CC BY-NC 4.0") == {"cc-by-nc"}
    assert labels_of("licensed under CC BY-SA 4.0") == {"cc-by-sa"} and labels_of("licensed under CC BY 4.0") == {"cc-by"}
    gnu = "under the terms of the GNU {} Public License as published by the Free Software Foundation; either version {} of the License"
    assert labels_of(gnu.format("Lesser General", "2.1")) == {"lgpl-2.1"} and labels_of(gnu.format("General", "2")) == {"gpl-2"}
    assert labels_of(gnu.format("Affero General", "3")) == {"agpl-3"}


def test_faulty_templates_are_refused():
    for markup in ("[[a]]", "<<1>> a", "a ]] b", "a [[ b"):
        with pytest.raises(ValueError):
            Scanner({}, (("x", markup),))
