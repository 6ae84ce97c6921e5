"""License scans by template markup compiled into token automata.

There are templates of whole licences, with all of their mandatory wording, and of short notices
that name a licence. A licence text that was changed anywhere, at its end too, is not accepted.

A template is licence wording in which ``[[...]]`` encloses wording that may be left out and
``<<n>>`` or ``<<m..n>>`` stands for m to n words that may be replaced. It is compiled into
an automaton over words; a place in a text is accepted if a run from there ends in the last
state, that is if all mandatory wording stands there exactly and in order.

An automaton starts only at the template's first words and only in texts that have all its
mandatory words. Texts are independent, so there is no shuffle, and a place is followed for
at most as many words as the template's longest form.

* Words are runs of letters and digits (and of all characters beyond ASCII), with A-Z in
  lower case. A null or empty text has no words, no labels and score 0.
* The longest acceptance at a place counts, once; overlapping places count each.
* The score is 1 if the method accepts a template, 0.5 if only a base phrase occurs, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from tsmedallion.llm.common import utf8

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MARK = re.compile(r"(\[\[|\]\]|<<(?:\d+\.\.)?\d+>>)")

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short statements that name a licence.
NAMED = (
    ("mit", "mit license"),
    ("isc", "isc license"),
    ("bsd-2", "bsd 2 clause license"),
    ("bsd-3", "bsd 3 clause license"),
    ("mpl-2", "mozilla public license [[version]] [[v]] 2 0"),
)
GNU = (
    ("gpl-2", "general", "2"),
    ("gpl-3", "general", "3"),
    ("lgpl-2", "library general", "2"),
    ("lgpl-2.1", "lesser general", "2 1"),
    ("lgpl-3", "lesser general", "3"),
    ("agpl-3", "affero general", "3"),
)
CREATIVE = (("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution sharealike"))
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def notices() -> list[tuple[str, str]]:
    """Templates of the statements that put a work under a licence without its wording."""
    out = [(label, f"[[released]] [[distributed]] [[licensed]] [[available]] under the [[terms of the]] {name}") for label, name in NAMED]
    for label, name, version in GNU:
        later = "[[or at your option any later version]]"
        out.append((label, f"licensed under the [[terms of the]] gnu {name} public license [[as published by the free software foundation]] [[either]] version {version} {later}"))
        out.append((label, f"under the terms of the gnu {name} public license as published by the free software foundation [[either]] version {version} [[of the license]] {later}"))
    for label, short, long in CREATIVE:
        for v in CREATIVE_VERSIONS:
            out.append((label, f"licensed under [[a]] [[the]] [[creative commons]] cc {short} {v}"))
            out.append((label, f"licensed under [[a]] [[the]] creative commons {long} {v} [[international]] [[unported]] [[generic]] license"))
    return out + [
        ("apache-2", "licensed under the apache license version 2 [[0]] [[the license]]"),
        ("cc-by-nc", "licensed under [[a]] [[the]] [[creative commons]] cc by nc [[sa]] [[nd]] <<0..1>>"),
        ("cc-by-nc", "licensed under [[a]] [[the]] creative commons attribution noncommercial [[<<1..3>>]] [[international]] license"),
        ("mpl-2", "subject to the terms of the mozilla public license [[version]] [[v]] 2 0"),
    ]


def wordings(folder: Path = Path(__file__).with_name("licences")) -> list[tuple[str, str]]:
    """Templates of whole licences: a file each, named by its label, with the wording as it is published,
    from its first sentence or article to its last, and markup where it may vary."""
    return [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(folder.glob("*.txt"))]


TEMPLATES = (*notices(), *wordings())


@dataclass
class Automaton:
    """States with word moves, moves by any word, and moves without a word."""

    label: str
    moves: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any_word: dict[int, int] = field(default_factory=dict)
    free: list[set[int]] = field(default_factory=lambda: [set()])
    mandatory: set[bytes] = field(default_factory=set)

    def _new(self) -> int:
        self.moves.append({})
        self.free.append(set())
        return len(self.moves) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - out:
                out.add(s)
                todo.append(s)
        return out

    def start_words(self) -> set[bytes]:
        first = self.closed({0})
        if first & self.any_word.keys() or len(self.moves) - 1 in first:
            raise ValueError(f"template of {self.label} can begin with any word or be empty")
        return {w for s in first for w in self.moves[s]}

    def longest(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest acceptance from word ``at``."""
        last, end = len(self.moves) - 1, None
        states = self.closed({0})
        for i in range(at, len(words) + 1):
            if last in states:
                end = i
            if i == len(words) or not states:
                break
            step = {t for s in states if (t := self.moves[s].get(words[i])) is not None}
            step |= {self.any_word[s] for s in states if s in self.any_word}
            states = self.closed(step)
        return end


def compile_template(label: str, markup: str) -> Automaton:
    made, state, opened = Automaton(label), 0, []
    for part in MARK.split(markup):
        if part == "[[":
            opened.append(state)
            state_after = made._new()
            made.free[state].add(state_after)
            state = state_after
        elif part == "]]":
            if not opened:
                raise ValueError(f"template of {label} closes what it has not opened")
            end = made._new()
            made.free[state].add(end)
            made.free[opened.pop()].add(end)
            state = end
        elif part.startswith("<<"):
            least, _, most = part[2:-2].rpartition("..")
            least, most = int(least or most), int(most)
            ends = []
            for i in range(most):
                if i >= least:
                    ends.append(state)
                new = made._new()
                made.any_word[state] = new
                state = new
            for s in ends:
                made.free[s].add(state)
        else:
            for word in WORD.findall(part.lower().encode()):
                new = made._new()
                made.moves[state][word] = new
                state = new
                if not opened:
                    made.mandatory.add(word)
    if opened:
        raise ValueError(f"template of {label} leaves an optional region open")
    final = made._new()
    made.free[state].add(final)
    return made


class Scanner:
    """Base phrases and templates, looked up by the words they can begin with."""

    def __init__(self, base: dict[str, str], templates: tuple[tuple[str, str], ...]):
        self.base = [(tuple(p.encode().split()), label) for p, label in base.items()]
        self.automata = [compile_template(*t) for t in templates]
        self.starts = [a.start_words() for a in self.automata]

    @staticmethod
    def places(words: list[bytes], word: bytes) -> Iterator[int]:
        at = -1
        try:
            while True:
                at = words.index(word, at + 1)
                yield at
        except ValueError:
            return

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words; base places and acceptances, as (start, end, label)."""
        words = WORD.findall(text.lower())
        has = set(words)
        base = [
            (at, at + len(phrase), label)
            for phrase, label in self.base
            if has.issuperset(phrase)
            for at in self.places(words, phrase[0])
            if tuple(words[at : at + len(phrase)]) == phrase
        ]
        found = [
            (at, end, automaton.label)
            for automaton, starts in zip(self.automata, self.starts)
            if automaton.mandatory <= has
            for first in starts & has
            for at in self.places(words, first)
            if (end := automaton.longest(words, at)) is not None
        ]
        return len(words), sorted(base), sorted(found)


SPANS = "array<struct<first:long,end:long,label:string>>"


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] | None = None,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """Of every row: id, n_words, base (spans of base phrases), accepted (of templates)."""
    base = BASE if base is None else base
    Scanner(base, templates)  # a faulty template fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
        make = lambda a, b, label: {"first": a, "end": b, "label": label}
        for batch in batches:
            scans = [scanner.scan(t) for t in utf8(batch.column(1))]
            columns = [
                batch.column(0),
                pa.array([n for n, _, _ in scans], pa.int64()),
                pa.array([[make(*x) for x in b] for _, b, _ in scans], span),
                pa.array([[make(*x) for x in f] for _, _, f in scans], span),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "base", "accepted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, base {SPANS}, accepted {SPANS}"
    )
