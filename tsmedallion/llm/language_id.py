"""Language identification of words, spans and documents.

A language is learned from all training texts as the frequencies of its letter trigrams
(lower case, hashed to ``BUCKETS``) and the share of its letters in each script. Counting
is by task, then summed by Spark; the model has ``BUCKETS`` numbers a language and is the
only thing that reaches the driver.

A word is a run of letters. The script of its letters, found by code point range, narrows
the languages that it can be in; each of these scores the word by its trigrams. The best
labelling of a text's words, where a change of language costs ``SWITCH``, is found by the
Viterbi algorithm and gives the spans.

The best language need not fit. A text of a language has, a letter, about the mean log
probability of its trigrams that the training texts reach when each letter is scored by all
others (exact from the counts). Half a standard deviation below it is the floor. No letter
counts for less than chance among all buckets, so a few rare trigrams weigh little. A stretch
of words whose letters stay below the floor of their language by over ``SWITCH`` in all is
``und``; so a short text is not barred by chance, and a longer one in a language never learned
is. Letters in a script that the language is not written in count for none.

The text's language is the learned one with most fitting letters, and its score their share of
all. So a text in a language never learned has a low score; whoever calls decides what to reject.

Texts are independent, so prediction has no shuffle; columns are passed through. Words repeat, so a
task keeps what it knows of a word in a table, begun anew at ``CELLS_AT_ONCE`` words x
languages. New words are scored so many letters x languages at once. Of a long text a task holds the
scores of its words.

* A null text, or one without letters, is ``und`` with score 0 and no spans; so is every
  text if nothing could be learned. A text with a letter always has a learned language. If
  nothing of it fits, as in unknown scripts, its score is 0 and its spans are ``und``.
* Ties go to the better total score, then to the first language by code point.
* Null languages are not learned from. Repeated rows count as often as they are given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.llm.common import appended, runs, strings, with_columns

BUCKETS = 1 << 15
SMOOTHING = 0.2
SWITCH = 24.0
FLOOR_DEVIATIONS = 0.5
CHANCE = -float(np.log(BUCKETS))
LEAST_SHARE = 0.01
BARRED = -1e6
MAX_LANGUAGES = 1_000
FEW_LANGUAGES = 16
CHARS_AT_ONCE = 1 << 19
CELLS_AT_ONCE = 1 << 18
UNDETERMINED = "und"

# First code points of script ranges (Unicode blocks), and their scripts.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0780, "other"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "burmese"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x13A0, "other"),
    (0x1780, "khmer"),
    (0x1800, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3130, "hangul"),
    (0x3190, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB1D, "hebrew"),
    (0xFB50, "arabic"),
    (0xFE00, "other"),
    (0xFF21, "latin"),
    (0xFF66, "kana"),
    (0xFFA0, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})
_FIRST = np.array([c for c, _ in SCRIPTS], np.uint32)
_SCRIPT = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS], np.int64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


@lru_cache(maxsize=1)
def _letter_runs() -> re.Pattern:
    """Runs of letters as ``_letters`` has them."""
    edge = np.nonzero(np.diff(_letters().astype(np.int8), prepend=0, append=0))[0].tolist()
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in zip(edge[::2], edge[1::2])) + "]+")


@dataclass
class Words:
    """The words of several texts, one after the other."""

    trigrams: np.ndarray  # bucket of each letter's trigram
    first: np.ndarray  # of each word: its first letter
    script: np.ndarray  # of each letter
    text: np.ndarray  # of each word: its text


def words_of(texts: list[str]) -> Words:
    codes = np.frombuffer("\n".join(["", *(t.lower() for t in texts), ""]).encode("utf-32-le", "replace"), "<u4")
    lengths = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    letter = _letters()[codes]
    code = np.where(letter, codes, 0).astype(np.uint64)
    at = np.nonzero(letter)[0]
    mixed = (
        code[at - 1] * np.uint64(0x9E3779B97F4A7C15)
        + code[at] * np.uint64(0xC2B2AE3D27D4EB4F)
        + code[at + 1] * np.uint64(0x165667B19E3779F9)
    )
    trigrams = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(49)
    first = np.nonzero(~letter[at - 1])[0]
    ends = np.cumsum(lengths)  # text i has the places from ends[i - 1] + 1 to ends[i]
    return Words(
        trigrams.astype(np.int64),
        first,
        _SCRIPT[np.searchsorted(_FIRST, codes[at], side="right") - 1],
        np.searchsorted(ends, at[first], side="left"),
    )


@dataclass
class Model:
    languages: list[str]
    trigrams: np.ndarray  # (bucket, language): log probability
    allowed: np.ndarray  # (script, language): whether the language is written in it
    floor: np.ndarray | None = None  # (language): log probability a letter of text that fits

    def word_scores(self, words: Words) -> np.ndarray:
        """(word, language); languages that a word's scripts rule out are barred."""
        known = self.allowed.any(axis=1)
        bar = np.where(~self.allowed & known[:, None], BARRED, 0.0)
        ends = np.append(words.first[1:], len(words.trigrams))
        out = np.empty((len(words.first), len(self.languages)))
        for low, high in runs(ends - words.first, max(1, CELLS_AT_ONCE // len(self.languages))):
            letters, first = slice(words.first[low], ends[high - 1]), words.first[low:high] - words.first[low]
            scores, script = self.trigrams[words.trigrams[letters]], words.script[letters]
            foreign = ~known[script]
            if foreign.any():
                scores[foreign] = 0  # chance would choose
            out[low:high] = np.add.reduceat(scores, first, axis=0)
            if bar.any():
                out[low:high] += np.add.reduceat(bar[script], first, axis=0)
        return out

    def fit(self, words: Words, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, in its language of ``path``: letters in its scripts, and what they
        score above the floor."""
        lang = np.repeat(path, np.diff(np.append(words.first, len(words.trigrams))))
        able = self.allowed[words.script, lang]
        floor = np.full(len(self.languages), -np.inf) if self.floor is None else self.floor
        above = np.where(able, np.maximum(self.trigrams[words.trigrams, lang], CHANCE) - floor[lang], 0.0)
        return np.add.reduceat(able.astype(np.int64), words.first), np.add.reduceat(above, words.first)


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Learn every non-null language of ``docs`` from all of its texts.

    More than ``max_languages`` of them are refused, as the model goes to every task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = strings(batch.column(0)), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                held = seen.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                for low, high in runs(map(len, own), CHARS_AT_ONCE):
                    words = words_of(own[low:high])
                    held[:BUCKETS] += np.bincount(words.trigrams, minlength=BUCKETS)
                    held[BUCKETS:] += np.bincount(words.script, minlength=len(SCRIPT_NAMES))
        for lang, held in seen.items():
            cells = np.nonzero(held)[0]
            columns = [pa.array([lang] * len(cells), pa.string()), pa.array(cells), pa.array(held[cells])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "cell", "n"])

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = (
        known.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .mapInArrow(count, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
    )
    cells = max_languages * (BUCKETS + len(SCRIPT_NAMES))
    found = counts.limit(cells + 1).toArrow()
    if found.num_rows > cells:
        raise ValueError(f"over {max_languages} languages")
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    grid = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    grid[found.column("cell").to_numpy(), [languages.index(n) for n in names]] = found.column("n").to_numpy()
    grams, scripts = grid[:BUCKETS] + SMOOTHING, grid[BUCKETS:]
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    return Model(languages, np.log(grams / grams.sum(axis=0)), share >= LEAST_SHARE, _floor(grid[:BUCKETS]))


def _floor(counts: np.ndarray) -> np.ndarray:
    """The log probability a letter, by language, that text must reach to fit."""
    letters = np.maximum(1, counts.sum(axis=0))
    others = np.log((np.maximum(counts - 1, 0) + SMOOTHING) / (letters - 1 + SMOOTHING * BUCKETS))
    others = np.maximum(others, CHANCE)
    mean = (counts * others).sum(axis=0) / letters
    return mean - FLOOR_DEVIATIONS * np.sqrt((counts * (others - mean) ** 2).sum(axis=0) / letters)


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, where every change costs ``switch``.

    If no stretch of words is better by over half a switch in another language than in the
    best one overall, no path with a change can win, and the search is not needed.
    """
    best = int(scores.sum(axis=0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    floor = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
    if (gain - np.vstack([np.zeros_like(floor[:1]), floor[:-1]])).max() <= switch / 2:
        return np.full(len(scores), best)
    n, m = scores.shape
    if m <= FEW_LANGUAGES and n * m <= CELLS_AT_ONCE:
        return _search_few(scores, switch)
    back = np.empty((n, m), np.int32)
    own = np.arange(m)
    total = scores[0].copy()
    back[0] = own
    for i in range(1, n):
        top = int(total.argmax())
        jump = total[top] - switch
        stay = total >= jump
        back[i] = np.where(stay, own, top)
        total = np.where(stay, total, jump) + scores[i]
    path = np.empty(n, np.int64)
    state = int(total.argmax())
    for i in range(n - 1, -1, -1):
        path[i] = state
        state = back[i, state]
    return path


def _search_few(scores: np.ndarray, switch: float) -> np.ndarray:
    """The search of ``viterbi`` over lists, which is faster where a word has few numbers."""
    first, *rest = scores.tolist()
    totals, tops, jumps = [first], [0], [0.0]
    total = first
    for row in rest:
        best = max(total)
        jump = best - switch
        tops.append(total.index(best))
        jumps.append(jump)
        total = [(t if t >= jump else jump) + r for t, r in zip(total, row)]
        totals.append(total)
    state = total.index(max(total))
    path = [state] * len(totals)
    for i in range(len(totals) - 1, 0, -1):
        if totals[i - 1][state] < jumps[i]:
            state = tops[i]
        path[i - 1] = state
    return np.array(path, np.int64)


def unfit(above: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Whether each word of a text is in a stretch that fits no language.

    ``above``: what the words score above the floor. To begin in, enter and leave such a
    stretch costs ``switch`` each.
    """
    gain = np.cumsum(above)
    if (np.maximum.accumulate(np.append(0.0, gain[:-1])) - gain).max() <= switch:
        return np.zeros(len(above), bool)
    scores = np.column_stack([above, np.zeros(len(above))])
    scores[0, 1] -= switch
    return viterbi(scores, switch) == 1


class WordTable:
    """What a model says of each word met so far."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        n = len(self.model.languages)
        self.index: dict[str, int] = {}
        self.scores, self.above = np.empty((0, n)), np.empty((0, n))
        self.able, self.letters = np.empty((0, n), np.int32), np.empty(0, np.int64)

    def places(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the rows of its words, in order."""
        found = [_letter_runs().findall(t.lower()) for t in texts]
        if len(self.index) * len(self.model.languages) > CELLS_AT_ONCE:
            self._clear()
        new = [w for w in dict.fromkeys(chain.from_iterable(found)) if w not in self.index]
        if new:
            self._add(new)
        return [np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)) for words in found]

    def _add(self, new: list[str]) -> None:
        old, every = len(self.index), range(len(self.model.languages))
        self.index.update(zip(new, range(old, old + len(new))))
        if len(self.index) > len(self.scores):
            rows = max(1 << 12, 2 * len(self.index))
            for name in ("scores", "above", "able", "letters"):
                held = getattr(self, name)
                grown = np.empty((rows, *held.shape[1:]), held.dtype)
                grown[:old] = held[:old]
                setattr(self, name, grown)
        for low, high in runs(map(len, new), CHARS_AT_ONCE):
            words, to = words_of(new[low:high]), slice(old + low, old + high)
            self.scores[to] = self.model.word_scores(words)
            self.letters[to] = np.diff(np.append(words.first, len(words.trigrams)))
            for k in every:
                self.able[to, k], self.above[to, k] = self.model.fit(words, np.full(high - low, k))


def label(
    model: Model, texts: list[str], switch: float = SWITCH, table: WordTable | None = None
) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Of each text: language, score, and spans (first word, end, language)."""
    out, table = [], table or WordTable(model)
    names = [*model.languages, UNDETERMINED]
    none = len(model.languages)
    if not none:
        return [(UNDETERMINED, 0.0, [])] * len(texts)
    for places in chain.from_iterable(table.places(texts[low:high]) for low, high in runs(map(len, texts), CHARS_AT_ONCE)):
        if not len(places):
            out.append((UNDETERMINED, 0.0, []))
            continue
        scores = table.scores[places]
        path = viterbi(scores, switch)
        fits = table.able[places, path] * ~unfit(table.above[places, path])
        share = np.bincount(path, fits, none)
        best = max(range(none), key=lambda k: (share[k], scores[:, k].sum(), -k))
        own = np.where(fits > 0, path, none)
        turn = np.append(np.nonzero(np.diff(own, prepend=-1))[0], len(own)).tolist()
        spans = [(a, b, names[own[a]]) for a, b in zip(turn[:-1], turn[1:])]
        out.append((names[best], float(share[best] / table.letters[places].sum()), spans))
    return out


SPANS = T.ArrayType(
    T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
)


def identify(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    columns: tuple[str, str, str] = ("lang_pred", "score", "lang_spans"),
    switch: float = SWITCH,
) -> DataFrame:
    """``docs`` with the predicted language, its score and the spans of all languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(shared.value)
        for batch in batches:
            found = label(shared.value, strings(batch.column(place)), switch, table)
            spans = [[{"first": a, "end": b, "lang": x} for a, b, x in s] for _, _, s in found]
            yield with_columns(
                batch,
                (columns[0], pa.array([lang for lang, _, _ in found], pa.string())),
                (columns[1], pa.array([score for _, score, _ in found], pa.float64())),
                (columns[2], pa.array(spans, span)),
            )

    fields = zip(columns, (T.StringType(), T.DoubleType(), SPANS))
    return docs.mapInArrow(run, appended(docs, *fields))
