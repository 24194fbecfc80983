"""Quality rules as a short-circuit cascade.

Each rule is a cheap test of one text. A sample of bounded size gives each rule's cost per text and its
rejections; rules then run in the order of rejections per second, and a text that one rule rejects is
not looked at by the later ones. The order changes the work, never the verdict, as a text is kept only
if no rule rejects it.

Defined results: a null or empty text has no words and fails; every column but the id and the text is
passed through untouched; repeated rows get equal verdicts; an empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexframe.llm import kit

#: Limits of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 20
MAX_DUP_LINE_PERCENT = 60
MIN_MEAN_WORD, MAX_MEAN_WORD = 2.0, 16.0
MAX_CAPITAL_PERCENT = 60
MAX_MARKS_PER_100_WORDS = 50
MIN_WORDY_PERCENT = 60
#: Rows of the sample from which costs and rejections are estimated.
SAMPLE_ROWS = 512

_CONTINUATION = np.zeros(256, bool)
_CONTINUATION[0x80:0xC0] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0xC3:0xF5] = True
_SMALL = np.zeros(256, bool)
_SMALL[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[[ord("!"), ord("?")]] = True


class Texts:
    """Measures of a run of texts, each worked out once, when a rule first asks for it."""

    def __init__(self, data: np.ndarray, off: np.ndarray, i: int, j: int):
        self.spans = kit.Spans(data, off, i, j)
        self.n = self.spans.rows
        self._known: dict[str, np.ndarray] = {}

    def get(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = getattr(self, f"_{name}")()
        return self._known[name]

    def _words(self):
        return self.spans.words()

    def _count(self, flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.spans.off])

    def _n_words(self):
        return np.bincount(self.get("words")[2], minlength=self.n).astype(np.int64)

    def _word_chars(self):
        d = self.spans.data
        return self._count(~kit.SPACE[d] & ~_CONTINUATION[d])

    def _n_symbols(self):
        return self._count(_SYMBOL[self.spans.data])

    def _capitals(self):
        return self._count(_CAPITAL[self.spans.data])

    def _smalls(self):
        return self._count(_SMALL[self.spans.data])

    def _marks(self):
        return self._count(_MARK[self.spans.data])

    def _worded_lines(self):
        start, end, row = self.spans.lines()
        inside = np.zeros(len(self.spans.data) + 1, np.int64)
        np.cumsum(~kit.SPACE[self.spans.data], out=inside[1:])
        full = inside[end] > inside[start]
        return start[full], end[full], row[full]

    def _n_lines(self):
        return np.bincount(self.get("worded_lines")[2], minlength=self.n).astype(np.int64)

    def _n_dup_lines(self):
        start, end, row = self.get("worded_lines")
        key = kit.digest(self.spans.hashes(start, end), row)
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(key), bool)
        again[first] = False
        return np.bincount(row[again], minlength=self.n).astype(np.int64)

    def _n_repeat_words(self):
        start, end, row = self.get("words")
        h, first = kit.windows(self.spans.hashes(start, end), row, 3)
        key = kit.digest(h, row[first])
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        at = first[times[which] > 1]
        hit = np.zeros(len(row) + 1, np.int64)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + 3, -1)
        return np.bincount(row[np.cumsum(hit[:-1]) > 0], minlength=self.n).astype(np.int64)

    def _wordy(self):
        start, end, row = self.get("words")
        letters = np.zeros(len(self.spans.data) + 1, np.int64)
        np.cumsum(_LETTER[self.spans.data], out=letters[1:])
        return np.bincount(row[letters[end] > letters[start]], minlength=self.n).astype(np.int64)

    def take(self, rows: np.ndarray) -> Texts:
        """These rows alone, for the rules still to come."""
        s = self.spans
        size = np.diff(s.off)[rows]
        keep = np.zeros(s.rows, bool)
        keep[rows] = True
        data = s.data[np.repeat(keep, np.diff(s.off))]
        return Texts(data, np.concatenate([[0], np.cumsum(size)]), 0, len(rows))


#: Rule -> which texts it rejects.
RULES: dict[str, Callable[[Texts], np.ndarray]] = {
    "few_words": lambda t: t.get("n_words") < MIN_WORDS,
    "repeats": lambda t: 100 * t.get("n_repeat_words") > MAX_REPEAT_PERCENT * t.get("n_words"),
    "symbols": lambda t: 100 * t.get("n_symbols") > MAX_SYMBOLS_PER_100_WORDS * t.get("n_words"),
    "dup_lines": lambda t: 100 * t.get("n_dup_lines") > MAX_DUP_LINE_PERCENT * t.get("n_lines"),
    "word_length": lambda t: (t.get("word_chars") < MIN_MEAN_WORD * t.get("n_words")) | (t.get("word_chars") > MAX_MEAN_WORD * t.get("n_words")),
    "shouting": lambda t: 100 * t.get("capitals") > MAX_CAPITAL_PERCENT * (t.get("capitals") + t.get("smalls")),
    "marks": lambda t: 100 * t.get("marks") > MAX_MARKS_PER_100_WORDS * t.get("n_words"),
    "letters": lambda t: 100 * t.get("wordy") < MIN_WORDY_PERCENT * t.get("n_words"),
}


def measure(array: pa.Array) -> list[tuple[str, float, int, int]]:
    """(rule, seconds, rejected, texts) of every rule, each run on its own over all given texts."""
    data, off = kit.texts(array)
    out = []
    for name, rule in RULES.items():
        began, bad = time.perf_counter(), 0
        for i, j in kit.slices(off):
            bad += int(rule(Texts(data, off, i, j)).sum())
        out.append((name, time.perf_counter() - began, bad, len(array)))
    return out


def plan(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second over a sample of at most `sample_rows` rows, best first.

    The rows are the first that come, read from as few partitions as have them; what they say changes the work, never a verdict."""
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t")).head(sample_rows)
    rate = {name: (bad + 0.5) / max(cost, 1e-9) for name, cost, bad, _ in measure(pa.array([r.t for r in rows], pa.string()))}
    return sorted(RULES, key=lambda r: (-rate.get(r, 0.0), r))


def cascade(t: Texts, order: list[str]) -> np.ndarray:
    """Which texts no rule rejects; each rule sees only what the earlier ones left."""
    alive = np.arange(t.n)
    for name in order:
        if not len(alive):
            break
        bad = RULES[name](t)
        if bad.any():
            alive = alive[~bad]
            if 2 * len(alive) < t.n:  # worth a copy: later rules then read less
                t, at = t.take(np.flatnonzero(~bad)), alive
                alive = at
            else:
                t = _Left(t, ~bad)
    out = np.zeros(0, np.int64)
    return alive if len(alive) else out


class _Left:
    """A view of the texts that are left, while most are."""

    def __init__(self, t, keep: np.ndarray):
        self.t, self.rows = t, np.flatnonzero(keep)
        self.n = len(self.rows)

    def get(self, name: str) -> np.ndarray:
        return self.t.get(name)[self.rows]

    def take(self, rows: np.ndarray) -> Texts:
        return self.t.take(self.rows[rows])


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """key, the base measures, base_failed and kept of every row, in one pass without a shuffle."""
    order = order or plan(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = kit.texts(batch.column(1))
            got: dict[str, list[np.ndarray]] = {k: [np.zeros(0, np.int64)] for k in (*BASE, "kept")}
            for i, j in kit.slices(off):
                t = Texts(data, off, i, j)
                good = np.zeros(j - i, np.int64)
                good[cascade(t, order)] = 1
                for k in BASE:
                    got[k].append(t.get(k))
                got["kept"].append(good)
            x = {k: np.concatenate(v) for k, v in got.items()}
            failed = (x["n_words"] < MIN_WORDS) | (100 * x["n_repeat_words"] > MAX_REPEAT_PERCENT * x["n_words"])
            yield pa.record_batch([batch.column(0), *(pa.array(x[k]) for k in BASE), pa.array(failed), pa.array(x["kept"].astype(bool) & ~failed)], ["k", *BASE, "base_failed", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    rows = kit.split_rows(docs).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, {', '.join(f'{b} long' for b in BASE)}, base_failed boolean, kept boolean").withColumnRenamed("k", key)


def filter_rows(docs: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    order = order or plan(docs, text)
    where = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = kit.texts(batch.column(where).cast(pa.string()))
            keep = [i + cascade(Texts(data, off, i, j), order) for i, j in kit.slices(off)]
            if keep:
                yield batch.take(pa.array(np.concatenate(keep)))

    # names with dots can't be handed to Python as they are
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return kit.split_rows(plain).mapInArrow(run, plain.schema).toDF(*docs.columns)
