"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample.

1. Base measures.  Every text gets its counts: words, code points in words, symbols, lines equal to an
   earlier line, and words in windows of eight words that the text holds twice.  Texts with too few words
   or too many repeated ones fail at once and no rule sees them.
2. Sample.  About SAMPLE_ROWS documents, drawn over the whole table, go through every rule: the task that
   holds them measures each rule's seconds and which documents it rejects, and only sums over equal
   patterns of rejection leave the tasks.
3. Order.  The first rule is the one with the most rejections per second; the next one is chosen the same
   way from the documents that are left, and so on.  Rules that reject nothing more follow by cost.
4. Cascade.  In blocks of texts a rule only sees the texts that no rule before it rejected: when fewer than
   half of a block are left, the others are taken out.

A document is kept if no rule rejects it, whatever the order, so the sample bears on the cost alone: it
never changes ``kept``.  ``failed`` names the first rule that rejected, which does depend on the order.

Edge cases: a null text counts as the empty one, which has no words and fails; rows that repeat a doc_id
or a text each get their row; a null doc_id is carried through; an empty table gives an empty result; other
columns are ignored whatever their names; of equal lines, and of tied words, all count alike.  Texts are
handled in blocks of bounded size, a longer text in one of its own: memory follows the longest text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import SPACE_BREAKS, blocks, byte_hashes, text_buffer, word_shingles, words
from .common import ship_package

WINDOW, FEWEST_WORDS, REPEATED_PERCENT = 8, 20, 30
SAMPLE_ROWS = 4000


def _bytes(*chosen: int | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for c in chosen:
        out[c] = True
    return out


_SYMBOLS = _bytes(*b"#*$%&|<>")
_STARTS = _bytes(range(0, 0x80), range(0xC0, 0x100))  # the first byte of a code point
_UPPER, _LETTERS = _bytes(range(65, 91)), _bytes(range(65, 91), range(97, 123))
_WORDY = _LETTERS | _bytes(range(0x80, 0x100))
_MARKS = _bytes(range(0x21, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x7F))
_DASHES = _bytes(*b"-*")
_NEWLINE = 10


def _same(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first place of each group of equal values of one owner in that order, size of each group)."""
    order = np.lexsort((value, owner))
    v, o = value[order], owner[order]
    head = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) if len(v) else np.zeros(0, np.int64)
    return order, head, np.diff(np.r_[head, len(v)])


class Texts:
    """Texts as one byte buffer; measures are made when first asked for."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.data, self.offsets = text_buffer(column)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Texts:
        return Texts(self.column.take(pa.array(rows)))

    def sums(self, flag: np.ndarray, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """How many flagged bytes each text, or each data[start:stop], has."""
        before = np.r_[0, np.cumsum(flag)]
        return before[self.offsets[1:] if stop is None else stop] - before[self.offsets[:-1] if start is None else start]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return words(self.data, self.offsets, SPACE_BREAKS)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return byte_hashes(self.data, *self.words[:2])

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, stop, row) of the lines that hold a word."""
        ends = np.flatnonzero(self.data == _NEWLINE)
        start = np.unique(np.r_[self.offsets[:-1], ends + 1])
        start = start[start < len(self.data)]
        row = np.searchsorted(self.offsets, start, "right") - 1
        stop = np.minimum(np.r_[ends, len(self.data)][np.searchsorted(ends, start)], self.offsets[row + 1])
        real = self.sums(~SPACE_BREAKS[self.data], start, stop) > 0
        return start[real], stop[real], row[real]

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.bincount(self.words[2], minlength=len(self))

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self.lines[2], minlength=len(self))

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self.sums(~SPACE_BREAKS[self.data] & _STARTS[self.data])

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.sums(_SYMBOLS[self.data])

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        start, stop, row = self.lines
        order, head, size = _same(byte_hashes(self.data, start, stop), row)
        return np.bincount(row[order[head]], size - 1, len(self)).astype(np.int64)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        row = self.words[2]
        value, owner, at = word_shingles(self.word_hashes, row, WINDOW, short=False)
        order, head, size = _same(value, owner)
        again = at[order[np.repeat(size > 1, size)]]
        step = np.zeros(len(row) + WINDOW + 1, np.int64)
        np.add.at(step, again, 1)
        np.add.at(step, again + WINDOW, -1)
        return np.bincount(row[np.cumsum(step)[: len(row)] > 0], minlength=len(self))

    @cached_property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < FEWEST_WORDS) | (100 * self.n_repeat_words > REPEATED_PERCENT * self.n_words)

    def warm(self) -> Texts:
        """Itself, with all that the base needs."""
        for name in BASE:
            getattr(self, name)
        return self


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@dataclass(frozen=True)
class Rule:
    """``rejects`` says which texts are bad; it looks at nothing but the texts."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def _word_length(t: Texts) -> np.ndarray:
    return (t.word_chars < 2 * t.n_words) | (t.word_chars > 15 * t.n_words)


def _symbols(t: Texts) -> np.ndarray:
    return 100 * t.n_symbols > 20 * t.n_words


def _duplicate_lines(t: Texts) -> np.ndarray:
    return 100 * t.n_dup_lines > 30 * t.n_lines


def _letters(t: Texts) -> np.ndarray:
    start, stop, row = t.words
    return 100 * np.bincount(row[t.sums(_WORDY[t.data], start, stop) > 0], minlength=len(t)) < 70 * t.n_words


def _capitals(t: Texts) -> np.ndarray:
    return 100 * t.sums(_UPPER[t.data]) > 60 * t.sums(_LETTERS[t.data])


def _marks(t: Texts) -> np.ndarray:
    return 100 * t.sums(_MARKS[t.data]) > 30 * t.word_chars


def _frequent_word(t: Texts) -> np.ndarray:
    row = t.words[2]
    order, head, size = _same(t.word_hashes, row)
    most = np.zeros(len(t), np.int64)
    np.maximum.at(most, row[order[head]], size)
    return 100 * most > 30 * t.n_words


def _dashed_lines(t: Texts) -> np.ndarray:
    start, _, row = t.lines
    return 100 * np.bincount(row[_DASHES[t.data[start]]], minlength=len(t)) > 90 * t.n_lines


def _open_lines(t: Texts) -> np.ndarray:
    start, stop, row = t.lines
    dots = t.sums(t.data == 0x2E, np.maximum(start, stop - 3), stop) == 3
    return 100 * np.bincount(row[dots], minlength=len(t)) > 30 * t.n_lines


RULES = (
    Rule("word_length", _word_length), Rule("symbols", _symbols), Rule("duplicate_lines", _duplicate_lines), Rule("letters", _letters), Rule("capitals", _capitals),
    Rule("marks", _marks), Rule("frequent_word", _frequent_word), Rule("dashed_lines", _dashed_lines), Rule("open_lines", _open_lines),
)


def cascade(texts: Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """The place in ``rules`` of the first one that rejects each text: -1 for none, -2 if the base fails."""
    failed = np.where(texts.base_failed, -2, -1)
    place, alive = np.arange(len(texts)), ~texts.base_failed
    for i, rule in enumerate(rules):
        left = int(alive.sum())
        if not left:
            break
        if 2 * left < len(place):
            rows = np.flatnonzero(alive)
            texts, place, alive = texts.take(rows), place[rows], np.ones(left, bool)
        bad = rule.rejects(texts) & alive
        failed[place[bad]] = i
        alive &= ~bad
    return failed


def measured(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> tuple[dict[int, int], list[float]]:
    """({pattern: documents}, seconds of each rule) over a sample; bit i of a pattern: rule i rejects."""

    def try_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = Texts(block.column("text")).warm()
            pattern, seconds = np.zeros(len(texts), np.int64), []
            for i, rule in enumerate(rules):
                start = time.perf_counter()
                pattern |= rule.rejects(texts).astype(np.int64) << i
                seconds.append(time.perf_counter() - start)
            found, n = np.unique(pattern[~texts.base_failed], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([found.tolist()], pa.list_(pa.int64())), pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([seconds], pa.list_(pa.float64()))], ["pattern", "n", "seconds"])

    rows = docs.count()
    sample = docs.select("text").sample(fraction=min(1.0, sample_rows / max(1, rows)), seed=seed)
    tried = sample.mapInArrow(try_all, "pattern array<long>, n array<long>, seconds array<double>")
    pairs = F.arrays_zip("pattern", "n")
    times = F.transform("seconds", lambda s, i: F.struct((-1 - i).cast("long").alias("pattern"), s.alias("s")))
    cells = tried.select(F.explode(F.concat(
        F.transform(pairs, lambda p: F.struct(p["pattern"].alias("pattern"), p["n"].alias("n"), F.lit(0.0).alias("s"))),
        F.transform(times, lambda t: F.struct(t["pattern"].alias("pattern"), F.lit(0).cast("long").alias("n"), t["s"].alias("s"))))).alias("c"))
    sums = cells.groupBy("c.pattern").agg(F.sum("c.n").alias("n"), F.sum("c.s").alias("s")).collect()  # at most 2**rules patterns of the sample
    seconds = [0.0] * len(rules)
    for r in sums:
        if r["pattern"] < 0:
            seconds[-1 - r["pattern"]] = r["s"]
    return {r["pattern"]: r["n"] for r in sums if r["pattern"] >= 0}, seconds


def ordered(patterns: dict[int, int], seconds: list[float]) -> list[int]:
    """The places of the rules, by rejections per second among the documents that are left."""
    left, order = dict(patterns), []
    rest = list(range(len(seconds)))
    while rest:
        def gain(i: int) -> tuple[float, float, int]:
            rejected = sum(n for p, n in left.items() if p >> i & 1)
            return rejected / max(seconds[i], 1e-9), -seconds[i], -i

        best = max(rest, key=gain)
        rest.remove(best)
        order.append(best)
        left = {p: n for p, n in left.items() if not p >> best & 1}
    return order


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base measures, base_failed, kept and failed (base, or the first rule that rejects) of every row."""
    ship_package(docs.sparkSession)
    chain = tuple(rules[i] for i in ordered(*measured(docs, rules, sample_rows)))
    names = pa.array([*(r.name for r in chain), None, "base"])  # failed may be -1 or -2: none, base

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = Texts(block.column("text")).warm()
            failed = cascade(texts, chain)
            named = names.take(pa.array(np.where(failed == -2, len(chain) + 1, np.where(failed == -1, len(chain), failed))))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(getattr(texts, m)) for m in BASE), pa.array(failed == -1), named], ["doc_id", *BASE, "kept", "failed"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, failed string")
