"""Packing of token sequences by length patterns and non-negative least squares.

1. Every document becomes token ids plus an end id, cut into pieces of at most ``CAPACITY``.
2. The histogram of piece lengths (at most CAPACITY numbers, whatever the corpus) goes to the
   driver.  Patterns of up to ``PATTERN_DOCS`` length classes that fill a sequence are enumerated
   and their repeat counts are fitted to the histogram by non-negative least squares, rounded
   down, and filled with real lengths; what is left over is packed best-fit, into the gaps of the
   patterns first.  All of this handles runs of equal sequences, never single documents.
3. The plan is a table of runs (length, ranks from, how many, sequence from, offset).  Pieces are
   ranked within their length in two steps - within (length, salt) by a window, between salts by
   prefix sums - with a salt for every RANK_ROWS pieces of a length, so that a length held by a
   third of all pieces is spread over many tasks, and each piece finds its run by length and rank.

Edge cases: null and empty texts are one piece holding just the end id; repeated rows and rows with
a null doc_id are packed like any others, each on its own; an empty table gives an empty result; other columns are ignored.
A very long text is tokenised as one block of its own and cut into as many pieces as it takes.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blocks, text_buffer
from .bpe import engine, vocabulary_path
from .common import ship_package, stored

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END_ID = 4096, 1
#: A pattern holds at most so many documents; lengths are rounded up to CAPACITY / CLASSES.
PATTERN_DOCS, CLASSES = 4, 64
#: Pieces in one (length, salt) window, on average.
RANK_ROWS = 1000

Run = tuple[tuple[int, ...], int]  # the lengths in one sequence, and how many such sequences


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(vocabulary_path(vocabulary))
        for block in blocks(batches):
            data, offsets = text_buffer(block.column("text"))
            ids, n = bpe.encode_rows(data, offsets)
            ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
            size = n + 1
            first = np.r_[0, np.cumsum(size)[:-1]]
            parts = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            begin = first[row] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    gram, target = a.T @ a, a.T @ b
    slope = target.copy()
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        candidates = np.where(free, -np.inf, slope)
        best = int(candidates.argmax())
        if candidates[best] <= tolerance:
            break
        free[best] = True
        while True:
            on = np.flatnonzero(free)
            z = np.linalg.lstsq(gram[np.ix_(on, on)], target[on], rcond=None)[0]
            if (z > 0).all():
                break
            low = z <= 0
            step = np.min(x[on][low] / np.maximum(x[on][low] - z[low], 1e-300))
            x[on] += step * (z - x[on])
            free[on[x[on] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                z, on = np.zeros(0), np.zeros(0, int)
                break
        x[:] = 0
        x[on] = z
        slope = target - gram[:, on] @ z
    return x


def enumerate_patterns(classes: int = CLASSES, most: int = PATTERN_DOCS) -> list[tuple[int, ...]]:
    """All multisets of up to ``most`` length classes whose sizes add up to a full sequence."""
    found: list[tuple[int, ...]] = [(classes,)]
    for k in range(2, most + 1):
        for head in combinations_with_replacement(range(1, classes), k - 1):
            rest = classes - sum(head)
            if rest >= head[-1]:
                found.append((*head, rest))
    return found


def _real_lengths(pattern: tuple[int, ...], width: int, capacity: int, by_class: dict[int, list[int]], ready: list[int], left: dict[int, int]) -> tuple[int, ...]:
    """Lengths at hand for a pattern: the longest of each class, and last the one that fills up best."""
    taken: dict[int, int] = defaultdict(int)
    for c in pattern[:-1]:
        pick = next((x for x in reversed(by_class[c]) if left[x] > taken[x]), None)
        if pick is None:
            return ()
        taken[pick] += 1
    room = capacity - sum(x * k for x, k in taken.items())
    at = bisect.bisect_right(ready, room) - 1
    while at >= 0 and left[ready[at]] <= taken[ready[at]]:
        at -= 1
    if at < 0 or ready[at] <= (pattern[-1] - 1) * width:
        return ()
    taken[ready[at]] += 1
    return tuple(x for x, k in taken.items() for _ in range(k))


def _fit(histogram: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """(runs of patterns filled with real lengths, histogram of what is left)."""
    width = -(-capacity // CLASSES)
    left = dict(histogram)
    by_class: dict[int, list[int]] = defaultdict(list)
    for length in sorted(histogram):
        by_class[-(-length // width)].append(length)
    patterns = enumerate_patterns()
    wanted = np.zeros(CLASSES)
    for c, lengths in by_class.items():
        wanted[c - 1] = sum(histogram[x] for x in lengths)
    matrix = np.zeros((CLASSES, len(patterns)))
    for j, p in enumerate(patterns):
        for c in p:
            matrix[c - 1, j] += 1
    repeats = np.floor(nonnegative_least_squares(matrix, wanted) + 1e-6).astype(np.int64)
    runs: list[Run] = []
    ready = sorted(left)
    for j in np.argsort(-repeats, kind="stable"):
        todo = int(repeats[j])
        while todo > 0:
            lengths = _real_lengths(patterns[j], width, capacity, by_class, ready, left)
            if not lengths:
                break
            taken = Counter(lengths)
            n = min(todo, *(left[x] // k for x, k in taken.items()))
            for x, k in taken.items():
                left[x] -= n * k
                if not left[x]:
                    ready.pop(bisect.bisect_left(ready, x))
                    by_class[-(-x // width)].remove(x)
            runs.append((lengths, n))
            todo -= n
    return runs, {x: n for x, n in left.items() if n}


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs of equal sequences that hold exactly the lengths of ``histogram``."""
    runs, left = _fit(histogram, capacity)
    gaps: list[int] = []  # sorted gaps that are open, each with a stack of runs
    open_runs: dict[int, list[Run]] = {}

    def put(run: Run) -> None:
        gap = capacity - sum(run[0])
        if gap not in open_runs:
            bisect.insort(gaps, gap)
            open_runs[gap] = []
        open_runs[gap].append(run)

    for run in runs:
        put(run)
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                fits = capacity // length
                if todo >= fits:
                    put(((length,) * fits, todo // fits))
                    todo %= fits
                else:
                    put(((length,) * todo, 1))
                    todo = 0
                continue
            gap = gaps[at]
            lengths, count = open_runs[gap].pop()
            if not open_runs[gap]:
                del open_runs[gap]
                gaps.pop(at)
            n = min(count, todo)
            if n < count:
                put((lengths, count - n))
            put(((*lengths, length), n))
            todo -= n
    return [run for gap in gaps for run in open_runs[gap]]


def _layout(runs: list[Run]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank, first sequence and offset of each run, in order of the ranks."""
    used: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for lengths, count in runs:
        offset = 0
        for length in lengths:
            rows[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {k: tuple(np.array(v, np.int64).T) for k, v in rows.items()}


def _ranked(cut: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``cut`` with rank: a number from 0 within the pieces of each length."""
    # one row for each length, so at most as many as a sequence has tokens
    salts = cut.sparkSession.createDataFrame([(x, -(-n // RANK_ROWS)) for x, n in histogram.items()], "length long, salts long")
    salted = cut.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("row"), "salts")).drop("salts")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    return salted.withColumn("nth", F.row_number().over(within) - 1).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth"))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    ship_package(spark)
    # rows may repeat in every column, so they get numbers, which are fixed once they are written
    cut = stored(pieces(docs, vocabulary, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = spark.sparkContext.broadcast(_layout(plan(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                here = length == x
                first, start, at = layout.value[x]
                run = np.searchsorted(first, rank[here], "right") - 1
                sequence[here] = start[run] + rank[here] - first[run]
                offset[here] = at[run]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    ranked = _ranked(cut, histogram).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
