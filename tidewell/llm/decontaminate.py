"""Benchmark decontamination with SimHash windows and multi-index Hamming search.

A document is compared with a benchmark item through its windows of as many words as the item
has.  Similarity is the weighted Jaccard similarity of 5-word shingles: the sum of the smaller
counts over the sum of the larger ones, at least ``SIMILARITY``.  A window without any shingle of
an item has similarity 0 with it, so only windows around shared shingles get a fingerprint: the
64-bit SimHash of the window's words.

Fingerprints of items are indexed in ``PARTS`` parts of 16 bits, each under all values within
RADIUS // PARTS bits.  Two fingerprints within RADIUS bits agree within RADIUS // PARTS bits in at
least one part, so a lookup of the four parts returns every item within the radius.  Candidates
are verified on the exact shingle counts.

The benchmark is read in blocks of at most ITEM_BLOCK items and BYTE_BLOCK bytes (or one longer item), and ROUND_BLOCKS
blocks are broadcast to one pass over the documents; see ``matches``.  Windows are verified one by
one inside Arrow batches.

Words are runs of digits, ASCII letters and non-ASCII characters after lower-casing A-Z, so
punctuation and line breaks do not hide a passage.  Edge cases: a document shorter than the item
is one window; an item with fewer than five words is one shingle; items without words or with a
null id are ignored; null and empty texts are clean; repeated rows each get their row; other
columns are ignored; an empty benchmark leaves every document clean; an empty table of documents
gives an empty result; a null doc_id is carried through; of windows that fit an item equally well the first one
counts, and of items that fit equally well the one whose window starts first.  A very long text is one block of its
own, so memory follows the longest text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ALNUM_BREAKS, LOWER, U64, blocks, byte_hashes, text_buffer, word_shingles, words
from .common import ship_package, stored, without

SIMILARITY = 0.8
SHINGLE = 5
PARTS, PART_BITS, RADIUS = 4, 16, 15
ITEM_BLOCK, BYTE_BLOCK, ROUND_BLOCKS = 2000, 4_000_000, 4


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, row) of the words of a block."""
    low = LOWER[data]
    start, stop, row = words(low, offsets, ALNUM_BREAKS)
    return byte_hashes(low, start, stop), row


def simhash(windows: np.ndarray) -> np.ndarray:
    """Fingerprint of each row of word hashes: bit b is what most words have there."""
    out = np.zeros(len(windows), U64)
    half = windows.shape[1] / 2
    for b in range(64):
        out |= (((windows >> U64(b)) & U64(1)).sum(axis=1) > half).astype(U64) << U64(b)
    return out


def similarity(window: Counter, item: Counter) -> float:
    both = sum(min(n, item[x]) for x, n in window.items() if x in item)
    return both / (window.total() + item.total() - both)


class ItemIndex:
    """Items of one block: shingle counts, fingerprints and the multi-index table."""

    def __init__(self, items: list[tuple[int, str]]):
        data, offsets = text_buffer(pa.array([t for _, t in items], pa.string()))
        word, row = word_hashes(data, offsets)
        self.ids = np.array([i for i, _ in items], np.int64)
        self.length = np.bincount(row, minlength=len(items))
        value, owner, _ = word_shingles(word, row, SHINGLE)
        at = np.searchsorted(owner, np.arange(len(items) + 1))
        self.counts = [Counter(value[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
        first = np.searchsorted(row, np.arange(len(items)))
        self.prints = np.array([simhash(word[None, f : f + n])[0] if n else 0 for f, n in zip(first, self.length, strict=True)], U64)
        pair = np.unique(np.stack([value, owner.astype(U64)], axis=1), axis=0) if len(value) else np.zeros((0, 2), U64)
        self.shingle, begin = np.unique(pair[:, 0], return_index=True)
        self.begin = np.r_[begin, len(pair)]
        self.item = pair[:, 1].astype(np.int64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.shingle >> U64(44)).astype(np.int64)] = True
        self.short = sorted(set(self.length[self.length < SHINGLE].tolist()) - {0})
        flips = [0]
        for k in range(1, RADIUS // PARTS + 1):
            flips += [sum(1 << b for b in c) for c in combinations(range(PART_BITS), k)]
        self.near = []
        for p in range(PARTS):
            part = (self.prints >> U64(p * PART_BITS)).astype(np.int64) & 0xFFFF
            value = (part[:, None] ^ np.array(flips)).ravel()
            name = np.repeat(np.arange(len(items)), len(flips))
            order = np.argsort(value, kind="stable")
            self.near.append((np.searchsorted(value[order], np.arange((1 << PART_BITS) + 1)), name[order]))

    def hits(self, word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, shingle of the benchmark) wherever one stands in the documents."""
        found = [word_shingles(word, row, SHINGLE, short=False)]
        for n in self.short:
            # windows of n words, each hashed as a text of its own
            at = np.flatnonzero(row[: max(0, len(row) - n + 1)] == row[n - 1 :]) if len(row) >= n else np.zeros(0, np.int64)
            value, owner, _ = word_shingles(word[(at[:, None] + np.arange(n)).ravel()], np.repeat(np.arange(len(at)), n), SHINGLE)
            found.append((value, owner, at))
        places, names = [], []
        for value, _, at in found:
            maybe = np.flatnonzero(self.sieve[(value >> U64(44)).astype(np.int64)])
            name = np.minimum(np.searchsorted(self.shingle, value[maybe]), max(0, len(self.shingle) - 1))
            real = self.shingle[name] == value[maybe] if len(self.shingle) else np.zeros(len(maybe), bool)
            places.append(at[maybe[real]])
            names.append(name[real])
        return np.concatenate(places), np.concatenate(names)

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) pairs of all items within RADIUS bits."""
        pairs = []
        for p, (begin, name) in enumerate(self.near):
            value = (prints >> U64(p * PART_BITS)).astype(np.int64) & 0xFFFF
            n = begin[value + 1] - begin[value]
            who = np.repeat(np.arange(len(prints)), n)
            flat = np.repeat(begin[value] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            item = name[flat]
            close = np.bitwise_count(prints[who] ^ self.prints[item]) <= RADIUS
            pairs.append(who[close] * len(self.ids) + item[close])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.ids), both % len(self.ids)

    def match(self, data: np.ndarray, offsets: np.ndarray) -> list[dict[int, tuple[float, int]]]:
        """For each row the similarity and first word of the best window of every similar item."""
        rows = len(offsets) - 1
        found: list[dict[int, tuple[float, int]]] = [{} for _ in range(rows)]
        word, row = word_hashes(data, offsets)
        place, name = self.hits(word, row)
        if not len(place):
            return found
        first = np.searchsorted(row, np.arange(rows))
        size = np.bincount(row, minlength=rows)
        n = self.begin[name + 1] - self.begin[name]
        place = np.repeat(place, n)
        item = self.item[np.repeat(self.begin[name] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        length, owner = self.length[item], row[place]
        wide = np.minimum(length, size[owner])
        low = np.maximum(place - np.maximum(wide - SHINGLE, 0), first[owner])
        high = np.minimum(place, first[owner] + size[owner] - wide)
        for w, whole in sorted(set(zip(wide.tolist(), length.tolist(), strict=True))):
            mine = (wide == w) & (length == whole) & (low <= high)
            steps = np.bincount(low[mine], minlength=len(word) + 1) - np.bincount(high[mine] + 1, minlength=len(word) + 1)[: len(word) + 1]
            starts = np.flatnonzero(np.cumsum(steps) > 0)
            for at in range(0, len(starts), 2048):
                part = starts[at : at + 2048]
                who, which = self.within_radius(simhash(word[part[:, None] + np.arange(w)]))
                fits = self.length[which] == whole
                for s, i in zip(part[who[fits]].tolist(), which[fits].tolist(), strict=True):
                    value, _, _ = word_shingles(word[s : s + w], np.zeros(w, np.int64), SHINGLE)
                    score = similarity(Counter(value.tolist()), self.counts[i])
                    r = int(row[s])
                    if score >= SIMILARITY and score > found[r].get(i, (0.0, 0))[0]:
                        found[r][i] = score, s - int(first[r])
        return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Blocks of (item_id, text) within the documented bounds; one partition at a time is fetched."""
    block: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null").toLocalIterator():
        n = len(r["text"].encode())
        if block and (len(block) == ITEM_BLOCK or size + n > BYTE_BLOCK):
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text), item_id, similarity, word of the best window of every leaked item.

    The benchmark is a stated set of queries, taken in rounds of ROUND_BLOCKS blocks.  A round is one
    pass over the documents with its blocks broadcast, and only what it found is kept, so neither
    the driver nor a task ever holds more of the benchmark than one round of it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    schema = "doc_id long, mark long, item_id long, similarity double, word long"
    found, waiting = [], item_blocks(benchmark)
    while held := [spark.sparkContext.broadcast(ItemIndex(items)) for items in islice(waiting, ROUND_BLOCKS)]:

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches):
                data, offsets = text_buffer(block.column("text"))
                out = []
                for shared in held:
                    index = shared.value
                    out += [(r, int(index.ids[i]), s, w) for r, new in enumerate(index.match(data, offsets)) for i, (s, w) in new.items()]
                at = pa.array([x[0] for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id").take(at), block.column("mark").take(at), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64()), pa.array([x[3] for x in out], pa.int64())],
                    ["doc_id", "mark", "item_id", "similarity", "word"])

        found.append(stored(rows.mapInArrow(search, schema), "leaks"))
        for shared in held:
            shared.destroy()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, similarity, first_word of every row.

    item_ids is sorted and comma-joined; similarity and first_word belong to the best match.
    """
    found = matches(docs, benchmark).groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("of")).agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"), F.max(F.struct(F.col("similarity").alias("s"), (-F.col("word")).alias("w"))).alias("best"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")), "left")
    return joined.select(
        "doc_id", F.col("ids").isNotNull().alias("contaminated"), F.coalesce(F.when(F.col("ids").isNotNull(), F.size("ids")), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"), F.coalesce("best.s", F.lit(0.0)).alias("similarity"), (-F.col("best.w")).alias("first_word"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item."""
    leaks = matches(docs, benchmark).select("doc_id", "mark").distinct().withColumn("copies", F.lit(0))
    return without(docs, F.xxhash64("text"), stored(leaks, "dropped"))
