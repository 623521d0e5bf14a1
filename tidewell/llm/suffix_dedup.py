"""Removal of repeated 200-byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered by most-significant-digit passes and only through ``DEPTH`` bytes: a pass
groups the suffixes that are still tied by their next digit, and a suffix alone in its group leaves.
The groups left at full depth are exactly the repeated windows.

So that the passes move less than the input, suffixes travel in runs.  Every window of DEPTH bytes
has an anchor, the place of the least fingerprint of ANCHOR bytes in it, which is the same in equal
windows.  Neighbouring windows with one anchor form a run, about one run in 85 bytes.

1. The first digit is the anchor's fingerprint: runs whose anchor stands nowhere else leave.
2. The next is the whole stretch of a run: where that repeats, all windows of the run repeat.
   Of equal stretches one goes on as the partner of others.
3. Runs that are still tied bring their bytes.  Buckets of bounded groups sort their windows by
   DIGIT bytes a pass.  A group of more than GROUP_ROWS runs (a passage that a large part of the
   corpus holds) is first split by Spark: the windows of each run are halved by their distance to
   the anchor, and the bytes that all windows of a half share are the next digit.  Equal halves
   merge as in 2, so each pass holds at most two rows a run.

Digits are compared by 64-bit fingerprints, in step 3 by one for each DIGIT bytes.  Matches never
cross rows.  Edge cases: null counts as empty; texts under DEPTH bytes lose nothing; rows that
repeat a doc_id, and repeated rows, each count as a text of their own and each get their row; an
empty table gives an empty result; other columns are ignored.  Texts may have up to 2**31 - 1 bytes,
as Spark's strings; a block of texts is held as several 8-byte arrays a byte, so a task needs memory
for the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, blocks, mix, prefix_hashes, span_hashes, text_buffer
from .common import ship_package, stored

DEPTH, ANCHOR, DIGIT = 200, 32, 40
#: Runs with one anchor that a bucket may hold, and runs in a bucket on average.
GROUP_ROWS, BUCKET_ROWS = 2000, 10_000
#: Distances to the anchor are below this power of two.
REACH = 256
#: Bytes of text whose runs are matched before the first shuffle.
MARK_BYTES = 1 << 20
#: A text of Spark holds fewer than 2**31 bytes.
_PLACE_BITS = 31
_RUN = "doc_id long, k long, start int, stop int, at int"


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if width > have else v


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first start, last start, anchor, fingerprint of anchor, of stretch) of all runs."""
    none = np.zeros(0, np.int64)
    if len(data) < DEPTH:
        return none, none, none, none, none.astype(U64), none.astype(U64)
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - ANCHOR + 1)
    gram = span_hashes(prefix, at, at + ANCHOR)
    order = (gram & ~U64((1 << _PLACE_BITS) - 1)) | at.astype(U64)
    place = (_least(order, DEPTH - ANCHOR + 1) & U64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    fits = np.zeros(len(data) + 1, np.int64)
    size = np.diff(offsets)
    whole = size >= DEPTH
    np.add.at(fits, offsets[:-1][whole], 1)
    np.add.at(fits, offsets[1:][whole] - DEPTH + 1, -1)
    start = np.flatnonzero(np.cumsum(fits)[: len(place)] > 0)
    if not len(start):
        return none, none, none, none, none.astype(U64), none.astype(U64)
    anchor = place[start]
    fresh = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    first, last = start[fresh], start[np.r_[fresh[1:], len(start)] - 1]
    row = np.searchsorted(offsets, first, "right") - 1
    return row, first, last, anchor[fresh], gram[anchor[fresh]], span_hashes(prefix, first, last + DEPTH)


def merged(start: np.ndarray, stop: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, stop) of the maximal spans of each owner; touching spans merge."""
    order = np.lexsort((start, owner))
    start, stop, owner = start[order], stop[order], owner[order]
    if not len(start):
        return owner, start, stop
    step = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + owner * step)
    fresh = np.r_[True, start[1:] + owner[1:] * step > reach[:-1]]
    head = np.flatnonzero(fresh)
    return owner[head], start[head], reach[np.r_[head[1:], len(start)] - 1] - owner[head] * step


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a block; those that repeat within it become spans and leave one partner."""
    for block in blocks(batches, limit=MARK_BYTES):
        data, offsets = text_buffer(block.column("text"))
        row, first, last, anchor, gram, whole = runs(data, offsets)
        _, lead, back, n = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
        again = n[back] > 1
        owner, a, b = merged(first[again], last[again] + DEPTH, row[again])
        rows = np.r_[owner, row[lead]]
        begin = offsets[:-1][rows]
        empty = np.r_[np.ones(len(owner), bool), np.zeros(len(lead), bool)]
        fill = np.zeros(len(owner), U64)
        yield pa.RecordBatch.from_arrays([
            block.column("doc_id").take(pa.array(rows)), block.column("k").take(pa.array(rows)),
            pa.array((np.r_[a, first[lead]] - begin).astype(np.int32)), pa.array((np.r_[b, last[lead] + DEPTH] - begin).astype(np.int32)),
            pa.array(np.r_[fill.astype(np.int64), anchor[lead] - first[lead]].astype(np.int32)),
            pa.array(np.r_[fill, gram[lead]].astype(np.int64), mask=empty), pa.array(np.r_[fill, whole[lead]].astype(np.int64)), pa.array(np.r_[np.zeros(len(owner), bool), n > 1]),
        ], ["doc_id", "k", "start", "stop", "at", "key", "whole", "many"])


def _digit_pass(tied: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """(spans of runs whose whole stretch repeats, one run of each stretch that is still tied).

    ``tied`` has key (all digits so far), whole, many and the columns of a run.
    """
    kept = ["doc_id", "k", "start", "stop", "at", *carried]
    stretch = stored(tied.groupBy("key", "whole").agg(
        ((F.count(F.lit(1)) > 1) | F.bool_or("many")).alias("full"), *(F.first(c).alias(c) for c in kept)), "stretch")
    full = stretch.filter("full").select("key", "whole")
    spans = tied.join(full, ["key", "whole"], "left_semi").select("doc_id", "k", "start", "stop")
    group = stretch.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.bool_and("full").alias("done")).filter("members > 1 and not done").drop("done")
    return spans, stretch.drop("whole").join(group, "key")


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each wanted run of a text, with its bytes."""
    for block in blocks(batches):
        texts = block.column("text").cast(pa.binary()).to_pylist()
        want = block.column("runs")
        flat = want.flatten()
        row = np.repeat(np.arange(block.num_rows), want.value_lengths().to_numpy())
        start, stop = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
        body = [texts[r][a:b] for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)]
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id").take(at), block.column("k").take(at), *(flat.field(c) for c in ("start", "stop", "at", "key", "full", "members")), pa.array(body, pa.binary())],
            ["doc_id", "k", "start", "stop", "at", "key", "full", "members", "body"])


def _joined(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = body.to_pylist()
    return np.frombuffer(b"".join(parts), np.uint8), np.r_[0, np.cumsum([len(x) for x in parts], dtype=np.int64)]


def repeated_windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The starts of all windows of DEPTH bytes that stand twice or more; rows hold DEPTH bytes at least."""
    n = np.diff(offsets) - DEPTH + 1
    start = np.repeat(offsets[:-1] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    prefix = prefix_hashes(data)
    group = np.zeros(len(start), np.int64)
    for at in range(0, DEPTH, DIGIT):
        digit = span_hashes(prefix, start + at, start + at + DIGIT)
        order = np.lexsort((digit, group))
        start, group, digit = start[order], group[order], digit[order]
        fresh = np.r_[True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])] if len(start) else np.zeros(0, bool)
        name = np.cumsum(fresh) - 1
        tied = np.bincount(name)[name] > 1 if len(start) else fresh
        start, group = start[tied], name[tied]
    return start


def _sorted_bucket(rows: pa.Table) -> pa.Table:
    """The spans of the runs of a bucket that are covered by repeated windows."""
    data, offsets = _joined(rows.column("body").combine_chunks())
    found = repeated_windows(data, offsets)
    row = np.searchsorted(offsets, found, "right") - 1
    live = ~rows.column("full").to_numpy()[row]
    row, found = row[live], found[live]
    begin = rows.column("start").to_numpy()[row] + found - offsets[:-1][row]
    owner, a, b = merged(begin, begin + DEPTH, row)
    at = pa.array(owner)
    return pa.table({"doc_id": rows.column("doc_id").take(at), "k": rows.column("k").take(at), "start": pa.array(a.astype(np.int32)), "stop": pa.array(b.astype(np.int32))})


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run cut into its windows near the anchor and those far from it, with the next digit."""
    for batch in batches:
        for block in blocks([batch], "body"):
            data, offsets = _joined(block.column("body"))
            prefix = prefix_hashes(data)
            at, low, high, key, start = (block.column(c).to_numpy() for c in ("at", "low", "high", "key", "start"))
            windows = np.diff(offsets) - DEPTH + 1
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle + 1, high)):
                i, j = np.maximum(0, at - b), np.minimum(windows - 1, at - a)
                ok = np.flatnonzero((i <= j) & (a <= b))
                i, j, lo, hi = i[ok], j[ok], a[ok], b[ok]
                anchor = offsets[:-1][ok] + at[ok]
                core = span_hashes(prefix, anchor - lo, anchor - hi + DEPTH)
                begin, end = offsets[:-1][ok] + i, offsets[:-1][ok] + j + DEPTH
                raw, pick = data.tobytes(), pa.array(ok)
                yield pa.RecordBatch.from_arrays([
                    block.column("doc_id").take(pick), block.column("k").take(pick),
                    pa.array((start[ok] + i).astype(np.int32)), pa.array((start[ok] + j + DEPTH).astype(np.int32)), pa.array((at[ok] - i).astype(np.int32)),
                    pa.array(mix(key[ok].astype(U64) ^ mix(core + lo.astype(U64))).astype(np.int64)), pa.array(span_hashes(prefix, begin, end).astype(np.int64)), block.column("full").take(pick),
                    pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array([raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                ], ["doc_id", "k", "start", "stop", "at", "key", "whole", "many", "low", "high", "body"])


def repeated_spans(rows: DataFrame) -> DataFrame:
    """doc_id, k, start, stop of spans that cover every repeated window of ``rows`` (doc_id, k, text)."""
    marks = stored(rows.mapInArrow(_marks, f"{_RUN}, key long, whole long, many boolean"), "marks")
    runs_of = marks.filter("key is not null")
    met = runs_of.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("many").alias("any")).filter("n > 1 or any").select("key")
    spans, tied = _digit_pass(stored(runs_of.join(met, "key"), "tied"))
    found = [marks.filter("key is null").select("doc_id", "k", "start", "stop"), spans]
    wanted = tied.groupBy("doc_id", "k").agg(F.collect_list(F.struct("start", "stop", "at", "key", "full", "members")).alias("runs"))
    texts = rows.join(wanted.select(F.col("doc_id").alias("_id"), F.col("k").alias("_k"), "runs"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")))
    left = stored(texts.select("doc_id", "k", "text", "runs").mapInArrow(_bodies, f"{_RUN}, key long, full boolean, members long, body binary"), "bodies")
    small = [left.filter(F.col("members") <= GROUP_ROWS)]
    large = left.filter(F.col("members") > GROUP_ROWS).withColumns({"low": F.lit(0), "high": F.lit(REACH - 1)})
    while not large.isEmpty():
        halves = stored(large.mapInArrow(_halves, f"{_RUN}, key long, whole long, many boolean, low int, high int, body binary"), "halves")
        spans, tied = _digit_pass(halves, "low", "high", "body")
        found.append(spans)
        tied = stored(tied, "tied")
        small.append(tied.filter(F.col("members") <= GROUP_ROWS).select(*left.columns))
        large = tied.filter(F.col("members") > GROUP_ROWS)
    bucketed = reduce(DataFrame.unionByName, small)
    buckets = max(1, -(-bucketed.count() // BUCKET_ROWS))
    sorted_ = bucketed.select("doc_id", "k", "start", "full", "body", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).groupBy("bucket").applyInArrow(_sorted_bucket, "doc_id long, k long, start int, stop int")
    return reduce(DataFrame.unionByName, [*found, sorted_])


def with_removed(docs: DataFrame) -> DataFrame:
    """doc_id, text, spans: every row and the sorted maximal spans of bytes to remove."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("k", F.xxhash64("text"))
    spans = repeated_spans(rows).groupBy(F.col("doc_id").alias("_id"), F.col("k").alias("_k")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left").select("doc_id", "text", "spans")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").cast(pa.binary()).to_pylist()
            spans = block.column("spans")
            flat = spans.flatten()
            owner = np.repeat(np.arange(block.num_rows), np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            row, start, stop = merged(flat.field("start").to_numpy().astype(np.int64), flat.field("stop").to_numpy().astype(np.int64), owner)
            for i in np.unique(row).tolist():
                mine = slice(*np.searchsorted(row, [i, i + 1]))
                edges = [0, *np.stack([start[mine], stop[mine]], axis=1).ravel().tolist(), len(texts[i])]
                texts[i] = b"".join(texts[i][a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            size = block.column("n_bytes").to_numpy()
            left = np.array([len(x) for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id"), block.column("n_bytes"), pa.array(size - left), pa.array(np.bincount(row, minlength=block.num_rows).astype(np.int64)),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts]), pa.array(texts, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    marked = with_removed(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return marked.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
