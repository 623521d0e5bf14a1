"""Exact deduplication against a history held in minimal perfect hash tables.

The distinct digests of the historical rows are dealt into shards of a bounded size.  Each shard
becomes a minimal perfect hash table: slot i holds one full 32-byte digest, the doc_id of its
current winner and the number of rows.  Incoming rows are first pre-aggregated by digest, so a
text that makes up a third of the input costs one lookup.  A lookup hashes to one slot and
compares all 32 bytes there: a match is a repeat of a historical text and updates that slot, a
mismatch proves that the digest is new, and such nonmembers form groups of their own.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty.  The row
with the largest doc_id stays.  Defined edge cases: a null doc_id never wins over a number, and a
group of null doc_ids only has keep_id null and keeps its rows; rows that repeat a doc_id and
text are counted, and all are marked alike (the stage form keeps one of them); an empty table
gives an empty result; other columns are ignored, whatever their names.  Only digests travel, so a very
long text is hashed where it lies and moves nowhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, ship_package, stored, without
from .blocks import U64, mix

#: Historical digests in one shard, on average.  One shard is what one task holds at a time.
SHARD_ROWS = 50_000
#: Groups with more than this share of the rows are joined by broadcast: fewer than 1/HOT_SHARE.
HOT_SHARE = 1 / 1000
_GAMMA = 2
_SLOTS = "shard long, levels array<int>, bits binary, digests binary, winners binary, has_winner binary, sizes binary"


def _level_hash(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    lanes = digests.view("<u8").reshape(-1, 4)
    return mix(lanes[:, 1] ^ mix(lanes[:, 2] + U64(level * 0x9E3779B97F4A7C15 % (1 << 64)))) % U64(size)


def build_slots(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits, slot of each digest) of a minimal perfect hash over distinct digests.

    Each level is a bit array; digests that are alone at their position set its bit and are done,
    the others go to the next level.  A slot number is the rank of the set bit.
    """
    sizes, bits, place = [], [], np.zeros(len(digests), np.int64)
    left, base = np.arange(len(digests)), 0
    while len(left):
        size = max(64, _GAMMA * len(left))
        at = _level_hash(digests[left], len(sizes), size).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        done = alone[at]
        place[left[done]] = base + at[done]
        bits.append(alone)
        sizes.append(size)
        base += size
        left = left[~done]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(flat) - 1
    return sizes, flat, rank[place] if len(digests) else place


def find_slots(sizes: list[int], bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The only slot that may hold each digest, or -1; the caller compares the bytes."""
    rank, slot = np.cumsum(bits) - 1, np.full(len(digests), -1, np.int64)
    left, base = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = _level_hash(digests[left], level, size).astype(np.int64) + base
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return slot


def _matrix(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, 32)


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(pdf["digest"])
    sizes, bits, slot = build_slots(digests)
    order = np.argsort(slot)
    winner = pdf["winner"]
    return pd.DataFrame({
        "shard": [key[0]], "levels": [sizes], "bits": [np.packbits(bits).tobytes()],
        "digests": [digests[order].tobytes()],
        "winners": [winner.fillna(0).to_numpy(np.int64)[order].tobytes()],
        "has_winner": [winner.notna().to_numpy()[order].tobytes()],
        "sizes": [pdf["size"].to_numpy(np.int64)[order].tobytes()],
    })


def _merge(key: tuple, new: pd.DataFrame, slots: pd.DataFrame) -> pd.DataFrame:
    frames = []
    digests = _matrix(new["digest"])
    member = np.zeros(len(new), bool)
    if len(slots):
        row = slots.iloc[0]
        sizes = list(row["levels"])
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sum(sizes))).astype(bool)
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        winners = np.frombuffer(row["winners"], np.int64).copy()
        known = np.frombuffer(row["has_winner"], bool).copy()
        count = np.frombuffer(row["sizes"], np.int64).copy()
        slot = find_slots(sizes, bits, digests)
        member = slot >= 0
        member[member] = (held[slot[member]] == digests[member]).all(axis=1)
        at, ids = slot[member], new["winner"][member]
        has = ids.notna().to_numpy()
        value = ids.fillna(0).to_numpy(np.int64)
        count[at] += new["size"][member].to_numpy(np.int64)
        better = has & (~known[at] | (value > winners[at]))
        winners[at[better]] = value[better]
        known[at[better]] = True
        frames.append(pd.DataFrame({"digest": [x.tobytes() for x in held], "keep_id": pd.array(winners, dtype="Int64"), "group_size": count, "historical": True}))
        frames[-1].loc[~known, "keep_id"] = pd.NA
    rest = new[~member]
    frames.append(pd.DataFrame({"digest": rest["digest"], "keep_id": rest["winner"].astype("Int64"), "group_size": rest["size"].astype("int64"), "historical": False}))
    return pd.concat(frames, ignore_index=True)


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))


def build_history(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the digests of ``history`` (doc_id, digest): its slot table."""
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards))
    return _groups(history).withColumn("shard", shard).groupBy("shard").applyInPandas(_build, _SLOTS)


def merge_incoming(incoming: DataFrame, slots: DataFrame, shards: int) -> DataFrame:
    """digest, keep_id, group_size, historical of all texts after looking up ``incoming``."""
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards))
    left = _groups(incoming).withColumn("shard", shard).groupBy("shard")
    return left.cogroup(slots.groupBy("shard")).applyInPandas(_merge, "digest binary, keep_id long, group_size long, historical boolean")


def _normal(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def with_groups(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Join the group of each row; the few groups that hold most rows never meet in one task."""
    hot = groups.filter(F.col("group_size") > F.lit(max(1, int(total * HOT_SHARE))))
    cold = groups.filter(F.col("group_size") <= F.lit(max(1, int(total * HOT_SHARE))))
    marked = rows.join(F.broadcast(hot), "digest", "left")
    of_hot = marked.filter(F.col("keep_id").isNotNull() | F.col("group_size").isNotNull())
    of_cold = marked.filter(F.col("group_size").isNull()).select("doc_id", "digest").join(cold, "digest")
    return of_hot.select("doc_id", "digest", "keep_id", "group_size", "historical").unionByName(
        of_cold.select("doc_id", "digest", "keep_id", "group_size", "historical"))


def exact_dedup(docs: DataFrame, is_history: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, historical: one row per row of ``docs``.

    ``is_history`` marks the rows that make up the history (by default half of them, by a hash of
    the doc_id); the result does not depend on it, apart from the column historical.
    """
    ship_package(docs.sparkSession)
    if is_history is None:
        is_history = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    old = F.coalesce(is_history, F.lit(False)).alias("old")
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(_normal(F.col("text")).cast("binary"), 256)).alias("digest"), old), "digests")
    total = rows.count()
    shards = max(1, -(-total // SHARD_ROWS))
    slots = stored(build_history(rows.filter("old"), shards), "slots")
    groups = stored(merge_incoming(rows.filter("not old"), slots, shards), "groups")
    return with_groups(rows.select("doc_id", "digest"), groups, total).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "historical")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the largest doc_id.

    Of rows that repeat both doc_id and text, one stays.
    """
    rows = exact_dedup(docs).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    copies = F.when(F.col("kept"), F.col("n")).otherwise(F.lit(0))
    odd = rows.select("doc_id", F.col("text_sha256").alias("mark"), copies.alias("copies")).filter("copies <> 1")
    return without(docs, F.sha2(_normal(F.col("text")).cast("binary"), 256), stored(odd, "dropped"))
