"""Near-duplicate grouping with circulant MinHash.

1. Sets.  A text's set holds the fingerprints of its distinct 5-word shingles; a shorter text is
   one shingle.  Texts with the same set form a class; only classes take part in what follows.
2. Signatures.  Two permutations of the 32-bit numbers make all coordinates: sigma is applied
   once, pi is shifted circularly by k for coordinate k, so coordinate k is the minimum of
   pi(sigma(x) + k).  Coordinates are banded; classes that share a band share a bucket.
3. Links.  In every bucket the hub is compared with the other members, never all pairs.  A bucket
   whose members are then in one component is done.  In the others the members outside the largest
   component (strays) meet all members of other components: in tasks that hold bounded parts of a
   bucket, on sketches, so that only near pairs become rows.  Where that would compare too much,
   further hubs are met first.  So each pair in a bucket is either compared or already in one
   component, and no link is lost once a bucket holds it.  Pairs need no full sets if they are too
   far apart by the lowest bits of all coordinates (by SIGMAS standard deviations) or by their
   sets' bitmaps, which bound the intersection exactly.  Verification compares full sets, pair by
   pair inside Arrow batches.
4. Components of the verified links give the groups.

A pair of similarity 0.85 shares no band with probability (1 - 0.85**6)**40 < 1e-8, one of 0.8
with probability < 1e-5, and either differs in too many bits with probability < 1e-11; hubs and
strays with hot buckets are spread by joins that split skewed keys, and buckets hold numbers only.

Edge cases: null text, empty text and text without words have an empty set, n_shingles 0, and are
a group of their own; rows that repeat a doc_id are rows of their own; a null doc_id never names a
component unless all its members are null; an empty table gives an empty result; other columns are
ignored.  Texts are handled in blocks of bounded size, a longer text in one of its own, so memory follows the
longest text, and a pair is verified on both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LOWER, SPACE_BREAKS, U64, blocks, byte_hashes, mix, text_buffer, word_shingles, words
from .common import discard, maybe_in, ship_package, stored, without
from .components import connected_components

ROWS_PER_BAND, BANDS = 6, 40
U32 = np.uint32
#: Further hubs are met while strays would be compared with more members than this, on average.
PASS_PAIRS = 4000
HUB_ROUNDS = 2
#: Members in a part of a large bucket, rows in a task on average, pairs compared at a time.
PART_ROWS, TASK_ROWS, COMPARED = 2048, 20_000, 1 << 18
#: A pair is verified unless its sketches differ in more bits than SIGMAS standard deviations allow.
SIGMAS = 7
#: Longs in the bitmap of a set; a bit that only one set has is a shingle that only it has.
BITMAP_LONGS = 16
SKETCH_LONGS = -(-ROWS_PER_BAND * BANDS // 64)


def permute(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of the 32-bit numbers."""
    x = x + U32(seed)
    x ^= x >> U32(16)
    x *= U32(0x7FEB352D)
    x ^= x >> U32(15)
    x *= U32(0x846CA68B)
    x ^= x >> U32(16)
    return x


def signatures(shingles: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """coordinates x sets: the circulant MinHash of the sets that begin at ``starts``."""
    out = np.empty((coordinates, len(starts)), U32)
    if not len(starts):
        return out
    first = permute((shingles & U64(0xFFFFFFFF)).astype(U32), 0x2545F491)
    for k in range(coordinates):
        out[k] = np.minimum.reduceat(permute(first, k), starts)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, ordered by row and value; row of each)."""
    low = LOWER[data]
    start, stop, row = words(low, offsets, SPACE_BREAKS)
    value, owner, _ = word_shingles(byte_hashes(low, start, stop), row)
    if not len(value):
        return value, owner
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
    parts = [np.unique(value[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return np.concatenate(parts), np.repeat(owner[cut[:-1]], [len(p) for p in parts])


def _set_keys(value: np.ndarray, starts: np.ndarray) -> list[bytes]:
    one = np.add.reduceat(mix(value), starts)
    two = np.add.reduceat(mix(value ^ U64(0x5851F42D4C957F2D)), starts)
    return [x.tobytes() for x in np.stack([one, two], axis=1)]


def sketches(sig: np.ndarray, value: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """sets x longs: the lowest bits of the coordinates, then the bitmap of the set."""
    sets = sig.shape[1]
    bits = np.zeros((sets, SKETCH_LONGS * 64), np.uint8)
    bits[:, : len(sig)] = (sig & sig.dtype.type(1)).T
    maps = np.zeros((sets, BITMAP_LONGS * 64), np.uint8)
    maps[owner, (value >> U64(40)).astype(np.int64) % (BITMAP_LONGS * 64)] = 1
    return np.packbits(np.concatenate([bits, maps], axis=1), axis=1, bitorder="little").view("<i8")


def described(docs: DataFrame) -> DataFrame:
    """doc_id, mark of the text, n_shingles, key of the set, bands and sketch (null for an empty set) of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_buffer(block.column("text"))
            value, owner = shingle_sets(data, offsets)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
            rows = owner[starts]
            sig = signatures(value, starts, ROWS_PER_BAND * BANDS).astype(U64)
            bands = np.zeros((len(starts), BANDS), U64)
            for b in range(BANDS):
                acc = np.full(len(starts), b + 1, U64)
                for k in range(b * ROWS_PER_BAND, (b + 1) * ROWS_PER_BAND):
                    acc = mix(acc * U64(0x9E3779B97F4A7C15) + sig[k])
                bands[:, b] = acc
            drawing_of = sketches(sig, value, np.searchsorted(rows, owner))
            n = np.bincount(owner, minlength=block.num_rows)
            keys: list[bytes | None] = [None] * block.num_rows
            made: list[np.ndarray | None] = [None] * block.num_rows
            drawn: list[np.ndarray | None] = [None] * block.num_rows
            for i, key, band, drawing in zip(rows.tolist(), _set_keys(value, starts) if len(starts) else [], bands.astype(np.int64), drawing_of, strict=True):
                keys[i], made[i], drawn[i] = key, band, drawing
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("mark"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(made, pa.list_(pa.int64())), pa.array(drawn, pa.list_(pa.int64()))],
                ["doc_id", "mark", "n_shingles", "key", "bands", "sketch"])

    ship_package(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) mark")
    return rows.mapInArrow(describe, "doc_id long, mark long, n_shingles long, key binary, bands array<long>, sketch array<long>")


def _verified(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= percent * union."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks([batch], "tv"):
                sides = []
                for name in ("tu", "tv"):
                    value, owner = shingle_sets(*text_buffer(block.column(name)))
                    at = np.searchsorted(owner, np.arange(block.num_rows + 1))
                    sides.append((value, at))
                (a, at_a), (b, at_b) = sides
                good = np.zeros(block.num_rows, bool)
                for i in range(block.num_rows):
                    x, y = a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]
                    both = len(x) + len(y) - len(np.union1d(x, y))
                    good[i] = 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in (block.column("u"), block.column("v"))], ["u", "v"])

    of_v = pairs.join(bodies.select(F.col("node").alias("v"), F.col("text").alias("tv")), "v")
    both = of_v.join(bodies.select(F.col("node").alias("u"), F.col("text").alias("tu")), "u")
    return both.select("u", "v", "tu", "tv").mapInArrow(verify, "u long, v long")


def _bodies(docs: DataFrame, classes: DataFrame, entries: DataFrame) -> DataFrame:
    """node, n, sketch, text of every class that shares a bucket; the text is that of one of its rows."""
    nodes = entries.select("node").distinct()
    wanted = stored(classes.join(nodes, "node", "left_semi").select("node", F.col("n_shingles").alias("n"), "sketch", F.col("row.doc_id").alias("id"), F.col("row.mark").alias("mark")), "wanted")
    rows = maybe_in(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("of")), "of", wanted.select("mark"))
    found = rows.join(wanted, (F.col("of") == F.col("mark")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # rows may repeat both doc_id and text
    out = stored(found.select("node", "n", "sketch", "text").dropDuplicates(["node"]), "bodies")
    discard(wanted)
    return out


def _limits(percent: int) -> int:
    """The most sketch bits in which a pair at ``percent`` may differ."""
    n, p = ROWS_PER_BAND * BANDS, (1 - percent / 100) / 2
    return int(n * p + SIGMAS * (n * p * (1 - p)) ** 0.5)


def _close(percent: int) -> str:
    """The condition that the pair (nu, su), (nv, sv) of set sizes and sketches may be similar.

    A sketch is the lowest bits of the coordinates followed by the bitmap of the set.
    """
    apart = " + ".join(f"bit_count(su[{i}] ^ sv[{i}])" for i in range(SKETCH_LONGS))
    places = range(SKETCH_LONGS, SKETCH_LONGS + BITMAP_LONGS)
    only_u, only_v = (" + ".join(f"bit_count({a}[{i}] & ~{b}[{i}])" for i in places) for a, b in (("su", "sv"), ("sv", "su")))
    both = f"least(nu - ({only_u}), nv - ({only_v}))"
    return f"least(nu, nv) * 100 >= greatest(nu, nv) * {percent} and {apart} <= {_limits(percent)} and {both} * {100 + percent} >= (nu + nv) * {percent}"


def close_pairs(u: np.ndarray, v: np.ndarray, n: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows (u, v) meet the condition of ``_close``."""
    nu, nv = n[u], n[v]
    good = np.flatnonzero(np.minimum(nu, nv) * 100 >= np.maximum(nu, nv) * percent)
    apart = np.zeros(len(good), np.int64)
    for i in range(SKETCH_LONGS):
        apart += np.bitwise_count(sketch[u[good], i] ^ sketch[v[good], i])
    good = good[apart <= _limits(percent)]
    only = np.zeros((2, len(good)), np.int64)
    for i in range(SKETCH_LONGS, SKETCH_LONGS + BITMAP_LONGS):
        a, b = sketch[u[good], i], sketch[v[good], i]
        only[0] += np.bitwise_count(a & ~b)
        only[1] += np.bitwise_count(b & ~a)
    both = np.minimum(n[u[good]] - only[0], n[v[good]] - only[1])
    out = np.zeros(len(u), bool)
    out[good] = both * (100 + percent) >= (n[u[good]] + n[v[good]]) * percent
    return out


def _near(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that may be similar, each once."""
    once = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    sides = [bodies.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in ("u", "v")]
    return once.join(sides[0], "u").join(sides[1], "v").filter(_close(percent)).select("u", "v")


def _met(members: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """Near pairs (u, v) of a stray and a member of another component of the same bucket, each once.

    ``members`` has bucket, node, component, main, all and strays (the bucket's counts).  A bucket
    of more than PART_ROWS members is cut into parts: each part of the members meets each part of
    the strays in a group of its own, so no group holds more than two parts.  Groups are dealt to
    tasks by a hash, and pairs are compared there on sketches, before any row is made of them.
    """

    def compare(rows: pa.Table) -> pa.Table:
        slot, node, component, n = (rows.column(c).to_numpy() for c in ("slot", "node", "component", "n"))
        table, probe, stray = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("table", "probe", "stray"))
        sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(len(node), -1).view(U64)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        begin, end = np.searchsorted(slot, slot, "left"), np.searchsorted(slot, slot, "right")
        asks = np.flatnonzero(probe[order])
        cost = np.cumsum(end[asks] - begin[asks])
        found, done = [np.zeros((0, 2), np.int64)], 0
        while done < len(asks):
            stop = max(done + 1, int(np.searchsorted(cost, (cost[done - 1] if done else 0) + COMPARED, "right")))
            mine = asks[done:stop]
            size = end[mine] - begin[mine]
            u = order[np.repeat(mine, size)]
            v = order[np.repeat(begin[mine] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())]
            # of two strays the larger one asks
            fits = table[v] & (component[u] != component[v]) & (~stray[v] | (node[v] < node[u]))
            u, v = u[fits], v[fits]
            near = close_pairs(u, v, n, sketch, percent)
            found.append(np.unique(np.stack([np.maximum(node[u[near]], node[v[near]]), np.minimum(node[u[near]], node[v[near]])], axis=1), axis=0))
            done = stop
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    parts, asked = (F.ceil(F.col(c) / PART_ROWS).cast("int") for c in ("all", "strays"))
    stray = F.col("component") != F.col("main")
    whole = (parts == 1) & (asked == 1)
    mine, my_ask = F.pmod(F.xxhash64("node"), parts), F.pmod(F.xxhash64("node", F.lit(1)), asked)
    cell = lambda part, ask, table, probe: F.struct(part.cast("long").alias("part"), ask.cast("long").alias("ask"), table.alias("table"), probe.alias("probe"))
    as_table = F.transform(F.sequence(F.lit(0), asked - 1), lambda a: cell(mine, a, F.lit(True), F.lit(False)))
    as_probe = F.when(stray, F.transform(F.sequence(F.lit(0), parts - 1), lambda p: cell(p, my_ask, F.lit(False), F.lit(True)))).otherwise(F.array())
    cells = F.when(whole, F.array(cell(F.lit(0), F.lit(0), F.lit(True), stray))).otherwise(F.concat(as_table, as_probe))
    dealt = members.select("bucket", "node", "component", stray.alias("stray"), F.explode(cells).alias("c"))
    slots = dealt.select(F.xxhash64("bucket", "c.part", "c.ask").alias("slot"), "node", "component", "stray", "c.table", "c.probe").join(bodies.select("node", "n", "sketch"), "node")
    groups = max(1, -(-members.count() // TASK_ROWS))
    schema = "u long, v long"
    return slots.withColumn("group", F.pmod(F.xxhash64("slot"), F.lit(groups))).groupBy("group").applyInArrow(compare, schema).distinct()


def _links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every class that is linked with another."""
    entry = classes.select("node", F.explode("bands").alias("bucket"))
    hubs = entry.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    entries = stored(entry.join(hubs, "bucket").select("bucket", "node", "hub"), "entries")
    bodies = _bodies(docs, classes, entries)
    links = stored(_verified(_near(entries.select(F.col("hub").alias("u"), F.col("node").alias("v")), bodies, percent), bodies, percent), "links")
    label = stored(connected_components(links), "label")
    discard(links)
    source = entries
    for turn in range(HUB_ROUNDS + 1):
        marked = stored(source.select("bucket", "node").join(label, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "marked")
        draw = F.xxhash64("node", F.lit(turn))
        by_part = marked.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"), F.min_by("node", draw).alias("hub"), F.min(draw).alias("draw"))
        total = by_part.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("size").alias("all"), F.max_by("component", "size").alias("main"), (F.sum("size") - F.max("size")).alias("strays"), F.min_by("hub", "draw").alias("hub"))
        # a bucket in one component stays so: only the others go on
        opened = stored(marked.join(total.filter("parts > 1").drop("parts"), "bucket"), "opened")
        work = opened.agg(F.sum(F.when(F.col("component") != F.col("main"), F.col("all"))).alias("compared"), F.count(F.lit(1)).alias("rows")).first()
        discard(marked)
        discard(source)
        source = opened
        if not work["rows"]:
            break
        last = turn == HUB_ROUNDS or work["compared"] <= PASS_PAIRS * work["rows"]
        if last:
            near = _met(opened, bodies, percent)
        else:
            near = _near(opened.filter("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")), bodies, percent)
        links = stored(_verified(near, bodies, percent), "links")
        label = _joined(label, links)
        discard(links)
        if last:
            break
    discard(source)
    discard(bodies)
    return label


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after more links: only the graph of the components that they join is searched."""
    side = lambda x: label.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    ends = links.join(side("u"), "u", "left").join(side("v"), "v", "left")
    pairs = stored(ends.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")), "joins")
    outer = stored(connected_components(pairs).select(F.col("node").alias("was"), F.col("component").alias("now")), "outer")
    old = label.join(outer, label["component"] == outer["was"], "left").select("node", F.coalesce("now", "component").alias("component"))
    new = outer.join(label.select("node"), outer["was"] == label["node"], "left_anti").select(F.col("was").alias("node"), F.col("now").alias("component"))
    out = stored(old.unionByName(new), "label")
    for spent in (pairs, outer, label):
        discard(spent)
    return out


def minhash_groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, component, mark of every row; linked at ``percent`` Jaccard."""
    rows = stored(described(docs), "sets")
    grouped = rows.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "mark")).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    label = _links(docs, classes, percent)
    named = classes.join(label, "node", "left").select("key", "least", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_key = named.join(least, "component").select("key", "component_id", "component")
    joined = rows.select("doc_id", "mark", "n_shingles", "key").join(of_key, "key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "component", "mark")


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near copies, and all without words.

    It is a row with the group's least doc_id; where several rows have it, one of them.
    """
    groups = stored(minhash_groups(docs, percent).select("doc_id", "mark", "n_shingles", "component", "kept"), "groups")
    worded = groups.filter("n_shingles > 0")
    rows = worded.groupBy("component", "doc_id", "mark").agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept"))
    first = worded.filter("kept").groupBy("component").agg(F.min(F.struct("mark", "doc_id")).alias("first"))
    judged = rows.join(first, "component", "left")
    stays = F.col("kept") & F.struct("mark", "doc_id").eqNullSafe(F.col("first"))
    odd = judged.select("doc_id", "mark", F.when(stays, F.col("copies")).otherwise(F.lit(0)).alias("copies")).filter("copies <> 1")
    return without(docs, F.xxhash64("text"), stored(odd, "dropped"))
