"""Latest event per key, pivot of attribute rows, expansion of embedded JSON, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EavSpec, JsonSpec, TableSpec
from ..functions.blob import decode_blobs
from ..functions.cast import event_date, lenient_cast
from .envelope import MUTATION, TOMBSTONE


def latest_wins(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, descending.  Ties end with the last column named."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))
    return events.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")


def by_whole_key(spec: TableSpec) -> bool:
    """Whether a tombstone always names one row, so that it can meet the row's mutations."""
    return isinstance(spec, EavSpec) or set(spec.delete_keys) == {c for c, _ in spec.keys}


def key_changes(routed: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key of a batch: what it upserts (``live``) and ``deleted_at`` of its tombstones.

    One grouping finds the latest mutation of a key (for EAV of each of its attributes, which become
    columns with presence flags) and its latest tombstone, so the events are shuffled once.  Ties on
    ts_ms go to the larger hash of the line, then to the larger value.  A null value whose flag is
    set is an attribute delete.  Blobs are decoded after the winners are known.  With ordering
    event_time what is not newer than the key's tombstone is no mutation.
    """
    events = routed.filter(F.col("route").isin(MUTATION, TOMBSTONE))
    mutation = F.col("route") == MUTATION
    deleted = F.max(F.when(~mutation, F.col("ts_ms"))).alias("deleted_at")
    late = lambda ts: F.lit(True) if spec.ordering != "event_time" else F.col("deleted_at").isNull() | (ts > F.col("deleted_at"))
    names = [c for c, _ in spec.keys]
    if isinstance(spec, EavSpec):
        latest = [F.max(F.when(mutation & (F.col("column2") == name), F.struct("ts_ms", "__tie", "blob"))).alias(f"__v{i}") for i, (name, _, _) in enumerate(spec.attributes)]
        newest = F.max(F.when(mutation, F.col("ts_ms"))).alias("event_timestamp")
        wide = events.groupBy(F.col("entity_key").alias(names[0])).agg(newest, deleted, *latest)
        there = [F.coalesce(F.col(f"__v{i}").isNotNull() & late(F.col(f"__v{i}.ts_ms")), F.lit(False)) for i in range(len(spec.attributes))]
        live = (F.col("event_timestamp").isNotNull() & late(F.col("event_timestamp"))).alias("live")
        blobs = wide.select(
            *names, "event_timestamp", "deleted_at", live,
            *(F.when(t, F.col(f"__v{i}.blob")).alias(f"__b{i}") for i, t in enumerate(there)),
            *(t.cast("int").alias(f"has_{col}") for (_, col, _), t in zip(spec.attributes, there, strict=True)))
        rows = decode_blobs(blobs, {f"__b{i}": (col, kind) for i, (_, col, kind) in enumerate(spec.attributes)})
        return enrich(rows, spec)
    return _shaped(_row_changes(routed, spec), spec, "deleted_at", "live")


def _row_changes(routed: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key of a batch: its latest mutation's cells, event_timestamp, deleted_at and whether it is ``live``."""
    names = [c for c, _ in spec.keys]
    mutation = F.col("route") == MUTATION
    rest = [c for c in routed.columns if c not in (*names, "json_str", "op", "route", "ts_ms", "__tie")]
    grouped = routed.filter(F.col("route").isin(MUTATION, TOMBSTONE)).groupBy(*names).agg(
        F.max(F.when(~mutation, F.col("ts_ms"))).alias("deleted_at"), F.max(F.when(mutation, F.struct("ts_ms", "__tie", *rest))).alias("__v"))
    ts = F.col("__v.ts_ms")
    late = F.lit(True) if spec.ordering != "event_time" else F.col("deleted_at").isNull() | (ts > F.col("deleted_at"))
    return grouped.select(*names, ts.alias("event_timestamp"), "deleted_at", (F.col("__v").isNotNull() & late).alias("live"), *(F.col(f"__v.{c}").alias(c) for c in rest))


def _shaped(changes: DataFrame, spec: TableSpec, *carried: str) -> DataFrame:
    """Enriched rows of ``_row_changes``."""
    rows = expand_json(changes, spec, "event_timestamp", *carried) if isinstance(spec, JsonSpec) else changes
    return enrich(rows, spec)


def prefix_changes(routed: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(upserts, tombstones) of a batch whose tombstones name prefixes of keys, from one grouping by the keys.

    Each part's filter names what the other part needs of the grouping (and is true of all its rows), so
    that column pruning leaves both with the same shuffle and Spark makes it once.
    """
    changes = _row_changes(routed, spec)
    least = F.lit(-(1 << 63))
    stones = changes.filter(~F.col("live") | F.col("deleted_at").isNotNull()).select(*(c for c, _ in spec.keys), "deleted_at")
    live = changes.filter(F.col("live") & (F.col("deleted_at").isNull() | (F.col("deleted_at") >= least))).drop("live", "deleted_at")
    return _shaped(live, spec), stones


def expand_json(events: DataFrame, spec: JsonSpec, *carried: str) -> DataFrame:
    """The configured keys of the embedded JSON texts as typed columns, and ``carried``; each text is parsed once."""
    parsed = {}
    for source in dict.fromkeys(s for s, *_ in spec.json_columns):
        fields = ", ".join(f"`{key}` string" for s, key, *_ in spec.json_columns if s == source)
        parsed[source] = F.from_json(F.col(f"__json_{source}"), fields)
    held = events
    for source, text in parsed.items():
        held = held.select("*", F.explode(F.array(text)).alias(f"__parsed_{source}"))
    metrics = [lenient_cast(F.col(f"__parsed_{s}").getField(key), kind).alias(col) for s, key, col, kind in spec.json_columns]
    return held.select(*(c for c, _ in spec.keys), *carried, *metrics)


def event_id(spec: TableSpec) -> Column:
    if spec.event_ids == "uuid":
        return F.expr("uuid()")
    parts = [F.lit(spec.name), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c, _ in spec.keys), F.col("event_timestamp").cast("string")]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def enrich(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` (with event_timestamp) with event_id, event_date and, for EAV, deduptime."""
    made = {"event_id": event_id(spec), "event_date": event_date(F.col("event_timestamp"))}
    if spec.dedup_time:
        made["deduptime"] = F.col("event_timestamp")
    return rows.withColumns(made)


def upserts(mutations: DataFrame, spec: TableSpec) -> DataFrame:
    """One enriched row per key of the mutations of a batch."""
    if by_whole_key(spec):
        return key_changes(mutations, spec).filter("live").drop("live", "deleted_at")
    latest = latest_wins(mutations, list(spec.merge_key), ["ts_ms", "__tie"])
    if isinstance(spec, JsonSpec):
        latest = expand_json(latest, spec, "ts_ms")
    return enrich(latest.withColumnRenamed("ts_ms", "event_timestamp").drop("json_str", "op", "route", "__tie"), spec)


def tombstones(deletes: DataFrame, spec: TableSpec) -> DataFrame:
    """The keys of the deletes and the latest time of each; a null trailing key stands for all."""
    if isinstance(spec, EavSpec):
        deletes = deletes.withColumnRenamed("entity_key", spec.merge_key[0])
    return deletes.groupBy(*(c for c, _ in spec.keys)).agg(F.max("ts_ms").alias("deleted_at"))


def with_deletion(rows: DataFrame, stones: DataFrame, spec: TableSpec, at: str) -> DataFrame:
    """``rows`` with ``at``: the latest of ``stones`` (keys, deleted_at) that names the row, or NULL.

    Null trailing keys name all rows of the prefix, so there is a join for each length of prefix
    that the key can have.
    """
    names = [c for c, _ in spec.keys]
    out, hits = rows, []
    # a JSON event with a whole key is a mutation, so there a tombstone always lacks the last key
    longest = len(names) - 1 if isinstance(spec, JsonSpec) and spec.clustering_keys else len(names)
    for length in range(len(spec.delete_keys), longest + 1):
        lead, rest = names[:length], names[length:]
        named = F.expr(" and ".join([*(f"`{c}` is not null" for c in lead), *(f"`{c}` is null" for c in rest)]))
        level = stones.filter(F.when(F.col("deleted_at").isNotNull(), named))  # not a filter of keys alone, which would part the shuffles
        level = level.groupBy(*(F.col(c).alias(f"__d_{c}") for c in lead)).agg(F.max("deleted_at").alias(f"__deleted_{length}"))
        on = [F.col(c).eqNullSafe(F.col(f"__d_{c}")) for c in lead]  # the names of a level are never NULL
        out = out.join(level, on, "left").drop(*(f"__d_{c}" for c in lead))
        hits.append(f"__deleted_{length}")
    return out.withColumn(at, F.greatest(*hits) if len(hits) > 1 else F.col(hits[0])).drop(*hits)


def newer_than_tombstones(mutations: DataFrame, stones: DataFrame, spec: TableSpec) -> DataFrame:
    """The mutations later than every tombstone of their keys in the same batch."""
    marked = with_deletion(mutations, stones, spec, "__at")
    return marked.filter("__at is null or ts_ms > __at").select(*mutations.columns)
