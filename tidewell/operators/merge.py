"""Upserts and soft deletes as pure functions from a table and a batch to the next table.

Deletes of a batch act on the table as it was, then the upserts follow.  NULL keys never match.
Columns named ``__s_x`` belong to the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EavSpec, PlainSpec, TableSpec
from ..functions.cast import event_date
from .shape import with_deletion


def conform(table: DataFrame, spec: TableSpec) -> DataFrame:
    """``table`` with the configured columns in order; columns that it lacks are NULL."""
    empty = table.sparkSession.createDataFrame([], spec.schema)
    have = set(table.columns)
    return table.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema.fields))


def _deleted(name: str, at: Column, spec: TableSpec) -> Column:
    """A column of a row after its tombstone, if there is one: data goes, keys and event_id stay."""
    if name in {c for c, _ in spec.data}:
        return F.when(at.isNull(), F.col(name))
    if name in ("event_timestamp", "deduptime"):
        return F.coalesce(at, F.col(name))
    if name == "event_date":
        return F.coalesce(event_date(at), F.col(name))
    return F.col(name)


def soft_delete(table: DataFrame, stones: DataFrame, spec: TableSpec) -> DataFrame:
    """NULL the data of the rows that a tombstone (keys, deleted_at) names; rows never go."""
    marked = with_deletion(table, stones, spec, "__at")
    return marked.select(*(_deleted(c, F.col("__at"), spec).alias(c) for c in table.columns))


def _taken(name: str, new: Column, spec: TableSpec) -> Column:
    """Whether a column takes the batch's value, for a row that the batch upserts (``new``).

    EAV: where its flag is set.  JSON: always.  PLAIN: where the value is not null, or with
    null_policy presence where the cell is there.
    """
    if name in {c for c, _ in spec.data}:
        if isinstance(spec, EavSpec):
            return new & (F.col(f"__s_has_{name}") == 1)
        if isinstance(spec, PlainSpec):
            return new & (F.col(f"__s___set_{name}") if spec.null_policy == "presence" else F.col(f"__s_{name}").isNotNull())
    return new


def _guarded(new: Column, spec: TableSpec, before: Column) -> Column:
    if spec.guard == "event_timestamp":
        return new & (before.isNull() | (F.col("__s_event_timestamp") >= before))
    return new


def _joined(table: DataFrame, source: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    names = [c for c, _ in spec.keys]
    batch = source.select(*(F.col(c).alias(f"__s_{c}") for c in source.columns), F.lit(True).alias("__new"))
    return table.join(batch, [F.col(c) == F.col(f"__s_{c}") for c in names], "full_outer"), names


def upsert(table: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Full outer join of the table and a batch with one row per key; metadata is the batch's."""
    joined, names = _joined(table, source, spec)
    new = _guarded(F.coalesce(F.col("__new"), F.lit(False)), spec, F.col("event_timestamp"))
    value = lambda c: F.coalesce(c, f"__s_{c}") if c in names else F.when(_taken(c, new, spec), F.col(f"__s_{c}")).otherwise(F.col(c))
    return joined.select(*(value(c).alias(c) for c in table.columns))


def apply_changes(table: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Tombstones and upserts of a batch (``shape.key_changes``) in one full outer join.

    A tombstone of a key that the table lacks adds no row.
    """
    table = conform(table, spec)
    joined, names = _joined(table.withColumn("__old", F.lit(True)), changes, spec)
    at, live = F.col("__s_deleted_at"), F.coalesce(F.col("__s_live"), F.lit(False))
    kept = joined.filter(F.col("__old") | live)
    new = _guarded(live, spec, F.coalesce(F.when(F.col("__old"), at), F.col("event_timestamp")))
    value = lambda c: F.coalesce(c, f"__s_{c}") if c in names else F.when(_taken(c, new, spec), F.col(f"__s_{c}")).when(F.col("__old"), _deleted(c, at, spec))
    return kept.select(*(value(c).alias(c) for c in table.columns))


def merge(table: DataFrame, source: DataFrame, stones: DataFrame | None, spec: TableSpec) -> DataFrame:
    """The table after a batch: its tombstones (None if it has none) first, then its upserts."""
    table = conform(table, spec)
    if stones is not None:
        table = soft_delete(table, stones, spec)
    return upsert(table, source, spec)
