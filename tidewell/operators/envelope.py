"""Change-event lines to typed rows, and the route of each row.

The line is parsed once into strings; every cell is ``{"value": ...}`` under ``after``.  A generator
keeps the optimizer from parsing again for each field.  ``__tie`` orders events of the same time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EavSpec, JsonSpec, PlainSpec, TableSpec
from ..functions.cast import lenient_cast

CORRUPT, TOMBSTONE, MUTATION, DROPPED = "corrupt", "tombstone", "mutation", "dropped"


def _cells(spec: TableSpec) -> list[str]:
    if isinstance(spec, EavSpec):
        return [spec.key_field, "column2", "value"]
    if isinstance(spec, JsonSpec):
        return [*(c for c, _ in spec.keys), *dict.fromkeys(source for source, *_ in spec.json_columns)]
    return [c for c, _ in spec.columns]


def parse(lines: DataFrame, spec: TableSpec) -> DataFrame:
    """json_str, ts_ms, op, __tie and the table's typed cells of each line (json_str)."""
    cells = list(dict.fromkeys(_cells(spec)))
    after = ", ".join(f"`{c}`: struct<value: string>" for c in cells)
    event = F.from_json("json_str", f"ts_ms string, op string, after struct<{after}>")
    seen = lines.select("json_str", F.explode(F.array(event)).alias("e"))
    value = lambda c: F.col("e.after").getField(c).getField("value")
    head = ["json_str", lenient_cast(F.col("e.ts_ms"), "bigint").alias("ts_ms"), F.col("e.op").alias("op"), F.xxhash64("json_str").alias("__tie")]
    if isinstance(spec, EavSpec):
        return seen.select(*head, value(spec.key_field).alias("entity_key"), value("column2").alias("column2"), value("value").alias("blob"))
    typed = [lenient_cast(value(c), t).alias(c) for c, t in (spec.keys if isinstance(spec, JsonSpec) else spec.columns)]
    if isinstance(spec, JsonSpec):
        return seen.select(*head, *typed, *(value(c).alias(f"__json_{c}") for c in dict.fromkeys(s for s, *_ in spec.json_columns)))
    there = [F.col("e.after").getField(c).isNotNull().alias(f"__set_{c}") for c, _ in spec.data] if spec.null_policy == "presence" else []
    return seen.select(*head, *typed, *there)


def route(spec: TableSpec) -> Column:
    """Where a parsed row goes; rows that name no entity are dropped and only counted."""
    corrupt, delete = F.col("ts_ms").isNull(), F.coalesce(F.col("op").isin(*spec.delete_ops), F.lit(False))
    if isinstance(spec, EavSpec):
        rest = F.when(F.col("entity_key").isNull(), DROPPED).when(F.col("column2").isNotNull(), MUTATION).when(delete, TOMBSTONE).otherwise(DROPPED)
    elif isinstance(spec, JsonSpec):
        rest = F.when(F.col(spec.partition_keys[0][0]).isNull(), DROPPED)
        if spec.clustering_keys:
            rest = rest.when(F.col(spec.clustering_keys[-1][0]).isNull(), F.when(delete, TOMBSTONE).otherwise(DROPPED))
        rest = rest.otherwise(MUTATION)
    else:
        keyless = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in spec.delete_keys))
        corrupt = corrupt | keyless
        rest = F.when(delete, TOMBSTONE).when(F.col("op").isNull(), DROPPED).otherwise(MUTATION)
    return F.when(corrupt, CORRUPT).otherwise(rest)


def unknown_attributes(parsed: DataFrame, spec: EavSpec) -> DataFrame:
    """attribute: the distinct attributes of mutations that the configuration does not name."""
    known = [a for a, _, _ in spec.attributes]
    names = parsed.filter(F.col("entity_key").isNotNull() & F.col("column2").isNotNull() & ~F.col("column2").isin(known))
    return names.select(F.col("column2").alias("attribute")).distinct()


def operations(parsed: DataFrame) -> DataFrame:
    """op, events: how many events each operation has."""
    return parsed.groupBy("op").agg(F.count(F.lit(1)).alias("events"))
