"""The way of one entity through the steps of a batch, for looking at; never part of a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import EavSpec, TableSpec
from .operators import shape
from .operators.envelope import MUTATION
from .plans.batch import plan_batch


def trace_entity(lines: DataFrame, spec: TableSpec, entity: str | None = None) -> DataFrame:
    """step, position, content (JSON) of the events of one entity, in order.

    Steps are parsed (every event with its route), latest (the events that win) and shaped (the row
    that is merged, without its id).  ``entity`` is the text of the first key; by default it is the
    least one of the lines.  Events are sorted by attribute, then by time and line.
    """
    routed = plan_batch(lines, spec).routed
    first = "entity_key" if isinstance(spec, EavSpec) else spec.merge_key[0]
    key = F.col(first).cast("string")
    if entity is None:
        entity = routed.agg(F.min(key)).first()[0]
    mine = routed.filter(key == F.lit(entity))
    names = ["entity_key", "column2"] if isinstance(spec, EavSpec) else list(spec.merge_key)
    mutations = mine.filter(F.col("route") == MUTATION)
    latest = shape.latest_wins(mutations, names, ["ts_ms", "__tie"])
    order = [*names, "ts_ms", "__tie"]

    def step(n: int, name: str, rows: DataFrame, by: list[str]) -> DataFrame:
        shown = [c for c in rows.columns if c not in ("json_str", "__tie", "event_id")]
        content = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
        numbered = F.row_number().over(shape.Window.orderBy(*by))  # the rows of one entity
        return rows.select(F.lit(n).alias("n"), F.lit(name).alias("step"), numbered.cast("long").alias("position"), content.alias("content"))

    shaped = shape.upserts(mutations, spec)
    steps = [step(1, "parsed", mine, order), step(2, "latest", latest, order), step(3, "shaped", shaped, list(spec.merge_key))]
    return reduce(DataFrame.unionByName, steps).orderBy("n", "position").drop("n")
