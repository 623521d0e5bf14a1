"""The plan of one batch: from change-event lines to upserts and tombstones, and to the next table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TableSpec
from ..operators import envelope, shape
from ..operators.merge import apply_changes, merge


@dataclass(frozen=True)
class BatchPlan:
    """All parts are lazy.  ``routed`` parses the lines; a table whose tombstones name whole keys needs it once."""

    spec: TableSpec
    routed: DataFrame

    @property
    def corrupt(self) -> DataFrame:
        return self.routed.filter(F.col("route") == envelope.CORRUPT)

    @property
    def stones(self) -> DataFrame:
        return shape.tombstones(self.routed.filter(F.col("route") == envelope.TOMBSTONE), self.spec)

    @property
    def upserts(self) -> DataFrame:
        mutations = self.routed.filter(F.col("route") == envelope.MUTATION)
        if self.spec.ordering == "event_time" and shape.by_whole_key(self.spec):
            return shape.key_changes(self.routed, self.spec).filter("live").drop("live", "deleted_at")
        if self.spec.ordering == "event_time":
            mutations = shape.newer_than_tombstones(mutations, self.stones, self.spec)
        return shape.upserts(mutations, self.spec)

    def apply(self, table: DataFrame, deletes: bool = True) -> DataFrame:
        """The next table; ``deletes`` False says that the batch is known to have no tombstones."""
        if shape.by_whole_key(self.spec):
            return apply_changes(table, shape.key_changes(self.routed, self.spec), self.spec)
        if self.spec.ordering != "event_time" and deletes:
            # one parse and one shuffle: tombstones and mutations are parts of one grouping
            upserts, stones = shape.prefix_changes(self.routed, self.spec)
            return merge(table, upserts, stones, self.spec)
        return merge(table, self.upserts, self.stones if deletes else None, self.spec)


def plan_batch(lines: DataFrame, spec: TableSpec) -> BatchPlan:
    """The plan for ``lines`` (json_str)."""
    parsed = envelope.parse(lines, spec)
    return BatchPlan(spec, parsed.withColumn("route", envelope.route(spec)))


def empty_table(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def replay(spark, batches: list[DataFrame], spec: TableSpec) -> DataFrame:
    """The table after all ``batches`` of lines, one after another."""
    table = empty_table(spark, spec)
    for lines in batches:
        table = plan_batch(lines, spec).apply(table)
    return table
