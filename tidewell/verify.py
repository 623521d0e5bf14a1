"""The verification report: one row a table, all counts in one lazy plan, and the details of each table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import TableSpec
from .operators import envelope
from .sources.bronze import file_system, read_lines
from .streaming.store import SnapshotStore


def _there(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def _count(frame: DataFrame, name: str) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias(name))


def report(spark: SparkSession, tables: dict[str, TableSpec]) -> DataFrame:
    """table, type, bronze_events, silver_exists, silver_version, silver_rows, dead_letters, ok of enabled tables."""
    zero = spark.range(0)
    rows = []
    for name, spec in tables.items():
        if not spec.enabled:
            continue
        store = SnapshotStore(spark, spec)
        detail = store.detail()
        bronze = _count(read_lines(spark, spec.bronze_path) if _there(spark, spec.bronze_path) else zero, "bronze_events")
        silver = store.count("silver_rows")
        dead = _count(spark.read.option("recursiveFileLookup", "true").text(spec.dead_letter_path) if _there(spark, spec.dead_letter_path) else zero, "dead_letters")
        one = bronze.crossJoin(silver).crossJoin(dead)  # one row each
        rows.append(one.select(
            F.lit(name).alias("table"), F.lit(type(spec).__name__).alias("type"), "bronze_events", F.lit(detail is not None).alias("silver_exists"),
            F.lit(detail["version"] if detail else None).cast("bigint").alias("silver_version"), "silver_rows", "dead_letters", F.lit(detail is not None).alias("ok")))
    if not rows:
        raise ValueError("no table is enabled")
    return reduce(DataFrame.unionByName, rows)


def operation_breakdown(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """op, events of a table's events."""
    return envelope.operations(envelope.parse(read_lines(spark, spec.bronze_path), spec)).orderBy(F.desc("events"))


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values of a column, NULL left out."""
    return table.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def details(spark: SparkSession, spec: TableSpec, samples: int = 3, versions: int = 5) -> dict[str, DataFrame]:
    """What a reader wants to see of a table, by name; parts whose data is not there are left out.

    operations, events (some lines); columns, rows (some), the distinct values of each partition and
    key column and history (the latest versions) of the stored table; dead_letters (some).
    """
    found = {}
    if _there(spark, spec.bronze_path):
        found["operations"] = operation_breakdown(spark, spec)
        found["events"] = read_lines(spark, spec.bronze_path).limit(samples)
    store = SnapshotStore(spark, spec)
    if store.exists():
        table = store.read()
        found["columns"] = spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in table.schema.fields], "name string, type string, nullable boolean")
        found["rows"] = table.limit(samples)
        for column in dict.fromkeys([*spec.partition_by, *(c for c, _ in spec.keys)]):
            found[f"values of {column}"] = store.values(column) if column in spec.partition_by else distinct_values(table, column)
        found["history"] = store.history(versions)
    if _there(spark, spec.dead_letter_path):
        found["dead_letters"] = spark.read.option("recursiveFileLookup", "true").text(spec.dead_letter_path).limit(samples)
    return found
