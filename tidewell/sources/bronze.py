"""Folders of change-event lines: scans, a writer, and folder checks through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.json"}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """json_str: the lines of all .json files below ``path``."""
    return spark.read.format("text").options(**_OPTIONS).load(path).withColumnRenamed("value", "json_str")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream of new files."""
    reader = spark.readStream.format("text").options(**_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).withColumnRenamed("value", "json_str")


def kafka_lines(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """json_str of a Kafka topic; needs Spark's Kafka package on the class path."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").load()
    return stream.select(F.col("value").cast("string").alias("json_str"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Append lines in folders by hour (UTC) of their ts_ms: year=/month=/day=/hour=."""
    at = F.timestamp_millis(F.get_json_object("json_str", "$.ts_ms").try_cast("bigint"))
    utc = F.to_utc_timestamp(at, F.current_timezone())
    parts = {"year": F.date_format(utc, "yyyy"), "month": F.date_format(utc, "MM"), "day": F.date_format(utc, "dd"), "hour": F.date_format(utc, "HH")}
    # Spark's text writer cannot name its files .json; a one-column CSV without quotes is the same text
    plain = {"sep": "\u0001", "quote": "", "escapeQuotes": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "extension": "json"}
    dealt = lines.select("json_str").withColumns(parts).hint("rebalance", *parts)  # few files an hour, however many tasks
    dealt.write.mode("append").partitionBy(*parts).options(**plain).csv(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of ``path``."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_file(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make the folder, so that a stream can start before its first event."""
    fs, at = file_system(spark, path)
    fs.mkdirs(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of all files below ``path``."""
    fs, at = file_system(spark, path)
    return fs.getContentSummary(at).getLength()


def unconfigured_topics(spark: SparkSession, base: str, topics: set[str]) -> list[str]:
    """Topic folders below ``base`` that no table reads."""
    return [t for t in folders(spark, base) if t not in topics]
