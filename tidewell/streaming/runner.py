"""One isolated, checkpointed stream for each enabled table."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..alerts import AlertSink, log_sink, table_failure, unknown_attributes, unknown_topic
from ..config import EavSpec, TableSpec
from ..operators import envelope
from ..operators.envelope import CORRUPT, DROPPED, MUTATION, TOMBSTONE
from ..plans.batch import plan_batch
from ..sources.bronze import ensure_folder, kafka_lines, read_file, stream_lines, unconfigured_topics
from .log import LISTED
from .store import SnapshotStore

log = logging.getLogger("tidewell")
#: Unknown attributes that an alert names; the events are all counted.
NAMED = 100
#: Before the first retry; each further one waits twice as long.
RETRY_SECONDS = 1.0
#: Up to so many buckets a list of all files is small.
SMALL = 1024
Handler = Callable[[DataFrame, int], None]


def checkpoint_id(spark: SparkSession, spec: TableSpec) -> str:
    """The id that Spark gave the checkpoint: it survives restarts, and a new checkpoint has a new one.

    Batch numbers start anew with a checkpoint, so only with this id do they name a batch.
    """
    return json.loads(read_file(spark, f"{spec.checkpoint_path.rstrip('/')}/metadata"))["id"]


def dead_letter(lines: DataFrame, spec: TableSpec, query_id: str, batch_id: int, reason: str) -> None:
    """Write lines (json_str) as {table, batch_id, reason, json_str}; a replay of the batch replaces them."""
    rows = lines.select(F.lit(spec.name).alias("table"), F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(reason).alias("reason"), "json_str")
    rows.write.mode("overwrite").json(f"{spec.dead_letter_path.rstrip('/')}/{query_id}/batch_{batch_id}")


def handler(spec: TableSpec, alert: AlertSink = log_sink, on_counts: Callable[[int, dict[str, int]], None] | None = None) -> Handler:
    """Parse a micro-batch once, look at it once, write its corrupt lines, merge the rest."""

    def handle(lines: DataFrame, batch_id: int) -> None:
        query_id = checkpoint_id(lines.sparkSession, spec)
        plan = plan_batch(lines, spec)
        plan.routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store = SnapshotStore(lines.sparkSession, spec, alert=alert)
            seen = store.look(plan)
            counts = seen.counts
            if on_counts:
                on_counts(batch_id, counts)
            if counts.get(DROPPED):
                log.info("%s batch %d: %d events name no entity", spec.name, batch_id, counts[DROPPED])
            if seen.unknown:
                names = envelope.unknown_attributes(plan.routed.filter(F.col("route") == MUTATION), spec).limit(NAMED).collect()
                alert(unknown_attributes(spec.name, [r[0] for r in names], seen.unknown))
            if counts.get(CORRUPT):
                dead_letter(plan.corrupt, spec, query_id, batch_id, "corrupt")
            if counts.get(MUTATION) or counts.get(TOMBSTONE):
                version = store.merge(plan, query_id, batch_id, seen=seen)
                # old versions go at once where that is cheap, else when the files have just been listed
                if spec.keep_versions and version is not None and (store.buckets <= SMALL or version % LISTED == LISTED - 1):
                    _expire(store, spec)
        finally:
            plan.routed.unpersist()

    return handle


def _expire(store: SnapshotStore, spec: TableSpec) -> None:
    """Delete old versions; the batch is committed, so a failure only leaves them for the next time."""
    try:
        store.expire(spec.keep_versions)
    except Exception:  # noqa: BLE001
        log.exception("%s: old versions could not be deleted", spec.name)


def isolated(handle: Handler, spec: TableSpec, alert: AlertSink = log_sink) -> Handler:
    """``handle`` such that a failing batch is tried again ``spec.retries`` times, then dead-lettered whole, and the stream goes on.

    A batch that was committed before it failed is known by its id and not applied again.
    """

    def safe(lines: DataFrame, batch_id: int) -> None:
        for left in range(spec.retries, -1, -1):
            try:
                return handle(lines, batch_id)
            except Exception as error:  # noqa: BLE001 - one table's failure must not stop the others
                failure = error
                if left:
                    log.warning("%s batch %d failed and is tried again: %s", spec.name, batch_id, error)
                    time.sleep(RETRY_SECONDS * 2 ** (spec.retries - left))
        alert(table_failure(spec.name, batch_id, failure))
        try:
            dead_letter(lines, spec, checkpoint_id(lines.sparkSession, spec), batch_id, f"{type(failure).__name__}: {failure}"[:500])
        except Exception:  # noqa: BLE001
            log.exception("%s batch %d: the dead letter could not be written", spec.name, batch_id)

    return safe


def start(spark: SparkSession, spec: TableSpec, alert: AlertSink = log_sink, once: bool = False, max_files: int | None = None, **hooks) -> StreamingQuery:
    """Start the stream of one table; ``once`` takes what is there and ends."""
    if spec.kafka_servers:
        lines = kafka_lines(spark, spec.kafka_servers, spec.topic)
    else:
        ensure_folder(spark, spec.bronze_path)
        lines = stream_lines(spark, spec.bronze_path, max_files or spec.max_files_per_trigger)
    SnapshotStore(spark, spec, alert=alert).check_partitions()
    handle = isolated(handler(spec, alert, **hooks), spec, alert)
    writer = lines.writeStream.queryName(f"tidewell-{spec.name}").foreachBatch(handle).option("checkpointLocation", spec.checkpoint_path)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime=spec.trigger).start()


def run(spark: SparkSession, tables: dict[str, TableSpec], topics_base: str | None = None, alert: AlertSink = log_sink, once: bool = False) -> dict[str, StreamingQuery]:
    """Start all enabled tables; a table that cannot start is reported and the others run."""
    if topics_base:
        for topic in unconfigured_topics(spark, topics_base, {s.topic for s in tables.values()}):
            alert(unknown_topic(topic))
    queries = {}
    for name, spec in tables.items():
        if spec.enabled:
            try:
                queries[name] = start(spark, spec, alert, once)
            except Exception as error:  # noqa: BLE001
                alert(table_failure(name, -1, error))
    if once:
        for query in queries.values():
            query.awaitTermination()
    return queries


def supervise(spark: SparkSession, tables: dict[str, TableSpec], queries: dict[str, StreamingQuery], alert: AlertSink = log_sink, rounds: int | None = None, wait_s: int = 30) -> None:
    """Restart streams that end, for ever or for so many rounds."""
    while rounds is None or rounds > 0:
        for name, query in list(queries.items()):
            if query.awaitTermination(wait_s / max(1, len(queries))) or not query.isActive:
                alert(table_failure(name, -1, query.exception() or RuntimeError("the stream ended")))
                queries[name] = start(spark, tables[name], alert)
        rounds = None if rounds is None else rounds - 1
