"""Versioned current-state tables on plain Parquet: buckets with deltas, one small log record a version.

``data/__seq=<s>/__write=<id>/__bucket=<b>/...`` holds what one attempt to write a version put into a bucket: all
its rows, or a delta with the rows, old and new, of every key that the batch may have changed.  The log
(``log.TableLog``) says which files make up a version, so half-written ones are invisible.

A reader scans all files once.  ``seq`` comes from a file's path and grows with every write to a bucket, so
where a bucket has deltas a row counts if no delta has its key with a larger ``seq``: one more scan, of
the deltas' keys, whatever the number of versions.

A batch adds deltas until they have ``DELTA_SHARE`` of a bucket's bytes or are ``DELTAS`` many; then the
bucket is rewritten.  It opens only the files whose bounds of the first key meet the batch's.

Writers do not wait for each other.  A writer that finds its version taken looks at what was committed since: if
that touched none of its buckets its files stand and it takes the next version, otherwise it starts again.
A compaction changes no row: deltas committed meanwhile stay on top of it, and only buckets that others
rewrote meanwhile are left out of it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..alerts import AlertSink, log_sink, partition_change, schema_change
from ..config import EavSpec, TableSpec
from ..operators.envelope import MUTATION, TOMBSTONE
from ..plans.batch import BatchPlan, empty_table
from ..sources.bronze import file_system, folders
from .columns import Columns, SchemaChange, columns_of, from_record
from .log import Conflict, DataFile, TableLog

_HISTORY = "version bigint, timestamp bigint, operation string, metrics map<string,bigint>, queryId string, batchId bigint"
#: A bucket is rewritten once its deltas have this share of its bytes, or are so many.
DELTA_SHARE, DELTAS = 0.5, 16
#: Attempts of a batch whose buckets others keep changing.
ATTEMPTS = 20
#: Rows and bytes of deltas whose keys are surely small enough to send to all tasks; beyond, Spark decides by their measured size.
BROADCAST_KEYS, BROADCAST_BYTES = 200_000, 8 << 20
#: Hours after which a write that was never committed is taken for dead.
ORPHAN_HOURS = 48
#: The folder of rows without a value of their partition column.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Characters of a text that bounds a file's keys.
BOUND_CHARS = 100


def _observed(seen: Observation) -> int:
    """The rows counted.  A part of a plan that turns out to be empty is left out of it; its observation
    is then an empty row, which ``get`` takes for an error."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


@dataclass(frozen=True)
class Seen:
    """What one pass over a batch finds: events by route, those of unknown attributes, and the buckets that it
    touches with the least and greatest first key there."""

    counts: dict[str, int]
    unknown: int
    buckets: dict[int, tuple[object, object]]
    of: int

    @property
    def deletes(self) -> bool:
        return bool(self.counts.get(TOMBSTONE))


def _bounds(low: object, high: object) -> tuple[object, object]:
    """Bounds of bounded size that JSON can carry; (None, None) where there are none."""
    if isinstance(low, str) and isinstance(high, str):
        return low[:BOUND_CHARS], high if len(high) <= BOUND_CHARS else high[:BOUND_CHARS] + "\U0010ffff"
    return (low, high) if isinstance(low, int) and isinstance(high, int) else (None, None)


class SnapshotStore:
    def __init__(self, spark: SparkSession, spec: TableSpec, buckets: int | None = None, alert: AlertSink = log_sink):
        self.spark, self.spec, self.alert = spark, spec, alert
        self.path = spec.silver_path.rstrip("/")
        self.log = TableLog(spark, self.path)
        latest = self.latest()
        self.buckets = latest["bucketCount"] if latest else buckets or spec.buckets

    def latest(self) -> dict | None:
        return self.log.latest()

    def exists(self) -> bool:
        return bool(self.log.versions())

    def detail(self) -> dict | None:
        """The table's partition columns, schema and layout."""
        latest = self.latest()
        return latest and {k: latest[k] for k in ("version", "partitionColumns", "schema", "bucketCount")}

    def history(self, n: int | None = None) -> DataFrame:
        """version, timestamp, operation, metrics of the latest ``n`` versions, latest first."""
        versions = self.log.versions()
        paths = [f"{self.log.path}/{v}.json" for v in (versions if n is None else versions[-n:])]
        log = self.spark.read.schema(_HISTORY).json(paths) if paths else self.spark.createDataFrame([], _HISTORY)
        return log.select("version", F.timestamp_millis("timestamp").alias("timestamp"), "operation", "metrics", "queryId", "batchId").orderBy(F.desc("version"))

    def sizes(self) -> dict[int, tuple[int, int]]:
        """The bytes of every bucket: whole rows, deltas."""
        latest, out = self.latest(), defaultdict(lambda: [0, 0])
        for f in self.log.files(latest["version"]) if latest else []:
            out[f.bucket][f.delta] += f.bytes
        return {b: tuple(x) for b, x in out.items()}

    def check_partitions(self) -> None:
        """Raise if the configured partition columns differ from those of the table, or its columns cannot be those configured."""
        self._columns(self.latest())

    def _columns(self, record: dict | None) -> Columns:
        new = {old: name for old, name in self.spec.renames}
        names = {name for name, _ in self.spec.wide}
        stored = [c if c in names else new.get(c, c) for c in record["partitionColumns"]] if record else list(self.spec.partition_by)
        if sorted(stored) != sorted(self.spec.partition_by):
            wanted = list(self.spec.partition_by)
            self.alert(partition_change(self.spec.name, stored, wanted))
            raise ValueError(f"{self.spec.name}: the table is partitioned by {stored}, the configuration says {wanted}")
        try:
            return columns_of(self.spec, record)
        except SchemaChange as error:
            self.alert(schema_change(self.spec.name, str(error)))
            raise

    def _scan(self, files: list[DataFile], columns: Columns) -> DataFrame:
        """All rows of the files with their ``__seq``, in one scan; a write that is needed whole is named by its folder."""
        writes = defaultdict(list)
        for f in files:
            writes[f.write].append(f)
        base = f"{self.path}/data"
        paths = [p for mine in writes.values() for p in ([f"{base}/__seq={mine[0].seq}/__write={mine[0].write}"] if len(mine) == mine[0].siblings else [f"{base}/{f.path}" for f in mine])]
        schema = f"{columns.stored_schema}, __seq bigint, __write string, __bucket int"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows.select(*(F.col(stored).alias(name) for stored, name, _ in columns.held), "__seq")

    def _rows(self, files: list[DataFile], columns: Columns) -> DataFrame:
        """The rows of a version, or of some of its buckets or keys, given all the files that may have them."""
        if not files:
            return self.spark.createDataFrame([], columns.schema)
        rows, changed = self._scan(files, columns), [f for f in files if f.delta]
        if not changed:
            return rows.drop("__seq")
        names = [c for c, _ in self.spec.keys]
        newest = self._scan(changed, columns).groupBy(*(F.col(c).alias(f"__k_{c}") for c in names)).agg(F.max("__seq").alias("__newest"))
        if sum(f.rows for f in changed) <= BROADCAST_KEYS and sum(f.bytes for f in changed) <= BROADCAST_BYTES:
            newest = F.broadcast(newest)
        joined = rows.join(newest, self._same(names), "left")
        return joined.filter("__newest is null or __seq = __newest").select(*(name for _, name, _ in columns.held))

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None, between: tuple | None = None) -> DataFrame:
        """The table as of a version (the latest by default), or only some of its buckets, or the rows whose first
        bucketing key lies between two values; then files that cannot have such rows are not opened."""
        record = self.latest() if version is None else self.log.record(version)
        if not record:
            return empty_table(self.spark, self.spec)
        files = self.log.files(record["version"], buckets)
        if between is None:
            return self._rows(files, from_record(record))
        near = [f for f in files if f.may_hold(*between)]
        return self._rows(near, from_record(record)).filter(F.col(self.spec.delete_keys[0]).between(*between))

    @staticmethod
    def _same(names: list[str]) -> list[Column]:
        """Equality with the columns __k_x; NULLs are equal, as rows of one key must stay together."""
        return [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in names]

    def _event_keys(self, names: Iterable[str]) -> list[Column]:
        return [F.col("entity_key" if isinstance(self.spec, EavSpec) else c) for c in names]

    def _affected(self, table: DataFrame, live: DataFrame, deletes: bool) -> DataFrame:
        """The rows of ``table`` whose key has an event, or whose prefix may have a tombstone."""
        whole, lead = [c for c, _ in self.spec.keys], list(self.spec.delete_keys)

        def having(events: DataFrame, names: list[str]) -> DataFrame:
            return events.select(*(k.alias(f"__k_{c}") for k, c in zip(self._event_keys(names), names, strict=True))).distinct()

        if set(whole) == set(lead):
            return table.join(having(live, whole), self._same(whole), "left_semi")
        mutations = having(live.filter(F.col("route") == MUTATION), whole)
        if not deletes:
            return table.join(mutations, self._same(whole), "left_semi")
        stones = having(live.filter(F.col("route") == TOMBSTONE), lead)
        # a prefix delete takes all rows of its first keys into the delta, other keys only themselves
        wanted = mutations.withColumn("__m", F.lit(True))
        marked = table.join(stones.withColumn("__s", F.lit(True)), self._same(lead), "left").drop(*(f"__k_{c}" for c in lead)).join(wanted, self._same(whole), "left")
        return marked.filter("__s or __m").select(*table.columns)

    def _bucket(self, *keys: Column) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def look(self, plan: BatchPlan) -> Seen:
        """One pass over a batch: all that its handler and its merge have to know before they start."""
        live = F.col("route").isin(MUTATION, TOMBSTONE)
        unknown = (F.col("route") == MUTATION) & (~F.col("column2").isin([a for a, _, _ in self.spec.attributes]) if isinstance(self.spec, EavSpec) else F.lit(False))
        lead = self._event_keys(self.spec.delete_keys)
        found = plan.routed.groupBy("route", F.when(live, self._bucket(*lead)).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(unknown).alias("unknown"), F.min(lead[0]).alias("low"), F.max(lead[0]).alias("high")).collect()  # at most the buckets touched, by route
        counts, buckets = defaultdict(int), {}
        for r in found:
            counts[r["route"]] += r["n"]
            if r["bucket"] is not None:
                low, high = _bounds(r["low"], r["high"])
                had = buckets.get(r["bucket"], (low, high))
                buckets[r["bucket"]] = (None, None) if None in (low, high, *had) else (min(low, had[0]), max(high, had[1]))
        return Seen(dict(counts), sum(r["unknown"] for r in found), buckets, self.buckets)

    def _write(self, table: DataFrame, columns: Columns, seq: int, deltas: set[int], clustered: int | None = None) -> tuple[str, list[DataFile]]:
        """Write rows, in ``clustered`` parts by key or as Spark deals them; the write's id and its files, with what tasks found in them.

        Counts, bounds and sizes come from a job over the files just written, which reads their first key only.
        """
        base, name = f"{self.path}/data", uuid.uuid4().hex
        lead, keys = self.spec.delete_keys, [c for c, _ in self.spec.keys]
        order = ["__bucket", *self.spec.partition_by, *lead, *(c for c in keys if c not in lead)]
        dealt = table.withColumn("__bucket", self._bucket(*(F.col(c) for c in lead)))
        dealt = dealt.repartitionByRange(clustered, *order) if clustered else dealt.hint("rebalance", "__bucket", *self.spec.partition_by)
        dealt = dealt.sortWithinPartitions(*order).select(*(F.col(n).alias(s) for s, n, _ in columns.held), "__bucket")
        parts = [columns.stored(c) for c in self.spec.partition_by]
        folder = f"{base}/__seq={seq}/__write={name}"
        dealt.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", self.spec.file_rows).partitionBy("__bucket", *parts).parquet(folder)
        schema = f"{columns.stored_schema}, __seq bigint, __write string, __bucket int"
        first = F.col(columns.stored(lead[0]))
        found = self.spark.read.schema(schema).option("basePath", base).parquet(folder).groupBy("__bucket", F.col("_metadata.file_path").alias("path")).agg(
            F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.count(first).alias("keyed"), F.min(first).alias("low"), F.max(first).alias("high")).collect()  # a row for each file written
        files = []
        for r in found:
            bounds = _bounds(r["low"], r["high"]) if r["keyed"] == r["rows"] else (None, None)
            low, high = (None if b is None else json.dumps(b) for b in bounds)
            path = unquote(r["path"]).rsplit(f"/__seq={seq}/__write={name}/", 1)[1]
            files.append(DataFile(r["__bucket"], seq, name, len(found), r["__bucket"] in deltas, f"__seq={seq}/__write={name}/{path}", r["rows"], r["bytes"], low, high))
        return name, files

    def committed(self, query_id: str, batch_id: int) -> bool:
        """Whether the table holds this batch of a query, whose batches come in order."""
        latest = self.latest()
        return bool(latest) and latest["batches"].get(query_id, -1) >= batch_id

    def _commit(self, record: dict, base: dict | None) -> int:
        """Put a record in place as the next version; Conflict if what was committed after ``base`` forbids it."""
        seen = base["version"] if base else -1
        while True:
            versions = self.log.versions()
            newest = self.log.record(versions[-1]) if versions else None
            at = newest["version"] if newest else -1
            if seen < at and seen + 1 < versions[0]:
                raise Conflict("the versions since are forgotten")
            for version in range(seen + 1, at + 1):
                self._rebase(record, self.log.record(version), base)
            seen = at
            record |= {"version": at + 1, "batches": (newest["batches"] if newest else {}) | record["batches"]}
            if self.log.put(record):
                self.log.list_now_and_then(at + 1)
                return at + 1

    def _rebase(self, record: dict, other: dict, base: dict | None) -> None:
        """Fit ``record`` to a version committed after it was begun, or raise Conflict."""
        if other.get("reset") or record.get("reset") or base is None or other["columns"] != base["columns"]:
            raise Conflict(f"version {other['version']} changed the layout")
        mine = {int(b) for b in record["floors"]} | {f["bucket"] for f in record["files"]}
        theirs = {int(b) for b in other["floors"]}
        if record["operation"] == "COMPACT":
            # what others rewrote, or began before this compaction's rows were read, is left as it is
            lost = (mine & theirs) | {f["bucket"] for f in other["files"] if f["seq"] < record["floors"].get(str(f["bucket"]), -1)}
            record["files"] = [f for f in record["files"] if f["bucket"] not in lost]
            record["floors"] = {b: seq for b, seq in record["floors"].items() if int(b) not in lost}
            if not record["floors"]:
                raise Conflict("all buckets were rewritten")
        elif other["operation"] == "COMPACT":
            if any(other["floors"].get(str(b), -1) > record["seq"] for b in mine):
                raise Conflict("a compaction overtook the batch")
        elif set(record["touched"]) & set(other["touched"]) or record["queryId"] and record["queryId"] == other["queryId"]:
            raise Conflict(f"version {other['version']} touched the same buckets")

    def merge(self, plan: BatchPlan, query_id: str = "", batch_id: int = -1, deletes: bool = True, seen: Seen | None = None) -> int | None:
        """Apply a batch as one new version; None if it is committed already or changes nothing.

        ``deletes`` False says that the batch is known to have no tombstones; ``seen`` is what ``look`` found.
        """
        for _ in range(ATTEMPTS):
            latest = self.latest()
            if query_id and latest and latest["batches"].get(query_id, -1) >= batch_id:
                return None
            self.buckets = latest["bucketCount"] if latest else self.buckets
            seen = seen if seen and seen.of == self.buckets else self.look(plan)
            if not seen.buckets:
                return None
            try:
                return self._merge(plan, latest, seen, query_id, batch_id, deletes and seen.deletes)
            except Conflict:
                continue
        raise RuntimeError(f"{self.spec.name}: other writers changed the same buckets {ATTEMPTS} times")

    def _merge(self, plan: BatchPlan, latest: dict | None, seen: Seen, query_id: str, batch_id: int, deletes: bool) -> int | None:
        columns = self._columns(latest)
        held = defaultdict(list)
        for f in self.log.files(latest["version"], seen.buckets) if latest else []:
            held[f.bucket].append(f)
        light = {b for b, files in held.items() if self._takes_delta(files)}
        whole = [f for b, files in held.items() if b not in light for f in files]
        near = [f for b in light for f in held[b] if f.may_hold(*seen.buckets[b])]
        live = plan.routed.filter(F.col("route").isin(MUTATION, TOMBSTONE))
        target = [self._rows(whole, columns)] if whole else []
        if near:
            target.append(self._affected(self._rows(near, columns), live, deletes))
        before = Observation()
        table = reduce(DataFrame.unionByName, target).observe(before, F.count(F.lit(1)).alias("rows")) if target else empty_table(self.spark, self.spec)
        seq = 2 * (latest["version"] + 1) if latest else 0
        write, files = self._write(plan.apply(table, deletes), columns, seq, light)
        old, new = _observed(before) if target else 0, sum(f.rows for f in files)
        if not files and not latest:
            return None
        written = {f.bucket for f in files}
        return self._commit({
            "version": -1, "timestamp": int(time.time() * 1000), "operation": "MERGE" if latest else "WRITE", "seq": seq, "write": write, "queryId": query_id, "batchId": batch_id,
            "metrics": {"numOutputRows": new, "numTargetRowsInserted": new - old, "numBucketsRewritten": len(written - light), "numDeltas": len(written & light)}, "filesRead": len(whole) + len(near),
            "partitionColumns": list(self.spec.partition_by), "schema": columns.schema, **columns.to_record(), "bucketCount": self.buckets, "batches": {query_id: batch_id} if query_id else {},
            "touched": sorted(seen.buckets), "floors": {str(b): seq for b in sorted(written - light)}, "files": [asdict(f) for f in files]}, latest)

    def _takes_delta(self, files: list[DataFile]) -> bool:
        """Whether a batch may add a delta to a bucket, rather than rewrite it."""
        whole, deltas = (sum(f.bytes for f in files if f.delta == d) for d in (False, True))
        return deltas < DELTA_SHARE * whole and len({f.write for f in files if f.delta}) < DELTAS

    def count(self, name: str = "rows") -> DataFrame:
        """One row with the number of rows: the log knows it of buckets without deltas, and only the others are scanned."""
        record = self.latest()
        files = self.log.files(record["version"]) if record else []
        changed = {f.bucket for f in files if f.delta}
        known = F.lit(sum(f.rows for f in files if f.bucket not in changed)).cast("bigint")
        if not changed:
            return self.spark.range(1).select(known.alias(name))
        return self._rows([f for f in files if f.bucket in changed], from_record(record)).agg((F.count(F.lit(1)) + known).alias(name))

    def values(self, column: str) -> DataFrame:
        """The sorted distinct values of a partition column, NULL left out.

        Where a bucket has no deltas they stand in its files' paths and no file is opened; the rest is scanned.
        """
        record = self.latest()
        files = self.log.files(record["version"]) if record else []
        changed = {f.bucket for f in files if f.delta}
        at = f"/{from_record(record).stored(column)}=" if record else ""
        named = {unquote(f.path.split(at, 1)[1].split("/", 1)[0]) for f in files if f.bucket not in changed}
        kind = dict(self.spec.wide)[column]
        plain = self.spark.createDataFrame([(v,) for v in sorted(named - {_NO_VALUE})], f"`{column}` string").select(F.col(column).cast(kind).alias(column))
        scanned = self._rows([f for f in files if f.bucket in changed], from_record(record)).select(column) if changed else None
        every = plain if scanned is None else plain.unionByName(scanned)
        return every.filter(F.col(column).isNotNull()).distinct().orderBy(column)

    def compact(self, buckets: int | None = None) -> int | None:
        """Rewrite the table without deltas, sorted by bucket, partition and key into files of about ``target_mb``, or with
        another number of buckets."""
        for _ in range(ATTEMPTS):
            latest = self.latest()
            files = self.log.files(latest["version"]) if latest else []
            same = not buckets or buckets == latest["bucketCount"]
            if not files or (same and len({f.write for f in files}) < 2 and not any(f.delta for f in files)):
                return None
            columns, rows = from_record(latest), self._rows(files, from_record(latest))
            self.buckets = buckets or latest["bucketCount"]
            seq = 2 * latest["version"] + 1
            parts = max(1, round(sum(f.bytes for f in files) / (self.spec.target_mb << 20)))
            write, made = self._write(rows, columns, seq, set(), parts)
            record = latest | {
                "timestamp": int(time.time() * 1000), "operation": "COMPACT", "seq": seq, "write": write, "queryId": "", "batchId": -1, "bucketCount": self.buckets, "batches": {}, "touched": [],
                "metrics": {"numBucketsRewritten": len({f.bucket for f in made})}, "reset": not same, "floors": {str(b): seq for b in sorted({f.bucket for f in made})}, "files": [asdict(f) for f in made]}
            try:
                return self._commit(record, latest)
            except Conflict:
                continue
        raise RuntimeError(f"{self.spec.name}: other writers left nothing to compact {ATTEMPTS} times")

    def expire(self, keep: int = 5) -> list[int]:
        """Delete log records but the latest ``keep``, and the writes that none of these needs; the versions of those."""
        versions = self.log.versions()
        if not versions:
            return []
        first = versions[-keep:][0]
        self.log.list_files(first)
        needed, spent, gone = self.log.writes(first), self.log.writes_before(first), []
        fs, data = file_system(self.spark, f"{self.path}/data")
        path, old = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path, time.time() * 1000 - ORPHAN_HOURS * 3_600_000
        for folder in folders(self.spark, f"{self.path}/data"):
            inside = fs.listStatus(path(data, folder))
            names = [s.getPath().getName().removeprefix("__write=") for s in inside]
            # a write that no record names may be one that has yet to be committed
            dead = [n for n, s in zip(names, inside, strict=True) if n not in needed and (n in spent or s.getModificationTime() < old)]
            for n in dead:
                fs.delete(path(data, f"{folder}/__write={n}"), True)
            if len(dead) == len(names):
                fs.delete(path(data, folder), True)
                gone.append((int(folder.removeprefix("__seq=")) + 1) // 2)
        self.log.forget(first)
        return sorted(gone)
