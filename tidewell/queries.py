"""Registered queries: table rows become change events, go through the operators, and come back.

Each has an oracle in SQL that states the end state directly from the base tables, except those
that report on a stored table's own history.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import EAV, JSON_EMBEDDED, PLAIN, TableSpec, build, load_config
from .functions.blob import encode_blob
from .operators import envelope, shape
from .plans.batch import plan_batch, replay
from .sources.bronze import write_lines
from .sources.generator import cell, event_lines
from .streaming.runner import run, start
from .streaming.store import SnapshotStore
from .trace import trace_entity
from .verify import details, distinct_values, report

KINDS = ("click", "view", "purchase", "signup")
CUTS = ("2024-01-11", "2024-01-21")
LATER = 1_800_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spec(name: str, kind: str, base: str = "unset", **cfg: object) -> TableSpec:
    common = {"type": kind, "enabled": True, "kafka_topic": name, "bronze_path": f"{base}/topics/{name}", "silver_path": f"{base}/silver/{name}", "checkpoint_path": f"{base}/checkpoints/{name}", "dead_letter_path": f"{base}/dead-letter/{name}"}
    return build(name, common | cfg)


def _eav(name: str, key: str, attributes: dict[str, tuple[str, str]], base: str = "unset") -> TableSpec:
    return _spec(name, EAV, base, merge_key=key, cassandra_key_field="key", partition_by=None, attributes={a: {"wide": w, "type": t} for a, (w, t) in attributes.items()})


def _plain(name: str, key: str, columns: dict[str, str]) -> TableSpec:
    return _spec(name, PLAIN, partition_keys=[{"name": key, "type": columns[key]}], clustering_keys=[], merge_key=key, columns=[{"name": c, "type": t} for c, t in columns.items()])


def _ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without time zone."""
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)


def _vertical(rows: DataFrame, ts_ms: Column, key: Column, blobs: dict[str, Column]) -> DataFrame:
    """One insert event for each row and attribute."""
    parts = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), b.alias("b")) for a, b in blobs.items())))
    long = rows.select(ts_ms.alias("t"), key.cast("string").alias("k"), parts.alias("p"))
    return event_lines(long, F.col("t"), F.lit("i"), {"key": cell(F.col("k")), "column2": cell(F.col("p.a")), "value": cell(F.col("p.b"))})


def _plain_lines(rows: DataFrame, ts_ms: Column, op: Column, cells: dict[str, Column]) -> DataFrame:
    return event_lines(rows, ts_ms, op, {c: cell(v.cast("string")) for c, v in cells.items()})


def eav_roundtrip_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _eav("customer", "custkey", {"nationKey": ("nationkey", "int"), "mktSegment": ("mktsegment", "text")})
    lines = _vertical(_table(spark, sf_dir, "customer"), F.lit(1), F.col("c_custkey"), {"nationKey": encode_blob(F.col("c_nationkey"), "int"), "mktSegment": encode_blob(F.col("c_mktsegment"), "text")})
    return replay(spark, [lines], spec).select("custkey", "nationkey", "mktsegment")


def eav_decode_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _eav("orders", "orderkey", {"c": ("custkey", "bigint"), "f": ("is_final", "boolean"), "p": ("priority", "text"), "d": ("day", "int")})
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("2030-01-01").cast("date"))
    blobs = {"c": encode_blob(-F.col("o_custkey"), "bigint"), "f": encode_blob(F.col("o_orderstatus") == "F", "boolean"), "p": encode_blob(F.col("o_orderpriority"), "text"), "d": encode_blob(day, "int")}
    lines = _vertical(_table(spark, sf_dir, "orders"), F.lit(1), F.col("o_orderkey"), blobs)
    return replay(spark, [lines], spec).select("orderkey", "custkey", "is_final", "priority", "day")


def eav_decode_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles and floats through their big-endian blobs, with either sign."""
    spec = _eav("orders", "orderkey", {"d": ("price", "double"), "n": ("less", "double"), "f": ("single", "float")})
    price = F.col("o_totalprice").cast("double")
    blobs = {"d": encode_blob(price, "double"), "n": encode_blob(-price / 7, "double"), "f": encode_blob(price, "float")}
    lines = _vertical(_table(spark, sf_dir, "orders"), F.lit(1), F.col("o_orderkey"), blobs)
    return replay(spark, [lines], spec).select("orderkey", "price", "less", F.col("single").cast("double").alias("single"))


def eav_attribute_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null value deletes one attribute and leaves the others alone."""
    orders = _table(spark, sf_dir, "orders")
    spec = _eav("orders", "orderkey", {"c": ("custkey", "bigint"), "p": ("priority", "text")})
    first = _vertical(orders, F.lit(1), F.col("o_orderkey"), {"c": encode_blob(F.col("o_custkey"), "bigint"), "p": encode_blob(F.col("o_orderpriority"), "text")})
    gone = _vertical(orders.filter("o_orderkey % 3 = 0"), F.lit(2), F.col("o_orderkey"), {"p": F.lit(None).cast("string")})
    return replay(spark, [first, gone], spec).select("orderkey", "custkey", "priority", "event_timestamp")


def _event_lines(events: DataFrame) -> DataFrame:
    """Attribute events of the events table; the type error stands for the delete of an entity."""
    gone = F.col("event_type") == "error"
    k = F.get_json_object("props", "$.k").cast("int")
    cells = {"key": cell(F.col("user_id").cast("string")), "column2": cell(F.when(~gone, F.col("event_type"))), "value": cell(F.when(~gone, encode_blob(k, "int")))}
    return event_lines(events, _ms(F.col("ts")), F.when(gone, "d").otherwise("u"), cells)


def _event_spec(base: str = "unset", kinds: tuple[str, ...] = KINDS) -> TableSpec:
    return _eav("events", "user", {a: (a, "int") for a in kinds}, base)


def _event_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = _table(spark, sf_dir, "events")
    ts = F.col("ts")
    parts = [ts < CUTS[0], (ts >= CUTS[0]) & (ts < CUTS[1]), ts >= CUTS[1]]
    return [_event_lines(events.filter(p)) for p in parts]


def eav_pivot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _event_spec(kinds=KINDS[:3])
    plan = plan_batch(_event_lines(_table(spark, sf_dir, "events")), spec)
    return plan.upserts.select("user", *KINDS[:3], *(f"has_{a}" for a in KINDS[:3]), "event_timestamp")


def eav_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, _event_batches(spark, sf_dir), _event_spec()).select("user", *KINDS, "event_timestamp")


def eav_event_time_ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within one batch, mutations that are not newer than the entity's tombstone are dropped."""
    spec = replace(_event_spec(), ordering="event_time")
    return replay(spark, [_event_lines(_table(spark, sf_dir, "events"))], spec).select("user", *KINDS, "event_timestamp")


def _json_spec() -> TableSpec:
    return _spec("props", JSON_EMBEDDED, partition_keys=[{"name": "user_id", "type": "bigint"}], clustering_keys=[{"name": "event_type", "type": "text"}], merge_key=["user_id", "event_type"], json_columns={"props": {"k": {"col": "k", "type": "int"}}})


def _json_lines(events: DataFrame) -> DataFrame:
    return event_lines(events, _ms(F.col("ts")), F.lit("i"), {"user_id": cell(F.col("user_id").cast("string")), "event_type": cell(F.col("event_type")), "props": cell(F.col("props"))})


def json_expand_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec("by_id", JSON_EMBEDDED, partition_keys=[{"name": "event_id", "type": "bigint"}], clustering_keys=[], merge_key=["event_id"], json_columns={"props": {"k": {"col": "k", "type": "int"}, "none": {"col": "missing", "type": "double"}}})
    lines = event_lines(_table(spark, sf_dir, "events"), F.lit(1), F.lit("i"), {"event_id": cell(F.col("event_id").cast("string")), "props": cell(F.col("props"))})
    parsed = plan_batch(lines, spec).routed.filter(F.col("route") == envelope.MUTATION)
    return shape.expand_json(parsed, spec, "ts_ms").select("event_id", "k", "missing")


def json_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, [_json_lines(_table(spark, sf_dir, "events"))], _json_spec()).select("user_id", "event_type", "k", "event_timestamp")


def json_partition_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    users = events.select("user_id").distinct().filter("user_id % 7 = 0")
    none = F.lit(None).cast("string")
    stones = event_lines(users, F.lit(LATER), F.lit("d"), {"user_id": cell(F.col("user_id").cast("string")), "event_type": cell(none), "props": cell(none)})
    return replay(spark, [_json_lines(events), stones], _json_spec()).select("user_id", "event_type", "k", "event_timestamp")


_ORDER = {"orderkey": "bigint", "custkey": "bigint", "status": "text", "totalprice": "double", "priority": "text"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr("o_orderkey orderkey", "o_custkey custkey", "o_orderstatus status", "o_totalprice totalprice", "o_orderpriority priority")


def _order_lines(orders: DataFrame, ts_ms: int, op: str, **changed: Column) -> DataFrame:
    return _plain_lines(orders, F.lit(ts_ms), F.lit(op), {c: F.col(c) for c in _ORDER} | changed)


def _order_updates(orders: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    status = F.when(F.col("orderkey") % 4 == 0, F.lit("X"))
    return _order_lines(orders.filter("orderkey % 2 = 0"), 2, "u", custkey=none, status=status, totalprice=none, priority=none)


def plain_upsert_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return replay(spark, [_order_lines(orders, 1, "i"), _order_updates(orders)], _plain("orders", "orderkey", _ORDER)).select(*_ORDER, "event_timestamp")


def plain_upsert_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With null_policy presence a cell that is there and null sets NULL."""
    orders = _orders(spark, sf_dir)
    spec = replace(_plain("orders", "orderkey", _ORDER), null_policy="presence")
    return replay(spark, [_order_lines(orders, 1, "i"), _order_updates(orders)], spec).select(*_ORDER, "event_timestamp")


def plain_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return replay(spark, [_order_lines(orders, 1, "i"), _order_lines(orders.filter("status = 'P'"), 2, "d")], _plain("orders", "orderkey", _ORDER)).select(*_ORDER, "event_timestamp")


def plain_late_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the guard an event older than the row is ignored, whatever batch it comes in."""
    orders = _orders(spark, sf_dir)
    spec = replace(_plain("orders", "orderkey", _ORDER), guard="event_timestamp")
    stale = _order_lines(orders.filter("orderkey % 3 = 0"), 1, "u", status=F.lit("S"))
    return replay(spark, [_order_lines(orders, 2, "i"), stale], spec).select(*_ORDER, "event_timestamp")


_ITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = shape.latest_wins(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _ITEM_ORDER)
    return latest.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), *_ITEM_ORDER[1:])


def corrupt_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _table(spark, sf_dir, "documents").select(F.regexp_replace("text", r"[\r\n]", " ").alias("json_str"))
    customers = _table(spark, sf_dir, "customer")
    good = _plain_lines(customers, F.lit(1), F.lit("i"), {"custkey": F.col("c_custkey"), "name": F.col("c_name")})
    keyless = _plain_lines(customers.filter("c_nationkey = 3"), F.lit(1), F.lit("i"), {"custkey": F.lit(None), "name": F.col("c_name")})
    spec = _plain("customer", "custkey", {"custkey": "bigint", "name": "text"})
    routed = plan_batch(bad.unionByName(good).unionByName(keyless), spec).routed
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("events"))


def op_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("status") == "F", "d").when(F.col("status") == "O", "u").otherwise("i")
    lines = _plain_lines(_orders(spark, sf_dir), F.lit(1), op, {"orderkey": F.col("orderkey")})
    return envelope.operations(envelope.parse(lines, _plain("orders", "orderkey", {"orderkey": "bigint"})))


def distinct_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _plain("customer", "custkey", {"custkey": "bigint", "mktsegment": "text"})
    lines = _plain_lines(_table(spark, sf_dir, "customer"), F.lit(1), F.lit("i"), {"custkey": F.col("c_custkey"), "mktsegment": F.col("c_mktsegment")})
    return distinct_values(replay(spark, [lines], spec), "mktsegment")


def unknown_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _event_spec(kinds=("click", "view"))
    return envelope.unknown_attributes(envelope.parse(_event_lines(_table(spark, sf_dir, "events")), spec), spec)


def enrich_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _plain("events", "id", {"id": "bigint", "kind": "text"})
    lines = _plain_lines(_table(spark, sf_dir, "events"), _ms(F.col("ts")), F.lit("i"), {"id": F.col("event_id"), "kind": F.col("event_type")})
    return replay(spark, [lines], spec).select("id", "event_timestamp", "event_date")


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no such number or truth value become NULL; fractions are cut off."""
    spec = _plain("casts", "orderkey", {"orderkey": "bigint", "whole": "int", "final": "boolean", "none": "int", "real": "float"})
    cells = {"orderkey": F.col("o_orderkey"), "whole": F.col("o_totalprice").cast("decimal(20,2)"), "final": F.col("o_orderstatus"), "none": F.col("o_orderpriority"), "real": F.col("o_custkey")}
    lines = _plain_lines(_table(spark, sf_dir, "orders"), F.lit(1), F.lit("i"), cells)
    return replay(spark, [lines], spec).select("orderkey", "whole", "final", "none", F.col("real").cast("double").alias("real"))


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic event ids."""
    spec = replace(_plain("orders", "orderkey", _ORDER), event_ids="deterministic")
    return replay(spark, [_order_lines(_orders(spark, sf_dir), 1, "i")], spec).select("orderkey", "event_id")


def unique_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = replay(spark, [_order_lines(_orders(spark, sf_dir), 1, "i")], _plain("orders", "orderkey", _ORDER))
    return table.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("ids"))


def null_first_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events without their first key are dropped, whatever else they say."""
    events = _table(spark, sf_dir, "events")
    key = F.when(F.col("event_id") % 5 != 0, F.col("user_id").cast("string"))
    lines = event_lines(events, _ms(F.col("ts")), F.lit("i"), {"user_id": cell(key), "event_type": cell(F.col("event_type")), "props": cell(F.col("props"))})
    return plan_batch(lines, _json_spec()).routed.groupBy("route").agg(F.count(F.lit(1)).alias("events"))


def _base(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/streams-{uuid.uuid4().hex}" if shared else "file://" + tempfile.mkdtemp(prefix="tidewell-streams-")


def trace_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that win for the user whose name sorts first."""
    steps = trace_entity(_event_lines(_table(spark, sf_dir, "events")), _event_spec())
    seen = F.from_json("content", "entity_key string, column2 string, ts_ms long")
    return steps.filter("step = 'latest'").select("position", seen.alias("e")).select("position", F.col("e.entity_key").alias("user"), F.col("e.column2").alias("attribute"), F.col("e.ts_ms").alias("ts_ms"))


def _streamed(spark: SparkSession, sf_dir: str) -> TableSpec:
    """The three batches as files, each taken in by a run of the stream on one checkpoint."""
    spec = _event_spec(_base(spark))
    for lines in _event_batches(spark, sf_dir):
        write_lines(lines, spec.bronze_path)
        start(spark, spec, once=True).awaitTermination()
    return spec


def stream_replay_eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SnapshotStore(spark, _streamed(spark, sf_dir)).read().select("user", *KINDS, "event_timestamp")


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = SnapshotStore(spark, _streamed(spark, sf_dir)).history(5)
    return history.select("version", "operation", F.col("metrics")["numTargetRowsInserted"].alias("rows_inserted"))


def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _streamed(spark, sf_dir)
    return report(spark, {spec.name: spec})


def _configured(base: str, tables: dict[str, dict]) -> dict[str, TableSpec]:
    """Tables by way of a YAML file, as users give them."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "tables.yml"
        places = {name: {"enabled": True, "kafka_topic": name, "partition_by": None, **{f"{f}_path": f"{base}/{f}/{name}" for f in ("silver", "checkpoint", "dead_letter")}, "bronze_path": f"{base}/topics/{name}"} for name in tables}
        path.write_text(yaml.safe_dump({"tables": {name: places[name] | cfg for name, cfg in tables.items()}}))
        return load_config(str(path))


_CUSTOMER = {"type": PLAIN, "partition_keys": [{"name": "custkey", "type": "bigint"}], "clustering_keys": [], "merge_key": "custkey", "columns": [{"name": "custkey", "type": "bigint"}, {"name": "name", "type": "text"}]}


def _events_table(kinds: tuple[str, ...]) -> dict:
    return {"type": EAV, "merge_key": "user", "cassandra_key_field": "key", "attributes": {a: {"wide": a, "type": "int"} for a in kinds}}


def _several(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, TableSpec]:
    """Tables, each with its stream: events, customer, which has every document as a corrupt line, and a disabled one.

    The streams run twice: the second run finds nothing new and makes no version.
    """
    every = {"events": _events_table(KINDS), "customer": _CUSTOMER, "off": _CUSTOMER | {"enabled": False}}
    tables = _configured(_base(spark), {n: every[n] for n in names})
    if "events" in names:
        write_lines(_event_lines(_table(spark, sf_dir, "events")), tables["events"].bronze_path)
    good = _plain_lines(_table(spark, sf_dir, "customer"), F.lit(1), F.lit("i"), {"custkey": F.col("c_custkey"), "name": F.col("c_name")})
    bad = _table(spark, sf_dir, "documents").select(F.concat(F.lit("no event: "), F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", " ")).alias("json_str"))
    write_lines(good.unionByName(bad), tables["customer"].bronze_path)
    for _ in range(2):
        run(spark, tables, once=True)
    return tables


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports: attributes and topics that no table names, and a table that cannot start, which stops no other."""
    base, seen = _base(spark), []
    tables = _configured(base, {"events": _events_table(KINDS[:2]), "customer": _CUSTOMER | {"partition_by": "name"}})
    write_lines(_event_lines(_table(spark, sf_dir, "events")), tables["events"].bronze_path)
    lines = _plain_lines(_table(spark, sf_dir, "customer"), F.lit(1), F.lit("i"), {"custkey": F.col("c_custkey"), "name": F.col("c_name")})
    write_lines(lines, f"{base}/topics/strange")
    _kept(spark, lines, replace(tables["customer"], partition_by=()))
    run(spark, tables, f"{base}/topics", seen.append, once=True)
    rows = SnapshotStore(spark, tables["events"]).read().count()
    found = [(a.kind, a.subject, ",".join(a.details.get("attributes", [])), a.details.get("events", 0), rows) for a in seen]
    return spark.createDataFrame(found, "kind string, subject string, attributes string, events long, rows_of_events long")


def table_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each part of a table's details has: samples are of three rows, values and operations are all."""
    parts = details(spark, _several(spark, sf_dir, "customer")["customer"])
    counts = [frame.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows")) for part, frame in parts.items()]
    return reduce(DataFrame.unionByName, counts)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a table's stream could not read, as it lies in the dead-letter folder."""
    path = _several(spark, sf_dir, "customer")["customer"].dead_letter_path
    found = spark.read.option("recursiveFileLookup", "true").schema("`table` string, batch_id bigint, reason string, json_str string").json(path)
    return found.select("table", "batch_id", "reason", F.md5("json_str").alias("line_md5"))


def several_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over several streams: counts of events, rows and dead letters; disabled tables are left out."""
    return report(spark, _several(spark, sf_dir, "events", "customer", "off"))


def _stored_orders(spark: SparkSession, **changes: object) -> TableSpec:
    return replace(_plain("orders", "orderkey", _ORDER), silver_path=f"{_base(spark)}/silver/orders", buckets=4, **changes)


def _kept(spark: SparkSession, lines: DataFrame, spec: TableSpec) -> SnapshotStore:
    """A stored table after a batch."""
    store = SnapshotStore(spark, spec)
    store.merge(plan_batch(lines, spec))
    return store


def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by status, whose rows change partition with a small batch, a large one and a compaction."""
    orders, spec = _orders(spark, sf_dir), _stored_orders(spark, partition_by=("status",))
    _kept(spark, _order_lines(orders, 1, "i"), spec)
    _kept(spark, _order_lines(orders.filter("orderkey % 50 = 0"), 2, "u", status=F.lit("Y")), spec)
    store = _kept(spark, _order_updates(orders), spec)
    store.compact()
    return store.read().select(*_ORDER, "event_timestamp")


def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of a partition column, from the log where no delta may have changed them."""
    orders, spec = _orders(spark, sf_dir), _stored_orders(spark, partition_by=("priority",))
    _kept(spark, _order_lines(orders, 1, "i"), spec)
    return _kept(spark, _order_lines(orders.filter("orderkey % 100 = 0"), 2, "u", priority=F.lit("0-LATE")), spec).values("priority")


def changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table whose configuration then widens one column, renames one and adds one."""
    orders, spec = _orders(spark, sf_dir), _stored_orders(spark)
    narrow = replace(spec, columns=tuple((c, "int" if c == "custkey" else t) for c, t in spec.columns))
    _kept(spark, _order_lines(orders, 1, "i"), narrow)
    wide = replace(spec, columns=(*((c if c != "priority" else "urgency", t) for c, t in spec.columns), ("note", "text")), renames=(("priority", "urgency"),))
    updates = _plain_lines(orders.filter("orderkey % 5 = 0"), F.lit(2), F.lit("u"), {"orderkey": F.col("orderkey"), "custkey": F.col("custkey") + 5_000_000_000, "note": F.lit("seen")})
    return _kept(spark, updates, wide).read().select("orderkey", "custkey", "urgency", "note", "event_timestamp")


def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers of one table at once, each with half of the changes."""
    orders, spec = _orders(spark, sf_dir), _stored_orders(spark)
    _kept(spark, _order_lines(orders, 1, "i"), spec)
    halves = [threading.Thread(target=_kept, args=(spark, _order_lines(orders.filter(f"orderkey % 4 = {k}"), 2, "u", status=F.lit(f"W{k}")), spec)) for k in (0, 2)]
    for half in halves:
        half.start()
    for half in halves:
        half.join()
    return SnapshotStore(spark, spec).read().select(*_ORDER, "event_timestamp")


def key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a range of keys; files that cannot have any are not opened."""
    spec = _stored_orders(spark, file_rows=2000)
    store = _kept(spark, _order_lines(_orders(spark, sf_dir), 1, "i"), spec)
    return store.read(between=(1000, 2000)).select(*_ORDER, "event_timestamp")


_E = """
e AS (SELECT user_id::VARCHAR AS k, event_type AS a, epoch_us(ts) // 1000 AS t, CAST(json_extract_string(props, '$.k') AS INT) AS v,
  CASE WHEN ts < '2024-01-11' THEN 0 WHEN ts < '2024-01-21' THEN 1 ELSE 2 END AS b FROM events)"""


def _each(template: str, names: tuple[str, ...] = KINDS) -> str:
    return ", ".join(template.replace("@", a) for a in names)


def _state(before: str, batch: int) -> str:
    after = f"t{batch}"
    deleted = f"{after} AS (SELECT s.k, {_each('CASE WHEN d.k IS NULL THEN s.@ END AS @')}, coalesce(d.t, s.t) AS t FROM {before} s LEFT JOIN d ON d.k = s.k AND d.b = {batch})"
    merged = f"s{batch} AS (SELECT coalesce(o.k, x.k) AS k, {_each('CASE WHEN x.has_@ = 1 THEN x.@ ELSE o.@ END AS @')}, coalesce(x.t, o.t) AS t FROM {after} o FULL JOIN (SELECT * FROM w WHERE b = {batch}) x ON o.k = x.k)"
    return f"{deleted}, {merged}"


_WIDE = _each("max(CASE WHEN a = '@' THEN v END) AS @") + ", " + _each("max(CASE WHEN a = '@' THEN 1 ELSE 0 END) AS has_@")
_STATES_SQL = f"""WITH {_E},
lv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, a, b ORDER BY t DESC) AS n FROM e WHERE a <> 'error') WHERE n = 1),
w AS (SELECT k, b, max(t) AS t, {_WIDE} FROM lv GROUP BY k, b),
d AS (SELECT k, b, max(t) AS t FROM e WHERE a = 'error' GROUP BY k, b),
s0 AS (SELECT k, {_each('@')}, t FROM w WHERE b = 0), {_state('s0', 1)}, {_state('s1', 2)}"""
_UPSERT_SQL = f"""{_STATES_SQL}
SELECT k AS "user", {_each('@')}, t AS event_timestamp FROM s2"""
_ORDER_SQL = "SELECT o_orderkey AS orderkey, {custkey} AS custkey, {status} AS status, {totalprice} AS totalprice, {priority} AS priority, CAST({t} AS BIGINT) AS event_timestamp FROM orders"
_PLAIN_COLUMNS = {"custkey": "o_custkey", "status": "o_orderstatus", "totalprice": "o_totalprice", "priority": "o_orderpriority", "t": "1"}


def _order_sql(**changed: str) -> str:
    return _ORDER_SQL.format(**(_PLAIN_COLUMNS | changed))


_LATEST_JSON = "(SELECT *, epoch_us(ts) // 1000 AS t, row_number() OVER (PARTITION BY user_id, event_type ORDER BY epoch_us(ts) // 1000 DESC) AS n FROM events) WHERE n = 1"
_K = "CAST(json_extract_string(props, '$.k') AS INT)"


def oracle_sql() -> dict[str, str]:
    first = KINDS[:3]
    presence = {c: f"CASE WHEN o_orderkey % 2 = 1 THEN {_PLAIN_COLUMNS[c]} END" for c in ("custkey", "totalprice", "priority")}
    return {
        "eav_roundtrip_customer": "SELECT c_custkey::VARCHAR AS custkey, c_nationkey AS nationkey, c_mktsegment AS mktsegment FROM customer",
        "eav_decode_types": "SELECT o_orderkey::VARCHAR AS orderkey, -o_custkey AS custkey, o_orderstatus = 'F' AS is_final, o_orderpriority AS priority, CAST(datediff('day', DATE '2030-01-01', o_orderdate::DATE) AS INT) AS day FROM orders",
        "eav_pivot_events": f"""WITH {_E},
lv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, a ORDER BY t DESC) AS n FROM e WHERE a <> 'error') WHERE n = 1)
SELECT k AS "user", {_each("max(CASE WHEN a = '@' THEN v END) AS @", first)}, {_each("max(CASE WHEN a = '@' THEN 1 ELSE 0 END) AS has_@", first)}, max(t) AS event_timestamp FROM lv GROUP BY k""",
        "eav_upsert_batches": _UPSERT_SQL,
        "stream_replay_eav": _UPSERT_SQL,
        "table_history": f"""SELECT version, CASE version WHEN 0 THEN 'WRITE' ELSE 'MERGE' END AS operation, rows - coalesce(lag(rows) OVER (ORDER BY version), 0) AS rows_inserted FROM (
{_STATES_SQL} SELECT CAST(0 AS BIGINT) AS version, (SELECT count(*) FROM s0) AS rows UNION ALL SELECT 1, (SELECT count(*) FROM s1) UNION ALL SELECT 2, (SELECT count(*) FROM s2))""",
        "verify_report": f"""SELECT 'events' AS "table", 'EavSpec' AS type, (SELECT count(*) FROM events) AS bronze_events, true AS silver_exists, CAST(2 AS BIGINT) AS silver_version,
(SELECT count(*) FROM ({_UPSERT_SQL})) AS silver_rows, CAST(0 AS BIGINT) AS dead_letters, true AS ok""",
        "trace_event": f"""WITH {_E},
m AS (SELECT a, max(t) AS ts_ms FROM e WHERE a <> 'error' AND k = (SELECT min(k) FROM e) GROUP BY a)
SELECT row_number() OVER (ORDER BY a) AS position, (SELECT min(k) FROM e) AS "user", a AS attribute, ts_ms FROM m""",
        "eav_event_time_ordering": f"""WITH {_E},
d AS (SELECT k, max(t) AS dt FROM e WHERE a = 'error' GROUP BY k),
m AS (SELECT e.* FROM e LEFT JOIN d USING (k) WHERE a <> 'error' AND (dt IS NULL OR t > dt)),
lv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, a ORDER BY t DESC) AS n FROM m) WHERE n = 1)
SELECT k AS "user", {_each("max(CASE WHEN a = '@' THEN v END) AS @")}, max(t) AS event_timestamp FROM lv GROUP BY k""",
        "json_expand_events": f"SELECT event_id, {_K} AS k, CAST(NULL AS DOUBLE) AS missing FROM events",
        "json_upsert": f"SELECT user_id, event_type, {_K} AS k, t AS event_timestamp FROM {_LATEST_JSON}",
        "json_partition_delete": f"SELECT user_id, event_type, CASE WHEN user_id % 7 <> 0 THEN {_K} END AS k, CASE WHEN user_id % 7 = 0 THEN {LATER} ELSE t END AS event_timestamp FROM {_LATEST_JSON}",
        "plain_upsert_nonnull": _order_sql(status="CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END", t="CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END"),
        "plain_upsert_presence": _order_sql(status="CASE WHEN o_orderkey % 4 = 0 THEN 'X' WHEN o_orderkey % 2 = 1 THEN o_orderstatus END", t="CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END", **presence),
        "plain_soft_delete": _order_sql(t="CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END", **{c: f"CASE WHEN o_orderstatus <> 'P' THEN {_PLAIN_COLUMNS[c]} END" for c in ("custkey", "status", "totalprice", "priority")}),
        "plain_late_guard": _order_sql(t="2"),
        "dedup_latest": f"SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS l_shipdate, {', '.join(_ITEM_ORDER[1:])} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC' for c in _ITEM_ORDER)}) AS n FROM lineitem) WHERE n = 1",
        "eav_decode_floats": "SELECT o_orderkey::VARCHAR AS orderkey, o_totalprice AS price, -o_totalprice / 7 AS less, o_totalprice::FLOAT::DOUBLE AS single FROM orders",
        "eav_attribute_delete": "SELECT o_orderkey::VARCHAR AS orderkey, o_custkey AS custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS event_timestamp FROM orders",
        "lenient_casts": "SELECT o_orderkey AS orderkey, trunc(o_totalprice::DECIMAL(20, 2))::INT AS whole, CASE o_orderstatus WHEN 'F' THEN false END AS final, NULL::INT AS none, o_custkey::FLOAT::DOUBLE AS real FROM orders",
        "event_ids": "SELECT o_orderkey AS orderkey, sha256('orders' || chr(1) || o_orderkey || chr(1) || '1') AS event_id FROM orders",
        "unique_event_ids": "SELECT count(*) AS rows, count(*) AS ids FROM orders",
        "null_first_key": "SELECT CASE WHEN event_id % 5 = 0 THEN 'dropped' ELSE 'mutation' END AS route, count(*) AS events FROM events GROUP BY 1",
        "dead_letters": "SELECT 'customer' AS \"table\", CAST(0 AS BIGINT) AS batch_id, 'corrupt' AS reason, md5('no event: ' || regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g')) AS line_md5 FROM documents",
        "several_tables": """SELECT 'events' AS "table", 'EavSpec' AS type, (SELECT count(*) FROM events) AS bronze_events, true AS silver_exists, CAST(0 AS BIGINT) AS silver_version,
(SELECT count(DISTINCT user_id) FROM events WHERE event_type <> 'error') AS silver_rows, CAST(0 AS BIGINT) AS dead_letters, true AS ok
UNION ALL SELECT 'customer', 'PlainSpec', (SELECT count(*) FROM customer) + (SELECT count(*) FROM documents), true, 0, (SELECT count(*) FROM customer), (SELECT count(*) FROM documents), true""",
        "stream_alerts": """WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type <> 'error')
SELECT 'unknown_attribute' AS kind, 'events' AS subject, 'purchase,signup' AS attributes, (SELECT count(*) FROM events WHERE event_type IN ('purchase', 'signup')) AS events, n AS rows_of_events FROM n
UNION ALL SELECT 'unknown_topic', 'strange', '', 0, n FROM n UNION ALL SELECT 'partition_change', 'customer', '', 0, n FROM n UNION ALL SELECT 'table_failure', 'customer', '', 0, n FROM n""",
        "table_details": """SELECT 'operations' AS part, CAST(2 AS BIGINT) AS rows UNION ALL SELECT 'events', 3 UNION ALL SELECT 'columns', 5 UNION ALL SELECT 'rows', 3
UNION ALL SELECT 'values of custkey', count(*) FROM customer UNION ALL SELECT 'history', 1 UNION ALL SELECT 'dead_letters', 3""",
        "partitioned_table": _order_sql(status="CASE WHEN o_orderkey % 4 = 0 THEN 'X' WHEN o_orderkey % 50 = 0 THEN 'Y' ELSE o_orderstatus END", t="CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END"),
        "partition_values": "SELECT DISTINCT CASE WHEN o_orderkey % 100 = 0 THEN '0-LATE' ELSE o_orderpriority END AS priority FROM orders",
        "changed_columns": "SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 5000000000 ELSE o_custkey END AS custkey, o_orderpriority AS urgency, CASE WHEN o_orderkey % 5 = 0 THEN 'seen' END AS note, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS event_timestamp FROM orders",
        "two_writers": _order_sql(status="CASE o_orderkey % 4 WHEN 0 THEN 'W0' WHEN 2 THEN 'W2' ELSE o_orderstatus END", t="CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END"),
        "key_range": f"{_order_sql()} WHERE o_orderkey BETWEEN 1000 AND 2000",
        "corrupt_route": "SELECT 'corrupt' AS route, (SELECT count(*) FROM documents) + (SELECT count(*) FROM customer WHERE c_nationkey = 3) AS events UNION ALL SELECT 'mutation', count(*) FROM customer",
        "op_breakdown": "SELECT CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'O' THEN 'u' ELSE 'i' END AS op, count(*) AS events FROM orders GROUP BY 1",
        "distinct_partitions": "SELECT DISTINCT c_mktsegment AS mktsegment FROM customer WHERE c_mktsegment IS NOT NULL",
        "unknown_attributes": "SELECT DISTINCT event_type AS attribute FROM events WHERE event_type NOT IN ('click', 'view', 'error')",
        "enrich_event_date": "SELECT event_id AS id, epoch_us(ts) // 1000 AS event_timestamp, ts::DATE AS event_date FROM events",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        eav_roundtrip_customer, eav_decode_types, eav_pivot_events, eav_upsert_batches, eav_event_time_ordering, json_expand_events, json_upsert,
        json_partition_delete, plain_upsert_nonnull, plain_upsert_presence, plain_soft_delete, plain_late_guard, dedup_latest, corrupt_route, op_breakdown,
        distinct_partitions, unknown_attributes, enrich_event_date, stream_replay_eav, table_history, verify_report, trace_event,
        eav_decode_floats, eav_attribute_delete, lenient_casts, event_ids, unique_event_ids, null_first_key, dead_letters, several_tables, stream_alerts, table_details, partitioned_table, partition_values, changed_columns, two_writers, key_range,
    ]
    return {f.__name__: f for f in found}
