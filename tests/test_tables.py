"""Golden replays, edge cases of the three table types, versioned tables and streams."""

import base64
import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_config import EAV, JSON, PLAIN
from tidewell.config import build
from tidewell.plans.batch import plan_batch, replay
from tidewell.sources.bronze import read_lines, unconfigured_topics, write_lines
from tidewell.streaming import runner
from tidewell.streaming.store import SnapshotStore
from tidewell.trace import trace_entity
from tidewell.verify import details, operation_breakdown, report


def line(ts, op, **cells):
    return json.dumps({"ts_ms": ts, "op": op, "after": {k: None if v == "unset" else {"value": v, "deletion_ts": None, "set": True} for k, v in cells.items()}, "source": {"version": "x"}})


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json_str string")


def attr(ts, key, name, blob, op="i"):
    return line(ts, op, key=key, column2=name, value=None if blob is None else base64.b64encode(blob).decode())


USERS = build("users", EAV | {"partition_by": "pilot_id", "attributes": {"pilotId": {"wide": "pilot_id", "type": "int"}, "userStatus": {"wide": "user_status", "type": "text"}, "isTestUser": {"wide": "is_test_user", "type": "boolean"}}})
WEATHER = build("weather", JSON)
PILOTS = build("pilots", PLAIN | {"columns": [{"name": "id", "type": "int"}, {"name": "name", "type": "text"}, {"name": "active", "type": "boolean"}]})


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_attribute_rows_become_one_wide_row(spark):
    seed = [attr(5, "u1", "pilotId", b"\x00\x00\x27\x84"), attr(6, "u1", "userStatus", b"ENABLED"), attr(7, "u1", "isTestUser", b"\x00"), attr(5, "u2", "pilotId", b"\x00\x00\x27\x85")]
    table = replay(spark, [lines(spark, *seed * 3)], USERS)
    assert rows(table, "uuid", "pilot_id", "user_status", "is_test_user", "event_timestamp", "deduptime") == [("u1", 10116, "ENABLED", False, 7, 7), ("u2", 10117, None, None, 5, 5)]
    assert [f.name for f in table.schema] == ["uuid", "pilot_id", "user_status", "is_test_user", "event_id", "event_timestamp", "event_date", "deduptime"]


def test_attribute_updates_deletes_and_tombstones(spark):
    first = lines(spark, attr(1, "u1", "pilotId", b"\0\0\0\1"), attr(1, "u1", "userStatus", b"A"), attr(1, "u2", "pilotId", b"\0\0\0\2"))
    second = lines(spark, attr(2, "u1", "userStatus", None), attr(2, "u3", "brandNew", b"x"), line(3, "d", key="u2", column2=None), line(3, "d", key="u9", column2=None))
    table = replay(spark, [first, second], USERS)
    assert rows(table, "uuid", "pilot_id", "user_status", "event_timestamp") == [("u1", 1, None, 2), ("u2", None, None, 3), ("u3", None, None, 2)]
    # within one batch deletes go first, unless order by event time is asked for
    both = lines(spark, attr(1, "u1", "pilotId", b"\0\0\0\1"), line(2, "d", key="u1", column2=None))
    assert rows(replay(spark, [both], USERS), "uuid", "pilot_id") == [("u1", 1)]
    assert rows(replay(spark, [both], replace(USERS, ordering="event_time")), "uuid", "pilot_id") == []


def test_ties_do_not_depend_on_the_order_of_lines(spark):
    events = [attr(1, "u1", "pilotId", bytes([0, 0, 0, i])) for i in range(6)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(events)
        seen.add(tuple(rows(replay(spark, [lines(spark, *events)], USERS), "uuid", "pilot_id")))
    assert len(seen) == 1


def test_json_rows(spark):
    doc = lambda v: json.dumps({"temp": v})
    first = lines(spark, line(1, "i", country="US", minute="5", j=doc("55.25")), line(1, "i", country="US", minute="6", j=doc(None)), line(1, "i", country="DE", minute="5", j="not json"), "no json at all", line(1, "i", country=None, minute="5", j="{}"))
    second = lines(spark, line(9, "d", country="US", minute=None, j=None), line(9, "i", country="DE", minute="5", j=doc("1.5")), line(9, "i", country="DE", minute=None, j="{}"))
    assert rows(replay(spark, [first], WEATHER), "country", "minute", "temp", "event_timestamp") == [("DE", 5, None, 1), ("US", 5, 55.25, 1), ("US", 6, None, 1)]
    assert rows(replay(spark, [first, second], WEATHER), "country", "minute", "temp", "event_timestamp") == [("DE", 5, 1.5, 9), ("US", 5, None, 9), ("US", 6, None, 9)]
    counts = {r.route: r["count"] for r in plan_batch(first, WEATHER).routed.groupBy("route").count().collect()}
    assert counts == {"corrupt": 1, "dropped": 1, "mutation": 3}


def test_prefix_deletes_with_two_clustering_keys(spark):
    spec = build("w", JSON | {"clustering_keys": [{"name": "minute", "type": "int"}, {"name": "second", "type": "int"}], "merge_key": ["country", "minute", "second"]})
    put = [line(1, "i", country="US", minute=str(m), second=str(s), j='{"temp": 1}') for m in (1, 2) for s in (1, 2)]
    gone = lines(spark, line(5, "d", country="US", minute="1", second=None))
    got = rows(replay(spark, [lines(spark, *put), gone], spec), "minute", "second", "temp")
    assert got == [(1, 1, None), (1, 2, None), (2, 1, 1.0), (2, 2, 1.0)]


def test_plain_rows(spark):
    first = lines(spark, line(1, "i", id=1, name="a", active=True), line(1, "i", id=2, name="b", active=False), line(1, "i", id=None, name="lost"), line(1, None, id=3, name="no op"))
    second = lines(spark, line(2, "u", id=1, name="unset", active=False), line(2, "u", id=2, name=None, active="unset"), line(2, "d", id=9))
    assert rows(replay(spark, [first, second], PILOTS), "id", "name", "active", "event_timestamp") == [(1, "a", False, 2), (2, "b", False, 2)]
    assert rows(replay(spark, [first, second], replace(PILOTS, null_policy="presence")), "id", "name", "active") == [(1, "a", False), (2, None, False)]
    assert rows(replay(spark, [first, lines(spark, line(3, "d", id=1))], PILOTS), "id", "name", "event_timestamp") == [(1, None, 3), (2, "b", 1)]
    late = lines(spark, line(0, "u", id=1, name="old"))
    assert rows(replay(spark, [first, late], PILOTS), "id", "name") == [(1, "old"), (2, "b")]
    assert rows(replay(spark, [first, late], replace(PILOTS, guard="event_timestamp")), "id", "name") == [(1, "a"), (2, "b")]


def test_applying_a_batch_twice_is_applying_it_once(spark):
    spec = replace(PILOTS, event_ids="deterministic")
    batch = lines(spark, *(line(t, random.Random(t).choice("iud"), id=t % 5, name=f"n{t}") for t in range(30)))
    assert rows(replay(spark, [batch, batch], spec), "*") == rows(replay(spark, [batch, batch, batch], spec), "*")


@pytest.fixture
def placed(tmp_path):
    def place(spec):
        at = {f: f"file://{tmp_path}/{f}/{spec.name}" for f in ("bronze_path", "silver_path", "checkpoint_path", "dead_letter_path")}
        return replace(spec, **at)

    return place


def test_versions(spark, placed):
    spec = placed(USERS)
    store = SnapshotStore(spark, spec, buckets=4)
    assert not store.exists() and store.detail() is None and store.history().collect() == [] and store.read().collect() == []
    put = lines(spark, *(attr(1, f"u{i}", "pilotId", bytes([0, 0, 0, i % 3])) for i in range(20)))
    assert store.merge(plan_batch(put, spec), "q", 0) == 0
    assert store.merge(plan_batch(put, spec), "q", 0) is None  # a replay
    assert store.merge(plan_batch(lines(spark, "corrupt"), spec), "q", 1) is None
    assert store.merge(plan_batch(lines(spark, attr(2, "u3", "userStatus", b"B")), spec), "q", 2) == 1
    assert store.latest()["metrics"] == {"numOutputRows": 1, "numTargetRowsInserted": 0, "numBucketsRewritten": 0, "numDeltas": 1}
    assert store.read().count() == 20 and store.read().filter("user_status = 'B' and pilot_id = 0").count() == 1
    assert store.read(0).filter("user_status is not null").count() == 0
    assert store.compact() == 2 and store.compact() is None and store.read().count() == 20
    assert [r.operation for r in store.history(2).collect()] == ["COMPACT", "MERGE"]
    assert store.expire(1) == [0, 1] and store.read().count() == 20 and [r.operation for r in store.history().collect()] == ["COMPACT"]
    # a column added to the configuration is NULL in old rows
    wider = replace(spec, attributes=(*spec.attributes, ("x", "x", "int")))
    assert SnapshotStore(spark, wider).merge(plan_batch(lines(spark, attr(3, "u5", "x", b"\0\0\0\7")), wider)) == 3
    assert rows(SnapshotStore(spark, wider).read().filter("x is not null"), "uuid", "pilot_id", "x") == [("u5", 2, 7)]


def test_a_small_batch_writes_in_proportion_to_itself(spark, placed):
    spec = replace(placed(PILOTS), buckets=4)
    store = SnapshotStore(spark, spec)
    put = spark.range(20_000).select(F.format_string('{"ts_ms":1,"op":"i","after":{"id":{"value":%d},"name":{"value":"name %d"}}}', "id", "id").alias("json_str"))
    assert store.merge(plan_batch(put, spec)) == 0
    # old keys in every bucket, a new key, an old one deleted
    for batch in range(3):
        small = lines(spark, *(line(2 + batch, "u", id=i, name=f"changed {batch}") for i in range(20)), line(2, "i", id=30_000 + batch, name="new"), line(2, "d", id=100 + batch))
        assert store.merge(plan_batch(small, spec)) == batch + 1
        assert store.latest()["metrics"] == {"numOutputRows": 22, "numTargetRowsInserted": 1, "numBucketsRewritten": 0, "numDeltas": 4}
    whole, deltas = (sum(x[i] for x in store.sizes().values()) for i in (0, 1))
    assert whole > 100_000 > 2 * deltas
    assert store.read().count() == 20_003 and store.read().filter("name = 'changed 2'").count() == 20 and store.read().filter("name is null").count() == 3
    assert store.read(1).filter("name = 'changed 0'").count() == 20 and store.read(0).count() == 20_000
    # keys that the table lacks only
    assert store.merge(plan_batch(lines(spark, line(9, "i", id=50_000, name="x")), spec)) == 4 and store.latest()["metrics"]["numTargetRowsInserted"] == 1
    assert store.merge(plan_batch(lines(spark, line(9, "d", id=60_000)), spec)) == 5 and store.latest()["metrics"]["numOutputRows"] == 0
    before = rows(store.read(), "*")
    assert store.expire(1) == [] and rows(store.read(), "*") == before
    assert store.compact() == 6 and rows(store.read(), "*") == before and store.expire(1) == [0, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("kind", ["eav", "json", "plain"])
def test_deltas_give_the_rows_of_a_replay(spark, placed, monkeypatch, kind):
    """Random batches, with NULL keys, prefix deletes and rewrites in between, against full merges."""
    monkeypatch.setattr("tidewell.streaming.store.DELTA_SHARE", 1000)
    monkeypatch.setattr("tidewell.streaming.store.DELTAS", 3)
    pick = random.Random(kind)
    if kind == "eav":
        spec = USERS
        one = lambda t: line(t, "d", key=f"u{pick.randrange(6)}", column2=None) if pick.random() < 0.2 else attr(t, f"u{pick.randrange(6)}", pick.choice(["pilotId", "other"]), bytes([0, 0, 0, t]))
    elif kind == "json":
        spec = build("w", JSON | {"clustering_keys": [{"name": "minute", "type": "int"}, {"name": "second", "type": "int"}], "merge_key": ["country", "minute", "second"]})
        one = lambda t: line(t, pick.choice("iiid"), country=pick.choice(["US", "DE", "FR"]), minute=pick.choice(["1", "2", None]), second=pick.choice(["1", "2", None]), j=json.dumps({"temp": t}))
    else:
        spec = PILOTS
        one = lambda t: line(t, pick.choice("iud"), id=pick.randrange(6), name=pick.choice(["a", "b", "unset"]))
    spec = replace(placed(spec), buckets=2, event_ids="deterministic")
    batches = [lines(spark, *(one(10 * b + i) for i in range(4 if b else 12))) for b in range(6)]
    store = SnapshotStore(spark, spec)
    deltas = 0
    for batch in batches:
        store.merge(plan_batch(batch, spec), deletes=True)
        deltas += store.latest()["metrics"]["numDeltas"]
    assert deltas > 4 and sorted(map(str, store.read().collect())) == sorted(map(str, replay(spark, batches, spec).select(*store.read().columns).collect()))


def test_partition_layout_is_frozen(spark, placed):
    spec, alerts = placed(USERS), []
    SnapshotStore(spark, spec).merge(plan_batch(lines(spark, attr(1, "u", "pilotId", b"\0\0\0\1")), spec))
    SnapshotStore(spark, spec).check_partitions()
    with pytest.raises(ValueError):
        SnapshotStore(spark, replace(spec, partition_by=()), alert=alerts.append).check_partitions()
    assert [a.kind for a in alerts] == ["partition_change"]


def test_lines_on_disk(spark, tmp_path):
    path = f"file://{tmp_path}/topics/t"
    texts = [line(1781082674559, "i", id=1, name='quote " comma , é\\n'), line(0, "u", id=2, name="x")]
    write_lines(lines(spark, *texts), path)
    assert sorted(r.json_str for r in read_lines(spark, path).collect()) == sorted(texts)
    assert len(list(tmp_path.glob("topics/t/year=2026/month=06/day=10/hour=09/*.json"))) == 1
    assert unconfigured_topics(spark, f"file://{tmp_path}/topics", {"other"}) == ["t"] and unconfigured_topics(spark, f"file://{tmp_path}/none", set()) == []


def dead_letters(spark, spec, batch):
    return spark.read.option("recursiveFileLookup", "true").json(spec.dead_letter_path).filter(F.col("batch_id") == batch)


def test_a_new_checkpoint_loses_nothing(spark, placed, tmp_path):
    """Batch numbers start anew with a checkpoint: neither events nor dead letters are taken for old ones."""
    spec = replace(placed(USERS), keep_versions=2, buckets=3)
    for turn in (1, 2, 3):
        write_lines(lines(spark, attr(turn, f"u{turn}", "pilotId", bytes([0, 0, 0, turn])), f"corrupt {turn}"), spec.bronze_path)
        one = replace(spec, checkpoint_path=f"{spec.checkpoint_path}/{turn}")
        runner.start(spark, one, once=True).awaitTermination()
    store = SnapshotStore(spark, spec)
    assert rows(store.read(), "uuid", "pilot_id") == [("u1", 1), ("u2", 2), ("u3", 3)] and store.buckets == 3
    bad = [r.json_str for r in dead_letters(spark, spec, 0).collect()]
    assert sorted(set(bad)) == ["corrupt 1", "corrupt 2", "corrupt 3"] and len(bad) == 6  # a new checkpoint reads all files again
    assert [r.version for r in store.history().collect()] == [2, 1] and len(store.latest()["batches"]) == 3
    assert store.compact(buckets=5) == 3 and store.compact(buckets=5) is None and rows(SnapshotStore(spark, spec).read(), "uuid") == [("u1",), ("u2",), ("u3",)]
    seen = details(spark, spec)
    assert [(r.op, r.events) for r in seen["operations"].filter("op is not null").collect()] == [("i", 3)] and seen["events"].count() == 3
    assert rows(seen["values of pilot_id"], "pilot_id") == [(1,), (2,), (3,)] and rows(seen["values of uuid"], "uuid") == [("u1",), ("u2",), ("u3",)]
    assert seen["columns"].count() == len(store.read().columns) and seen["history"].first().operation == "COMPACT" and seen["dead_letters"].count() == 3 and seen["rows"].count() == 3


def test_the_log_is_not_read_again(spark, placed):
    spec = placed(USERS)
    store = SnapshotStore(spark, spec)
    for batch in range(3):
        store.merge(plan_batch(lines(spark, attr(batch, "u1", "pilotId", bytes([0, 0, 0, batch]))), spec), "q", batch)
    assert store.expire(1) == [0, 1] and store.committed("q", 0) and store.committed("q", 2) and not store.committed("q", 3) and not store.committed("other", 0)
    assert store.merge(plan_batch(lines(spark, attr(9, "u1", "pilotId", b"\0\0\0\7")), spec), "q", 1) is None


def test_trace(spark):
    batch = lines(spark, attr(1, "u1", "pilotId", b"\0\0\0\1"), attr(2, "u1", "pilotId", b"\0\0\0\2"), attr(1, "u1", "userStatus", b"A"), attr(1, "u2", "pilotId", b"\0\0\0\3"))
    got = [(r.step, r.position) for r in trace_entity(batch, USERS).collect()]
    assert got == [("parsed", 1), ("parsed", 2), ("parsed", 3), ("latest", 1), ("latest", 2), ("shaped", 1)]
    shaped = json.loads(trace_entity(batch, USERS, "u2").filter("step = 'shaped'").first().content)
    assert shaped["uuid"] == "u2" and shaped["pilot_id"] == 3 and shaped["has_user_status"] == 0


def test_plans_parse_and_decode_once(spark):
    batch = lines(spark, attr(1, "u1", "pilotId", b"\0\0\0\1"), line(2, "d", key="u1", column2=None))
    plan = replay(spark, [batch], USERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("unbase64(") == len(USERS.attributes)


def test_streams(spark, placed, monkeypatch):
    spec, other, alerts, counts = placed(USERS), placed(PILOTS), [], []
    put = [attr(1, "u1", "pilotId", b"\0\0\0\1"), attr(1, "u1", "strange", b"x"), '{"ts_ms": "x"}']
    write_lines(lines(spark, *put), spec.bronze_path)
    tables = {"users": spec, "pilots": replace(other, enabled=True), "off": replace(other, enabled=False)}
    runner.run(spark, tables, alert=alerts.append, once=True)
    assert [(a.kind, a.details) for a in alerts] == [("unknown_attribute", {"attributes": ["strange"], "events": 1})]
    assert rows(SnapshotStore(spark, spec).read(), "uuid", "pilot_id") == [("u1", 1)]
    dead = dead_letters(spark, spec, 0)
    assert rows(dead, "table", "batch_id", "reason", "json_str") == [("users", 0, "corrupt", '{"ts_ms": "x"}')]
    # nothing new: nothing happens; then a failing batch is kept aside and the stream goes on
    runner.start(spark, spec, once=True, on_counts=lambda b, c: counts.append(c)).awaitTermination()
    assert counts == [] and SnapshotStore(spark, spec).latest()["version"] == 0
    write_lines(lines(spark, attr(2, "u2", "pilotId", b"\0\0\0\2")), spec.bronze_path)

    def fail(*_):
        raise RuntimeError("injected")

    runner.start(spark, spec, alerts.append, once=True, on_counts=fail).awaitTermination()
    assert alerts[-1].kind == "table_failure" and "injected" in dead_letters(spark, spec, 1).first().reason
    write_lines(lines(spark, attr(3, "u3", "pilotId", b"\0\0\0\3")), spec.bronze_path)
    runner.start(spark, spec, once=True, on_counts=lambda b, c: counts.append(c)).awaitTermination()
    assert counts == [{"mutation": 1}] and rows(SnapshotStore(spark, spec).read(), "uuid") == [("u1",), ("u3",)]
    seen = {r.table: r for r in report(spark, tables).collect()}
    assert (seen["users"].bronze_events, seen["users"].silver_rows, seen["users"].dead_letters) == (5, 2, 2) and not seen["pilots"].ok and "off" not in seen
    assert rows(operation_breakdown(spark, spec).filter(F.col("op").isNotNull()), "op", "events") == [("i", 4)]
