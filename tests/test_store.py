"""The stored table at work: plans, log, concurrent writers, skipped files, changed columns, retries."""

import json
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_config import JSON, PLAIN
from tests.test_tables import PILOTS, USERS, attr, dead_letters, line, lines, placed, rows  # noqa: F401
from tidewell.__main__ import session
from tidewell.config import build
from tidewell.plans.batch import plan_batch, replay
from tidewell.sources.bronze import write_lines
from tidewell.streaming import runner
from tidewell.streaming.columns import SchemaChange
from tidewell.streaming.log import DataFile, TableLog, put_if_absent
from tidewell.streaming.store import SnapshotStore


def put(spark, spec, ids, name, ts=1):
    return plan_batch(lines(spark, *(line(ts, "i", id=i, name=name) for i in ids)), spec)


def many(spark, spec, n):
    made = spark.range(n).select(F.format_string('{"ts_ms":1,"op":"i","after":{"id":{"value":%d},"name":{"value":"name %d"}}}', "id", "id").alias("json_str"))
    return plan_batch(made, spec)


def scans(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_scans_do_not_grow_with_versions_and_lists_spare_records(spark, placed, monkeypatch):  # noqa: F811
    monkeypatch.setattr("tidewell.streaming.store.DELTA_SHARE", 10**6)
    monkeypatch.setattr("tidewell.streaming.store.DELTAS", 60)
    spec = replace(placed(PILOTS), buckets=8)
    store = SnapshotStore(spark, spec)
    store.merge(many(spark, spec, 40))
    want, before = {i: f"name {i}" for i in range(40)}, {}
    for v in range(1, 52):
        ids = [v % 40, (7 * v) % 40, 100 + v]
        store.merge(put(spark, spec, ids, f"v{v}", v + 1))
        want |= {i: f"v{v}" for i in ids}
        if v in (1, 9, 30):
            before[v] = dict(want)
        if v in (1, 12, 51):
            assert scans(store.read()) == 2
    assert store.latest()["version"] == 51 and dict(rows(store.read(), "id", "name")) == want
    for v, held in before.items():
        assert dict(rows(store.read(v), "id", "name")) == held
    # a reader takes the last list and the records since
    opened = []
    monkeypatch.setattr(TableLog, "record", lambda self, v, real=TableLog.record: opened.append(v) or real(self, v))
    store.log.files(51)
    assert opened == [50, 51]
    assert store.compact() == 52 and scans(store.read()) == 1 and dict(rows(store.read(), "id", "name")) == want
    assert len(store.expire(1)) == 52 and dict(rows(store.read(), "id", "name")) == want and store.log.versions() == [52]


def test_a_commit_is_as_large_as_what_it_touches(spark, placed, tmp_path):  # noqa: F811
    sizes = {}
    for buckets in (4, 400):
        spec = replace(placed(PILOTS), silver_path=f"file://{tmp_path}/t{buckets}", buckets=buckets)
        store = SnapshotStore(spark, spec)
        store.merge(many(spark, spec, 4000))
        store.merge(put(spark, spec, [5], "x"))
        first, second = (len(json.dumps(store.log.record(v))) for v in (0, 1))
        assert len(store.log.files(0)) == buckets and [f.bucket for f in store.log.files(1, {99})] == ([99] if buckets == 400 else [])
        sizes[buckets] = first, second
    assert sizes[400][0] > 20 * sizes[4][0] and abs(sizes[400][1] - sizes[4][1]) < 60


def interrupted(monkeypatch, store, other):
    """``store`` whose next write is followed by ``other()``, before it is committed."""
    real, turns = SnapshotStore._write, []

    def write(self, *args, **kwargs):
        made = real(self, *args, **kwargs)
        if self is store:
            turns.append(1)
            if len(turns) == 1:
                other()
        return made

    monkeypatch.setattr(SnapshotStore, "_write", write)
    return turns


def of_bucket(store, spec, spark, bucket, n=3):
    """Ids that fall into a bucket."""
    ids = spark.range(500).select(F.col("id").cast("int").alias("id")).filter(store._bucket(F.col("id")) == bucket).limit(n).collect()
    return [r[0] for r in ids]


def test_writers_of_other_buckets_both_land(spark, placed, monkeypatch):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=4)
    one, two = SnapshotStore(spark, spec), SnapshotStore(spark, spec)
    one.merge(many(spark, spec, 100))
    a, b = of_bucket(one, spec, spark, 0), of_bucket(one, spec, spark, 1)
    turns = interrupted(monkeypatch, one, lambda: two.merge(put(spark, spec, b, "two", 2), "other", 7))
    assert one.merge(put(spark, spec, a, "one", 2), "mine", 3) == 2 and len(turns) == 1
    assert rows(one.read().filter("name in ('one', 'two')"), "id", "name") == sorted([(i, "one") for i in a] + [(i, "two") for i in b])
    assert one.latest()["batches"] == {"mine": 3, "other": 7} and one.read().count() == 100


def test_writers_of_one_bucket_go_one_after_another(spark, placed, monkeypatch):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=4, guard="event_timestamp")
    one, two = SnapshotStore(spark, spec), SnapshotStore(spark, spec)
    one.merge(many(spark, spec, 100))
    a = of_bucket(one, spec, spark, 0)
    turns = interrupted(monkeypatch, one, lambda: two.merge(put(spark, spec, a[:2], "two", 5)))
    assert one.merge(put(spark, spec, a, "one", 2)) == 2 and len(turns) == 2
    # the second attempt saw the newer rows of the other writer
    assert rows(one.read().filter(F.col("id").isin(a)), "id", "name") == sorted([(a[0], "two"), (a[1], "two"), (a[2], "one")])
    # the same batch by two runs of a query is applied once
    turns = interrupted(monkeypatch, one, lambda: two.merge(put(spark, spec, a, "again", 9), "q", 1))
    assert one.merge(put(spark, spec, a, "again", 9), "q", 1) is None and len(turns) == 1 and one.latest()["version"] == 3


def test_a_compaction_and_a_batch_at_once(spark, placed, monkeypatch):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=4)
    one, two = SnapshotStore(spark, spec), SnapshotStore(spark, spec)
    one.merge(many(spark, spec, 20_000))
    one.merge(put(spark, spec, range(30), "first", 2))
    interrupted(monkeypatch, one, lambda: two.merge(put(spark, spec, range(10), "second", 3)))
    assert one.compact() == 3  # the batch came in between and stays on top
    want = [(i, "second" if i < 10 else "first") for i in range(30)]
    assert rows(one.read().filter("id < 30"), "id", "name") == want and one.read().count() == 20_000
    # a compaction in between does not disturb a batch
    turns = interrupted(monkeypatch, two, lambda: one.compact())
    assert two.merge(put(spark, spec, range(5), "third", 4)) == 5 and len(turns) == 1
    want = [(i, "third" if i < 5 else n) for i, n in want]
    assert rows(one.read().filter("id < 30"), "id", "name") == want
    # buckets that another writer rewrote are left out of a compaction
    monkeypatch.setattr("tidewell.streaming.store.DELTAS", 0)
    ids = of_bucket(one, spec, spark, 2)
    interrupted(monkeypatch, one, lambda: two.merge(put(spark, spec, ids, "rewritten", 5)))
    assert one.compact() == 7 and "2" not in one.latest()["floors"] and len(one.latest()["floors"]) == 3
    assert rows(one.read().filter("name = 'rewritten'"), "id") == [(i,) for i in sorted(ids)] and one.read().count() == 20_000
    # another number of buckets is a new layout: whoever began before starts again
    turns = interrupted(monkeypatch, two, lambda: one.compact(buckets=3))
    assert two.merge(put(spark, spec, range(5), "last", 6)) == 9 and len(turns) == 2 and two.buckets == 3
    assert one.read().filter("name = 'last'").count() == 5 and one.read().count() == 20_000 and max(one.sizes()) == 2


def test_many_writers(spark, placed):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=2)
    SnapshotStore(spark, spec).merge(put(spark, spec, range(8), "x"))
    errors = []

    def work(k):
        try:
            store = SnapshotStore(spark, spec)
            for turn in range(3):
                store.merge(put(spark, spec, [100 * k + turn], f"w{k}", 2), f"query {k}", turn)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(1, 4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    store = SnapshotStore(spark, spec)
    assert not errors and store.latest()["version"] == 9 and store.read().count() == 17 and store.latest()["batches"] == {f"query {k}": 2 for k in range(1, 4)}


def test_a_name_is_taken_once(spark, tmp_path):
    folder = f"file://{tmp_path}/log"
    assert put_if_absent(spark, folder, "0.json", "a") and not put_if_absent(spark, folder, "0.json", "b")
    assert (tmp_path / "log/0.json").read_text() == "a" and [p.name for p in (tmp_path / "log").iterdir()] == ["0.json"]


def test_a_batch_opens_the_files_that_may_hold_its_keys(spark, placed):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=1, file_rows=1000)
    store = SnapshotStore(spark, spec)
    store.merge(many(spark, spec, 20_000))
    store.compact(buckets=2)
    store.compact(buckets=1)
    assert len(store.log.files(store.latest()["version"])) >= 20
    for turn, key in enumerate((5, 19_999, 7777, 50_000)):
        store.merge(put(spark, spec, [key], "new", 2 + turn))
        assert store.latest()["filesRead"] <= 2, turn
    assert store.read().count() == 20_001 and store.read().filter("name = 'new'").count() == 4
    bounded = DataFile(0, 0, "w", 1, False, "p", 1, 1, '"b"', '"d"')
    assert bounded.may_hold("a", "b") and not bounded.may_hold("a", "az") and not bounded.may_hold("e", "f") and bounded.may_hold(None, None) and replace(bounded, low=None).may_hold("x", "y")


def test_ranges_and_sizes_after_a_compaction(spark, placed):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=2, target_mb=1)
    store = SnapshotStore(spark, spec)
    made = spark.range(150_000).select(F.format_string('{"ts_ms":1,"op":"i","after":{"id":{"value":%d},"name":{"value":"%s"}}}', "id", F.sha2(F.col("id").cast("string"), 256)).alias("json_str"))
    store.merge(plan_batch(made, spec))
    store.merge(put(spark, spec, range(1000, 1010), "new", 2))
    store.compact()
    files = store.log.files(store.latest()["version"])
    # the part of the range at the edge of two buckets has a file in each
    assert len(files) >= 10 and sum(not 1 << 19 <= f.bytes <= 1 << 21 for f in files) <= 2 * 2
    assert sum(f.may_hold(1000, 1200) for f in files) <= 4
    store.merge(put(spark, spec, [1100, 160_000], "newer", 3))
    got = store.read(between=(1000, 1200))
    assert got.count() == 201 and rows(got.filter("name like 'new%'"), "id", "name") == sorted([(i, "new") for i in range(1000, 1010)] + [(1100, "newer")]) and scans(got) == 2
    assert store.read(between=(150_000, 170_000)).count() == 1 and store.read(between=(-5, -1)).count() == 0


def test_partition_values_come_from_the_log(spark, placed):  # noqa: F811
    spec = replace(placed(build("p", PLAIN | {"partition_by": ["name"], "columns": [{"name": "id", "type": "int"}, {"name": "name", "type": "text"}]})), buckets=4)
    store = SnapshotStore(spark, spec)
    assert rows(store.values("name"), "name") == []
    store.merge(plan_batch(lines(spark, *(line(1, "i", id=i, name=["a/b", "c d", None, "é%"][i % 4]) for i in range(4000))), spec))
    seen = store.values("name")
    assert rows(seen, "name") == [("a/b",), ("c d",), ("é%",)] and scans(seen) == 0
    # the only row of a value moves on: the value goes, though its file is still there
    store.merge(put(spark, spec, [9000], "once"))
    store.merge(put(spark, spec, [9000], "moved", 2))
    assert rows(store.values("name"), "name") == [("a/b",), ("c d",), ("moved",), ("é%",)]
    assert store.read().count() == 4001 and [tuple(r) for r in store.count("n").collect()] == [(4001,)] and scans(store.count()) == 2
    store.compact()
    assert scans(store.count()) == 0 and store.count().first().rows == 4001 and SnapshotStore(spark, replace(spec, silver_path=spec.silver_path + "-none")).count().first().rows == 0


def test_long_text_keys_and_null_keys_are_never_skipped(spark, placed):  # noqa: F811
    spec = replace(placed(USERS), buckets=1)
    store, keys = SnapshotStore(spark, spec), ["k" * 300 + c for c in "abc"] + ["ÿ" * 200, "😀" * 150]
    store.merge(plan_batch(lines(spark, *(attr(1, k, "pilotId", b"\0\0\0\1") for k in keys)), spec))
    for n, k in enumerate(keys):
        store.merge(plan_batch(lines(spark, attr(2 + n, k, "userStatus", b"S")), spec))
    assert store.read().count() == 5 and store.read().filter("user_status = 'S' and pilot_id = 1").count() == 5


def typed(spec, **kinds):
    return replace(spec, columns=tuple((c, kinds.get(c, t)) for c, t in spec.columns))


def test_columns_that_files_cannot_take_are_refused_before_anything_is_written(spark, placed):  # noqa: F811
    spec, alerts = placed(build("wide", PLAIN | {"columns": [{"name": "id", "type": "int"}, {"name": "a", "type": "int"}, {"name": "f", "type": "float"}]})), []
    store = SnapshotStore(spark, spec)
    store.merge(plan_batch(lines(spark, line(1, "i", id=1, a=7, f="1.5"), line(1, "i", id=2, a=8, f="2.5")), spec))
    for bad in (typed(spec, a="text"), typed(spec, a="boolean"), typed(spec, f="int"), typed(spec, id="bigint")):
        other = SnapshotStore(spark, bad, alert=alerts.append)
        with pytest.raises(SchemaChange):
            other.merge(plan_batch(lines(spark, line(2, "u", id=1, a="x")), bad))
        with pytest.raises(SchemaChange):
            other.check_partitions()
    assert [a.kind for a in alerts] == ["schema_change"] * 8 and "stored as int and configured as string" in alerts[0].message
    assert store.latest()["version"] == 0 and rows(store.read(), "id", "a", "f") == [(1, 7, 1.5), (2, 8, 2.5)]
    assert store.merge(plan_batch(lines(spark, line(2, "u", id=2, a=9)), spec)) == 1
    # wider types
    wide = typed(spec, a="bigint", f="double")
    assert SnapshotStore(spark, wide).merge(plan_batch(lines(spark, line(3, "u", id=1, a=5_000_000_000), line(3, "i", id=3, f="0.1")), wide)) == 2
    assert rows(SnapshotStore(spark, wide).read().orderBy("id").select("id", F.coalesce("a", F.lit(0)).alias("a"), "f"), "id", "a", "f") == [(1, 5_000_000_000, 1.5), (2, 9, 2.5), (3, 0, 0.1)]
    with pytest.raises(SchemaChange):  # and not back
        SnapshotStore(spark, spec, alert=alerts.append).check_partitions()
    assert rows(store.read(1), "id", "a") == [(1, 7), (2, 9)]


def test_renamed_dropped_and_returning_columns(spark, placed):  # noqa: F811
    spec = replace(placed(build("named", PLAIN | {"partition_by": ["kind"], "columns": [{"name": c, "type": t} for c, t in (("id", "int"), ("kind", "text"), ("a", "int"))]})), buckets=2)
    SnapshotStore(spark, spec).merge(plan_batch(lines(spark, line(1, "i", id=1, kind="x/y", a=7), line(1, "i", id=2, kind="z", a=8)), spec))
    new = replace(spec, columns=(("id", "int"), ("sort", "text"), ("b", "int")), partition_by=("sort",), renames=(("a", "b"), ("kind", "sort")))
    store = SnapshotStore(spark, new)
    store.check_partitions()
    assert store.merge(plan_batch(lines(spark, line(2, "u", id=2, b=9), line(2, "i", id=3, sort="x/y", b=1)), new)) == 1
    assert rows(store.read(), "id", "sort", "b") == [(1, "x/y", 7), (2, "z", 9), (3, "x/y", 1)] and store.detail()["partitionColumns"] == ["sort"]
    assert rows(store.read(0), "id", "kind", "a") == [(1, "x/y", 7), (2, "z", 8)]
    # a new column with the old name of another one is another column
    more = replace(new, columns=(*new.columns, ("a", "text")))
    store = SnapshotStore(spark, more)
    assert store.merge(plan_batch(lines(spark, line(3, "u", id=1, a="text")), more)) == 2
    assert [(r.id, r.b, r.a) for r in store.read().orderBy("id").collect()] == [(1, 7, "text"), (2, 9, None), (3, 1, None)]
    assert store.compact() == 3 and [(r.id, r.b, r.a) for r in store.read().orderBy("id").collect()] == [(1, 7, "text"), (2, 9, None), (3, 1, None)]


def test_writes_that_may_yet_be_committed_are_kept(spark, placed, monkeypatch):  # noqa: F811
    spec = replace(placed(PILOTS), buckets=2)
    one, two = SnapshotStore(spark, spec), SnapshotStore(spark, spec)
    one.merge(put(spark, spec, range(5), "x"))

    def meanwhile():
        for turn in range(3):
            two.merge(put(spark, spec, [50 + turn], "y", 2))
        two.compact()
        two.expire(1)

    interrupted(monkeypatch, one, meanwhile)
    # its own write survived the others' expire, but what they did since is forgotten: it starts again
    assert one.merge(put(spark, spec, [1, 99], "z", 3)) == 5 and rows(one.read().filter("name = 'z'"), "id") == [(1,), (99,)] and one.read().count() == 9
    assert one.read().filter("name = 'y'").count() == 3


def test_a_failing_batch_is_tried_again(spark, placed, monkeypatch):  # noqa: F811
    monkeypatch.setattr(runner, "RETRY_SECONDS", 0.01)
    spec, alerts, turns = replace(placed(PILOTS), retries=2), [], []
    write_lines(lines(spark, line(1, "i", id=1, name="a")), spec.bronze_path)

    def fail(batch, counts):
        turns.append(batch)
        if len(turns) < 3:
            raise OSError("for a moment")

    runner.start(spark, spec, alerts.append, once=True, on_counts=fail).awaitTermination()
    assert turns == [0, 0, 0] and not alerts and rows(SnapshotStore(spark, spec).read(), "id") == [(1,)]
    turns.clear()
    write_lines(lines(spark, line(2, "i", id=2, name="b")), spec.bronze_path)
    runner.start(spark, replace(spec, retries=1), alerts.append, once=True, on_counts=fail).awaitTermination()
    assert [a.kind for a in alerts] == ["table_failure"] and "for a moment" in dead_letters(spark, spec, 1).first().reason


def test_a_failing_expire_harms_no_batch(spark, placed, monkeypatch):  # noqa: F811
    spec, alerts = replace(placed(PILOTS), keep_versions=1), []
    monkeypatch.setattr(SnapshotStore, "expire", lambda self, keep: 1 / 0)
    write_lines(lines(spark, line(1, "i", id=1, name="a")), spec.bronze_path)
    runner.start(spark, spec, alerts.append, once=True).awaitTermination()
    assert not alerts and rows(SnapshotStore(spark, spec).read(), "id") == [(1,)]


def test_the_command_line_sets_what_nobody_set(spark):
    name = "spark.sql.streaming.fileSource.log.cleanupDelay"
    before = spark.conf.get(name)
    assert session() is spark and spark.conf.get(name) == "60000" and spark.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set(name, before)


def test_prefix_tombstones_parse_each_batch_once(spark):
    spec = build("w", JSON)
    first = lines(spark, *(line(1, "i", country=c, minute=str(m), j='{"temp": 1}') for c in ("US", "DE") for m in range(3)))
    second = lines(spark, line(5, "d", country="US", minute=None), line(6, "i", country="DE", minute="1", j='{"temp": 2}'), line(7, "i", country="US", minute="2", j='{"temp": 3}'))
    table = replay(spark, [first, second], spec)
    assert rows(table.withColumn("temp", F.coalesce("temp", F.lit(-1.0))), "country", "minute", "temp", "event_timestamp") == [
        ("DE", 0, 1.0, 1), ("DE", 1, 2.0, 6), ("DE", 2, 1.0, 1), ("US", 0, -1.0, 5), ("US", 1, -1.0, 5), ("US", 2, 3.0, 7)]
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # each batch's upserts and tombstones share a shuffle; one that turned out to be needed by nothing else is not shown
    assert final.count("from_json(StructField(ts_ms") <= 2 and final.count("ReusedExchange") == 2
