import pytest
import yaml

from tidewell.config import EavSpec, JsonSpec, PlainSpec, load_config, parse_config

PATHS = {f: f"/data/{f}" for f in ("kafka_topic", "bronze_path", "silver_path", "checkpoint_path", "dead_letter_path")}
EAV = {"type": "EAV", "enabled": True, **PATHS, "merge_key": "uuid", "cassandra_key_field": "key", "partition_by": "pilot_id", "attributes": {"pilotId": {"wide": "pilot_id", "type": "int"}}}
JSON = {"type": "JSON_EMBEDDED", "enabled": True, **PATHS, "partition_by": ["country"], "partition_keys": [{"name": "country", "type": "text"}], "clustering_keys": [{"name": "minute", "type": "int"}], "merge_key": ["country", "minute"], "json_columns": {"j": {"temp": {"col": "temp", "type": "float"}}}}
PLAIN = {"type": "PLAIN", "enabled": False, **PATHS, "partition_by": None, "partition_keys": [{"name": "id", "type": "int"}], "clustering_keys": [], "merge_key": "id", "columns": [{"name": "id", "type": "int"}, {"name": "name", "type": "text"}]}


def test_good_tables():
    tables = parse_config({"tables": {"a": EAV, "b": JSON, "c": PLAIN}})
    assert [type(t) for t in tables.values()] == [EavSpec, JsonSpec, PlainSpec]
    assert tables["a"].schema == "`uuid` string, `pilot_id` int, `event_id` string, `event_timestamp` bigint, `event_date` date, `deduptime` bigint"
    assert tables["b"].keys == (("country", "text"), ("minute", "int")) and tables["b"].delete_keys == ("country",)
    assert tables["c"].data == (("name", "text"),) and not tables["c"].enabled


BAD = [
    (EAV, {"type": "OTHER"}, "invalid type"), (EAV, {"merge_key": ""}, "merge_key"), (EAV, {"cassandra_key_field": None}, "cassandra_key_field"), (EAV, {"attributes": {}}, "attributes"),
    (EAV, {"attributes": {"x": {"wide": "x", "type": "decimal"}}}, "type"), (EAV, {"attributes": {"x": {"type": "int"}}}, "wide"), (EAV, {"partition_by": "other"}, "partition_by"),
    (EAV, {"attributes": {"x": {"wide": "pilot_id", "type": "int"}, "y": {"wide": "pilot_id", "type": "int"}}}, "more than once"),
    (JSON, {"partition_keys": []}, "partition_keys"), (JSON, {"partition_keys": [{"name": "country"}]}, "type"), (JSON, {"clustering_keys": None}, "clustering_keys"), (JSON, {"merge_key": []}, "merge_key"),
    (JSON, {"merge_key": ["country"]}, "merge_key"), (JSON, {"json_columns": {}}, "json_columns"), (JSON, {"json_columns": {"j": {}}}, "json_columns"), (JSON, {"json_columns": {"j": {"a": {"col": "a", "type": "x"}}}}, "type"),
    (JSON, {"partition_by": "nope"}, "partition_by"), (PLAIN, {"columns": []}, "columns"), (PLAIN, {"merge_key": "nope"}, "merge_key"), (PLAIN, {"partition_keys": [{"name": "nope", "type": "int"}]}, "nope"), (PLAIN, {"partition_by": "nope"}, "partition_by"),
]


@pytest.mark.parametrize("base, change, says", BAD)
def test_each_rule(base, change, says):
    with pytest.raises(ValueError, match=says):
        parse_config({"tables": {"t": base | change}})


def test_all_errors_come_at_once(tmp_path):
    lacking = {k: v for k, v in EAV.items() if k not in ("bronze_path", "enabled")}
    with pytest.raises(ValueError) as error:
        parse_config({"tables": {"a": lacking, "b": PLAIN | {"merge_key": "nope"}, "c": 3}})
    assert all(x in str(error.value) for x in ("bronze_path", "enabled", "nope", "[c]"))
    for raw in (None, {}, {"tables": {}}, {"tables": None}, []):
        with pytest.raises(ValueError):
            parse_config(raw)
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.yml"))
    (tmp_path / "bad.yml").write_text("a: [")
    with pytest.raises(ValueError, match="YAML"):
        load_config(str(tmp_path / "bad.yml"))
    (tmp_path / "good.yml").write_text(yaml.safe_dump({"tables": {"a": EAV}}))
    assert load_config(str(tmp_path / "good.yml"))["a"].name == "a"


MODES = [
    ({"ordering": "typo"}, "ordering"), ({"guard": "typo"}, "guard"), ({"null_policy": "precense"}, "null_policy"), ({"event_ids": None}, "event_ids"), ({"enabled": "false"}, "enabled"), ({"enabled": 1}, "enabled"),
    ({"delete_ops": "d"}, "delete_ops"), ({"delete_ops": []}, "delete_ops"), ({"retries": -1}, "retries"), ({"retries": "3"}, "retries"), ({"buckets": 0}, "buckets"), ({"file_rows": True}, "file_rows"),
    ({"renames": ["a"]}, "renames"), ({"renames": {"a": "c", "b": "c"}}, "renames"), ({"trigger": 30}, "trigger"), ({"kafka_servers": ""}, "kafka_servers"),
]


@pytest.mark.parametrize("base", [EAV, JSON, PLAIN])
@pytest.mark.parametrize("change, says", MODES)
def test_modes_are_checked(base, change, says):
    with pytest.raises(ValueError, match=says):
        parse_config({"tables": {"t": base | change}})


def test_good_modes():
    spec = parse_config({"tables": {"t": PLAIN | {"ordering": "event_time", "guard": "event_timestamp", "null_policy": "presence", "event_ids": "deterministic", "delete_ops": ["d", "t"], "retries": 2, "renames": {"old": "name"}, "keep_versions": None, "trigger": "1 minute"}}})["t"]
    assert (spec.ordering, spec.guard, spec.null_policy, spec.event_ids, spec.delete_ops, spec.retries, spec.renames) == ("event_time", "event_timestamp", "presence", "deterministic", ("d", "t"), 2, (("old", "name"),))
    assert parse_config({"tables": {"t": PLAIN | {"guard": None, "renames": None}}})["t"].renames == ()
