"""Table configuration: YAML to checked specifications; all errors are reported at once."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml

from .functions.cast import SPARK_TYPES

EAV, JSON_EMBEDDED, PLAIN = "EAV", "JSON_EMBEDDED", "PLAIN"
#: Fields a table needs, by type.  Fixed values.
COMMON_FIELDS = ("type", "enabled", "kafka_topic", "bronze_path", "silver_path", "checkpoint_path", "dead_letter_path")
TYPE_FIELDS = {
    EAV: ("merge_key", "cassandra_key_field", "attributes", "partition_by"),
    JSON_EMBEDDED: ("partition_keys", "clustering_keys", "merge_key", "json_columns"),
    PLAIN: ("partition_keys", "clustering_keys", "merge_key", "columns"),
}
META = (("event_id", "text"), ("event_timestamp", "bigint"))


@dataclass(frozen=True)
class TableSpec:
    """What every table has.  Columns are (name, configured type) in the order of the table."""

    name: str
    enabled: bool
    topic: str
    bronze_path: str
    silver_path: str
    checkpoint_path: str
    dead_letter_path: str
    partition_by: tuple[str, ...]
    merge_key: tuple[str, ...]
    #: Opt-in modes; the defaults are the reference semantics.
    ordering: str = "reference"  # or event_time: a mutation not newer than a tombstone of its batch is dropped
    guard: str | None = None  # or event_timestamp: an older event never replaces a newer one
    null_policy: str = "non_null_wins"  # or presence: a cell that is there and null sets NULL (PLAIN)
    event_ids: str = "uuid"  # or deterministic
    delete_ops: tuple[str, ...] = ("d",)
    #: Settings of the stream and the stored table; all optional in YAML.
    buckets: int = 16  # of a new table: about its bytes / 256 MB
    trigger: str = "30 seconds"
    max_files_per_trigger: int | None = None
    keep_versions: int | None = None  # older data and log records go after a batch
    kafka_servers: str | None = None  # read kafka_topic from there instead of bronze_path
    renames: tuple[tuple[str, str], ...] = ()  # (stored column, its new name)
    retries: int = 0  # of a batch that fails, before it is dead-lettered
    file_rows: int = 1_000_000  # rows of a data file at most
    target_mb: int = 128  # of a data file after a compaction

    @property
    def keys(self) -> tuple[tuple[str, str], ...]:
        raise NotImplementedError

    @property
    def data(self) -> tuple[tuple[str, str], ...]:
        raise NotImplementedError

    @property
    def delete_keys(self) -> tuple[str, ...]:
        """The leading keys that a tombstone always has; rows of one prefix are stored together."""
        return self.merge_key

    @property
    def dedup_time(self) -> bool:
        return False

    @property
    def wide(self) -> tuple[tuple[str, str], ...]:
        """(name, Spark's type) of the table's columns: keys, data, metadata."""
        columns = tuple((c, SPARK_TYPES[t]) for c, t in (*self.keys, *self.data, *META))
        return (*columns, ("event_date", "date"), *((("deduptime", "bigint"),) if self.dedup_time else ()))

    @property
    def schema(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.wide)


@dataclass(frozen=True)
class EavSpec(TableSpec):
    key_field: str = "key"
    attributes: tuple[tuple[str, str, str], ...] = ()  # (attribute, column, type)

    @property
    def keys(self):
        return ((self.merge_key[0], "text"),)

    @property
    def data(self):
        return tuple((wide, kind) for _, wide, kind in self.attributes)

    @property
    def dedup_time(self):
        return True


@dataclass(frozen=True)
class JsonSpec(TableSpec):
    partition_keys: tuple[tuple[str, str], ...] = ()
    clustering_keys: tuple[tuple[str, str], ...] = ()
    json_columns: tuple[tuple[str, str, str, str], ...] = ()  # (source column, JSON key, column, type)

    @property
    def keys(self):
        return (*self.partition_keys, *self.clustering_keys)

    @property
    def data(self):
        return tuple((col, kind) for _, _, col, kind in self.json_columns)

    @property
    def delete_keys(self):
        return tuple(c for c, _ in self.partition_keys)


@dataclass(frozen=True)
class PlainSpec(TableSpec):
    partition_keys: tuple[tuple[str, str], ...] = ()
    clustering_keys: tuple[tuple[str, str], ...] = ()
    columns: tuple[tuple[str, str], ...] = field(default=())

    @property
    def keys(self):
        kinds = dict(self.columns)
        return tuple((k, kinds[k]) for k in self.merge_key)

    @property
    def data(self):
        return tuple((c, t) for c, t in self.columns if c not in self.merge_key)

    @property
    def delete_keys(self):
        lead = tuple(c for c, _ in self.partition_keys if c in self.merge_key)
        return lead or self.merge_key


def _names(value: object) -> tuple[str, ...]:
    return () if value is None else (value,) if isinstance(value, str) else tuple(value)


def _text(cfg: dict, name: str, where: str) -> list[str]:
    return [] if isinstance(cfg.get(name), str) and cfg[name].strip() else [f"{where} '{name}' must be a non-empty string"]


def _typed(entries: object, name: str, where: str, may_be_empty: bool = False) -> list[str]:
    if not isinstance(entries, list) or not (entries or may_be_empty):
        return [f"{where} '{name}' must be a {'' if may_be_empty else 'non-empty '}list"]
    errors = []
    for i, e in enumerate(entries):
        if not isinstance(e, dict) or not e.get("name"):
            errors.append(f"{where} {name}[{i}] needs a 'name'")
        if not isinstance(e, dict) or e.get("type") not in SPARK_TYPES:
            errors.append(f"{where} {name}[{i}] needs a 'type' out of {sorted(SPARK_TYPES)}")
    return errors


def _repeated(names: list[str], what: str, where: str) -> list[str]:
    return [f"{where} {what} '{n}' is used more than once" for n in sorted({n for n in names if names.count(n) > 1})]


def _check_eav(cfg: dict, where: str) -> list[str]:
    errors = [*_text(cfg, "merge_key", where), *_text(cfg, "cassandra_key_field", where)]
    attributes = cfg.get("attributes")
    if not isinstance(attributes, dict) or not attributes:
        return [*errors, f"{where} 'attributes' must be a non-empty mapping"]
    for name, a in attributes.items():
        if not isinstance(a, dict) or not a.get("wide"):
            errors.append(f"{where} attribute '{name}' needs 'wide'")
        if not isinstance(a, dict) or a.get("type") not in SPARK_TYPES:
            errors.append(f"{where} attribute '{name}' needs a 'type' out of {sorted(SPARK_TYPES)}")
    wide = [a["wide"] for a in attributes.values() if isinstance(a, dict) and a.get("wide")]
    errors += _repeated(wide, "column", where)
    return errors + [f"{where} partition_by '{c}' is no attribute column" for c in _names(cfg.get("partition_by")) if c not in wide]


def _check_json(cfg: dict, where: str) -> list[str]:
    errors = [*_typed(cfg.get("partition_keys"), "partition_keys", where), *_typed(cfg.get("clustering_keys"), "clustering_keys", where, True)]
    if not isinstance(cfg.get("merge_key"), list) or not cfg["merge_key"]:
        errors.append(f"{where} 'merge_key' must be a non-empty list")
    sources = cfg.get("json_columns")
    if not isinstance(sources, dict) or not sources:
        return [*errors, f"{where} 'json_columns' must be a non-empty mapping"]
    columns = []
    for source, mapping in sources.items():
        if not isinstance(mapping, dict) or not mapping:
            errors.append(f"{where} json_columns '{source}' must be a non-empty mapping")
            continue
        for key, m in mapping.items():
            if not isinstance(m, dict) or not m.get("col"):
                errors.append(f"{where} json_columns '{source}.{key}' needs 'col'")
            else:
                columns.append(m["col"])
            if not isinstance(m, dict) or m.get("type") not in SPARK_TYPES:
                errors.append(f"{where} json_columns '{source}.{key}' needs a 'type' out of {sorted(SPARK_TYPES)}")
    if errors:
        return errors
    keys = [k["name"] for k in (*cfg["partition_keys"], *cfg["clustering_keys"])]
    errors += _repeated(columns + keys, "column", where)
    if set(cfg["merge_key"]) != set(keys):
        errors.append(f"{where} 'merge_key' must name all partition and clustering keys")
    return errors + [f"{where} partition_by '{c}' is no column" for c in _names(cfg.get("partition_by")) if c not in keys + columns]


def _check_plain(cfg: dict, where: str) -> list[str]:
    errors = [*_typed(cfg.get("partition_keys"), "partition_keys", where), *_typed(cfg.get("clustering_keys"), "clustering_keys", where, True), *_typed(cfg.get("columns"), "columns", where)]
    if not _names(cfg.get("merge_key")):
        errors.append(f"{where} 'merge_key' must not be empty")
    if errors:
        return errors
    columns = [c["name"] for c in cfg["columns"]]
    errors += _repeated(columns, "column", where)
    errors += [f"{where} merge_key '{k}' is no column" for k in _names(cfg["merge_key"]) if k not in columns]
    errors += [f"{where} key '{k['name']}' is no column" for k in (*cfg["partition_keys"], *cfg["clustering_keys"]) if k["name"] not in columns]
    return errors + [f"{where} partition_by '{c}' is no column" for c in _names(cfg.get("partition_by")) if c not in columns]


_CHECKS = {EAV: _check_eav, JSON_EMBEDDED: _check_json, PLAIN: _check_plain}
_MODES = ("ordering", "guard", "null_policy", "event_ids", "delete_ops", "buckets", "trigger", "max_files_per_trigger", "keep_versions", "kafka_servers", "renames", "retries", "file_rows", "target_mb")
_COUNTS = ("buckets", "max_files_per_trigger", "keep_versions", "file_rows", "target_mb")
_CHOICES = {"ordering": ("reference", "event_time"), "guard": (None, "event_timestamp"), "null_policy": ("non_null_wins", "presence"), "event_ids": ("uuid", "deterministic")}


def _check_modes(cfg: dict, where: str) -> list[str]:
    errors = [f"{where} '{f}' must be a positive whole number" for f in _COUNTS if cfg.get(f, 1) is not None and (type(cfg.get(f, 1)) is not int or cfg.get(f, 1) < 1)]
    errors += [f"{where} '{f}' must be one of {list(known)}, not {cfg[f]!r}" for f, known in _CHOICES.items() if f in cfg and cfg[f] not in known]
    if "enabled" in cfg and type(cfg["enabled"]) is not bool:
        errors.append(f"{where} 'enabled' must be true or false")
    if type(cfg.get("retries", 0)) is not int or cfg.get("retries", 0) < 0:
        errors.append(f"{where} 'retries' must be a whole number")
    ops = cfg.get("delete_ops", ["d"])
    if not isinstance(ops, list) or not ops or not all(isinstance(o, str) for o in ops):
        errors.append(f"{where} 'delete_ops' must be a non-empty list of texts")
    renames = cfg.get("renames") or {}
    if not isinstance(renames, dict) or not all(isinstance(x, str) and x for pair in renames.items() for x in pair) or len(set(renames.values())) < len(renames):
        errors.append(f"{where} 'renames' must map columns to other new names")
    return errors + [e for f in ("trigger", "kafka_servers") if cfg.get(f) is not None for e in _text(cfg, f, where)]


def check(name: str, cfg: object) -> list[str]:
    """The errors of one table's entry."""
    if not isinstance(cfg, dict):
        return [f"[{name}] must be a mapping"]
    kind = cfg.get("type")
    where = f"[{name}]"
    errors = [f"{where} missing required field: '{f}'" for f in COMMON_FIELDS if f not in cfg]
    if kind not in _CHECKS:
        return [*errors, f"{where} invalid type '{kind}': one of {sorted(_CHECKS)}"]
    errors += [f"{where} missing required field: '{f}'" for f in TYPE_FIELDS[kind] if f not in cfg]
    errors += _check_modes(cfg, where)
    return errors + _CHECKS[kind](cfg, f"{where} {kind}:")


def build(name: str, cfg: dict) -> TableSpec:
    """The specification of a checked entry."""
    pairs = lambda entries: tuple((e["name"], e["type"]) for e in entries)
    shape = {"delete_ops": tuple, "renames": lambda r: tuple((r or {}).items())}
    common = {
        "name": name, "enabled": cfg["enabled"], "topic": cfg["kafka_topic"], "bronze_path": cfg["bronze_path"], "silver_path": cfg["silver_path"],
        "checkpoint_path": cfg["checkpoint_path"], "dead_letter_path": cfg["dead_letter_path"], "partition_by": _names(cfg.get("partition_by")), "merge_key": _names(cfg["merge_key"]),
        **{m: shape.get(m, lambda x: x)(cfg[m]) for m in _MODES if m in cfg},
    }
    if cfg["type"] == EAV:
        return EavSpec(**common, key_field=cfg["cassandra_key_field"], attributes=tuple((a, v["wide"], v["type"]) for a, v in cfg["attributes"].items()))
    keys = {"partition_keys": pairs(cfg["partition_keys"]), "clustering_keys": pairs(cfg["clustering_keys"])}
    if cfg["type"] == JSON_EMBEDDED:
        found = tuple((source, key, m["col"], m["type"]) for source, mapping in cfg["json_columns"].items() for key, m in mapping.items())
        return JsonSpec(**common, **keys, json_columns=found)
    return PlainSpec(**common, **keys, columns=pairs(cfg["columns"]))


def parse_config(raw: object) -> dict[str, TableSpec]:
    if not isinstance(raw, dict) or "tables" not in raw:
        raise ValueError("the configuration needs a top-level 'tables' mapping")
    tables = raw["tables"]
    if not isinstance(tables, dict) or not tables:
        raise ValueError("'tables' is empty")
    errors = [e for name, cfg in tables.items() for e in check(name, cfg)]
    if errors:
        raise ValueError(f"{len(errors)} errors in the configuration:\n" + "\n".join(f"  - {e}" for e in errors))
    return {name: build(name, cfg) for name, cfg in tables.items()}


def load_config(path: str) -> dict[str, TableSpec]:
    """The tables of a YAML file by name."""
    if not Path(path).exists():
        raise FileNotFoundError(f"no configuration file: {path}")
    try:
        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ValueError(f"{path} is not valid YAML: {error}") from error
    return parse_config(raw)
