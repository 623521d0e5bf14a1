"""Alerts of the engine: written to the log and handed to any sink that is given."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

log = logging.getLogger("tidewell")

TABLE_FAILURE, UNKNOWN_ATTRIBUTE, UNKNOWN_TOPIC, PARTITION_CHANGE, SCHEMA_CHANGE = "table_failure", "unknown_attribute", "unknown_topic", "partition_change", "schema_change"


@dataclass(frozen=True)
class Alert:
    kind: str
    subject: str
    message: str
    details: dict = field(default_factory=dict)


AlertSink = Callable[[Alert], None]


def log_sink(alert: Alert) -> None:
    log.warning("[%s] %s: %s %s", alert.kind, alert.subject, alert.message, alert.details or "")


def table_failure(table: str, batch_id: int, error: BaseException) -> Alert:
    return Alert(TABLE_FAILURE, table, f"batch {batch_id} failed and was dead-lettered", {"batch_id": batch_id, "error": f"{type(error).__name__}: {error}"[:2000]})


def unknown_attributes(table: str, names: list[str], events: int) -> Alert:
    return Alert(UNKNOWN_ATTRIBUTE, table, "attributes that the configuration does not name; add them and restart", {"attributes": sorted(names), "events": events})


def unknown_topic(topic: str) -> Alert:
    return Alert(UNKNOWN_TOPIC, topic, "a topic that no table reads")


def partition_change(table: str, stored: list[str], configured: list[str]) -> Alert:
    return Alert(PARTITION_CHANGE, table, "the partition layout of an existing table cannot change", {"stored": stored, "configured": configured})


def schema_change(table: str, what: str) -> Alert:
    return Alert(SCHEMA_CHANGE, table, f"stored columns cannot become the configured ones: {what}")
