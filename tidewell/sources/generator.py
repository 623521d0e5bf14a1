"""Change-event lines made from the columns of any table, for tests, queries and replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell(value: Column) -> Column:
    return F.struct(value.alias("value"), F.lit(None).cast("bigint").alias("deletion_ts"), F.lit(True).alias("set"))


def event_lines(rows: DataFrame, ts_ms: Column, op: Column, cells: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """json_str (and ``keep``): one change event per row.

    A cell that is a NULL struct is left out of the event's meaning (unset), a struct with a NULL
    value sets NULL.
    """
    after = F.struct(*(c.alias(name) for name, c in cells.items()))
    line = F.to_json(F.struct(ts_ms.alias("ts_ms"), op.alias("op"), after.alias("after")), {"ignoreNullFields": "false"})
    return rows.select(line.alias("json_str"), *keep)
