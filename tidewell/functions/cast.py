"""Casts under which a bad value is NULL, whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Configured type to Spark type.  Fixed values.
SPARK_TYPES = {
    "text": "string",
    "int": "int",
    "bigint": "bigint",
    "boolean": "boolean",
    "float": "float",
    "double": "double",
    "uuid": "string",
    "blob": "string",
}
_INTEGRAL = {"int", "bigint"}


def lenient_cast(col: Column, kind: str) -> Column:
    """``col`` as a configured type; fractions are cut off and what does not parse is NULL."""
    spark_type = SPARK_TYPES[kind]
    if spark_type == "string":
        return col.cast("string")
    plain = col.try_cast(spark_type)
    if kind in _INTEGRAL:
        return F.coalesce(plain, col.try_cast("decimal(38,10)").try_cast(spark_type))
    return plain


def event_date(ts_ms: Column) -> Column:
    """The UTC date of epoch milliseconds, whatever the session's time zone."""
    days = F.floor(ts_ms / 86_400_000).try_cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)
