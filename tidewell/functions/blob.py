"""Base64 big-endian blobs: decoding and encoding in native expressions.

A blob of the wrong width, with broken padding or invalid UTF-8 is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cast import lenient_cast

_ALPHABET = r"[^A-Za-z0-9+/=]"


def _clean(b64: Column) -> Column:
    return F.regexp_replace(b64, _ALPHABET, "")


def _bytes(clean: Column) -> Column:
    return F.when(F.length(clean) % 4 == 0, F.unbase64(clean))


def _wide(raw: Column, width: int) -> Column:
    return F.when(F.octet_length(raw) == width, F.hex(raw))


def _signed64(digits: Column) -> Column:
    return F.conv(digits, 16, -10).try_cast("bigint")


def _ieee(bits: Column, sign: Column, exponent: Column, fraction: Column, bias: int, fraction_bits: int) -> Column:
    """The double with these parts; the smallest exponent is split so that no power underflows."""
    two = F.lit(2.0)
    top = 2 * bias + 1
    unit = fraction.cast("double") / F.lit(float(2**fraction_bits))
    low = bias - 1 + fraction_bits
    tiny = fraction.cast("double") * F.pow(two, F.lit(float(-(low // 2)))) * F.pow(two, F.lit(float(-(low - low // 2))))
    special = F.when(fraction != 0, F.lit(float("nan"))).otherwise(sign * F.lit(float("inf")))
    normal = sign * (unit + F.lit(1.0)) * F.pow(two, (exponent - bias).cast("double"))
    return F.when(bits.isNull(), F.lit(None).cast("double")).when(exponent == top, special).when(exponent == 0, sign * tiny).otherwise(normal)


def _bits(raw: Column, kind: str) -> Column:
    """What the value is made of: the bits of a number, the bytes of any other kind."""
    if kind in ("int", "float"):
        return F.conv(_wide(raw, 4), 16, 10).try_cast("bigint")
    return _signed64(_wide(raw, 8)) if kind in ("bigint", "double") else raw


def decode_blob(b64: Column, kind: str) -> Column:
    """The value of a base64 blob of a configured type, as one expression."""
    return b64 if kind == "blob" else _value(_bits(_bytes(_clean(b64)), kind), kind)


def decode_blobs(rows: DataFrame, blobs: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with the columns of ``blobs`` decoded: base64 column to (new name, configured type).

    Each step is a column of its own that the next one refers to, so that nothing is decoded twice.
    """
    out = rows
    for step in (lambda c, _: _clean(c), lambda c, _: _bytes(c), _bits, _value):
        out = out.select(*((F.col(c) if c not in blobs or blobs[c][1] == "blob" else step(F.col(c), blobs[c][1])).alias(c) for c in out.columns))
    return out.select(*(F.col(c).alias(blobs[c][0] if c in blobs else c) for c in out.columns))


def _value(bits: Column, kind: str) -> Column:
    raw = bits32 = bits64 = bits
    if kind in ("text", "uuid"):
        return F.try_validate_utf8(raw.cast("string"))
    if kind == "boolean":
        return F.when(F.octet_length(raw) >= 1, F.substring(F.hex(raw), 1, 2) != "00")
    if kind == "bigint":
        return bits64
    if kind == "int":
        return F.when(bits32 >= 2**31, bits32 - 2**32).otherwise(bits32).cast("int")
    if kind == "float":
        sign = F.when(bits32 >= 2**31, F.lit(-1.0)).otherwise(F.lit(1.0))
        return _ieee(bits32, sign, F.shiftright(bits32, 23).bitwiseAND(F.lit(255)), bits32.bitwiseAND(F.lit(2**23 - 1)), 127, 23).cast("float")
    sign = F.when(bits64 < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return _ieee(bits64, sign, F.shiftrightunsigned(bits64, 52).bitwiseAND(F.lit(2047)), bits64.bitwiseAND(F.lit(2**52 - 1)), 1023, 52)


def encode_blob(col: Column, kind: str) -> Column:
    """A base64 blob of a value, as a capture tool writes it."""
    if kind in ("text", "uuid"):
        return F.base64(F.encode(col.cast("string"), "UTF-8"))
    if kind == "boolean":
        return F.when(col, F.lit("AQ==")).when(~col, F.lit("AA=="))
    bits = {"float": lambda: _ieee_bits(col.cast("float").cast("double"), 127, 23), "double": lambda: _ieee_bits(col.cast("double"), 1023, 52)}.get(kind, lambda: lenient_cast(col, "bigint"))()
    width = {"int": 8, "float": 8, "bigint": 16, "double": 16}[kind]
    return F.base64(F.to_binary(F.right(F.lpad(F.hex(bits), 16, "0"), F.lit(width)), F.lit("hex")))


def _ieee_bits(value: Column, bias: int, fraction_bits: int) -> Column:
    """The bits of a double, or of a float given as one; every step is exact."""
    two, size = F.lit(2.0), F.abs(value)
    near = F.floor(F.log2(size)).cast("double")
    # the logarithm may be off by one next to a power of two
    power = F.when(F.pow(two, near) > size, near - 1).when(F.pow(two, near + 1) <= size, near + 1).otherwise(near)
    power = F.greatest(power, F.lit(float(1 - bias)))
    part = size * F.pow(two, F.lit(float(bias - 1))) * F.pow(two, F.lit(float(fraction_bits)))
    normal = (power + bias).cast("bigint") * F.lit(1 << fraction_bits) + ((size / F.pow(two, power) - 1) * F.lit(float(1 << fraction_bits))).cast("bigint")
    tiny = F.when(size < F.lit(2.0 ** (1 - bias)), part.cast("bigint"))
    top = F.lit((2 * bias + 1) << fraction_bits)
    bits = F.when(F.isnan(value), top + (1 << (fraction_bits - 1))).when(size == float("inf"), top).when(size == 0, 0).otherwise(F.coalesce(tiny, normal))
    sign = F.lit(-(1 << 63)) if fraction_bits == 52 else F.lit(1 << 31)
    return F.when(value.isNotNull(), bits.bitwiseOR(F.when((value < 0) | (value.cast("string") == "-0.0"), sign).otherwise(F.lit(0).cast("bigint"))))
