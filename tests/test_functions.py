import base64
import math
import random
import struct

from pyspark.sql import functions as F

from tidewell.functions.blob import decode_blob, encode_blob
from tidewell.functions.cast import event_date, lenient_cast


def decoded(spark, values, kind):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, b string")
    return [r.v for r in rows.select("i", decode_blob(F.col("b"), kind).alias("v")).orderBy("i").collect()]


def test_blob_vectors(spark):
    assert decoded(spark, ["AAAnhA==", "AAAnlA==", "////+w==", "gAAAAA==", "AAA=", "", None, "!!!", "AA#AnhA==", "AAA"], "int") == [10116, 10132, -5, -(2**31), None, None, None, None, 10116, None]
    assert decoded(spark, ["//////////8=", "gAAAAAAAAAA=", "AAAAAGgGGUI=", "f/////////8=", "AAAnhA==", "AAAAAAAAAAAA"], "bigint") == [-1, -(2**63), 1745230146, 2**63 - 1, None, None]
    assert decoded(spark, ["AA==", "AQ==", "/w==", "AAE=", ""], "boolean") == [False, True, True, False, None]
    assert decoded(spark, ["RU5BQkxFRA==", "/w==", "", "w6k="], "text") == ["ENABLED", None, "", "é"]
    assert decoded(spark, ["AQ=="], "blob") == ["AQ=="]


def test_floats_bit_for_bit(spark):
    rng = random.Random(1)
    for kind, code, size in (("double", ">d", 8), ("float", ">f", 4)):
        special = [0.0, -0.0, math.inf, -math.inf, math.nan, 1.0, -2.5, struct.unpack(code, bytes(size - 1) + b"\1")[0]]
        raw = [struct.pack(code, x) for x in special] + [rng.randbytes(size) for _ in range(300)] + [b"\x00\x00" + rng.randbytes(size - 2) for _ in range(40)]
        got = decoded(spark, [base64.b64encode(b).decode() for b in raw], kind)
        for b, v in zip(raw, got, strict=True):
            want = struct.unpack(code, b)[0]
            assert math.isnan(v) if math.isnan(want) else struct.pack(code, v) == b
        assert decoded(spark, ["AAAA"], kind) == [None]


def test_blobs_come_back(spark):
    rng = random.Random(2)
    for kind, values in (("int", [rng.randint(-(2**31), 2**31 - 1) for _ in range(200)]), ("bigint", [rng.randint(-(2**63), 2**63 - 1) for _ in range(200)]), ("boolean", [True, False, None]), ("text", ["", "é日", None])):
        sql = {"int": "int", "bigint": "long", "boolean": "boolean", "text": "string"}[kind]
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {sql}").select("i", encode_blob(F.col("v"), kind).alias("b"))
        assert [r.v for r in rows.select("i", decode_blob(F.col("b"), kind).alias("v")).orderBy("i").collect()] == values


def test_floats_are_encoded_bit_for_bit(spark):
    rng = random.Random(3)
    for kind, code, size, bias in (("double", ">d", 8, 1023), ("float", ">f", 4, 127)):
        values = [0.0, -0.0, math.inf, -math.inf, math.nan, None] + [s * 2.0**e * f for e in (1 - bias, 2 - bias, -1, 0, 1, 10, bias - 1, bias) for s in (1, -1) for f in (1.0, 1.5)] + [struct.unpack(code, bytes(size - 2) + bytes([k, k]))[0] for k in (0, 1, 255)]
        values += [x for x in (struct.unpack(code, rng.randbytes(size))[0] for _ in range(400)) if not math.isnan(x)]
        values += [x for n in (3, 1000, 2**20) for x in (math.nextafter(n, 0), float(n), math.nextafter(n, math.inf))] if kind == "double" else []
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", encode_blob(F.col("v"), kind).alias("b"))
        for v, b in zip(values, [r.b for r in rows.orderBy("i").collect()], strict=True):
            assert b is None if v is None else math.isnan(struct.unpack(code, base64.b64decode(b))[0]) if math.isnan(v) else base64.b64decode(b) == struct.pack(code, v), v


def test_lenient_casts(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(["abc", "1.9", "99999999999", " 7 ", "-1.9", None, "1e3"])], "i int, v string")
    got = [r.v for r in rows.select("i", lenient_cast(F.col("v"), "int").alias("v")).orderBy("i").collect()]
    assert got[:6] == [None, 1, None, 7, -1, None]
    flags = spark.createDataFrame([(0, "yes"), (1, "1"), (2, "f"), (3, "maybe")], "i int, v string")
    assert [r.v for r in flags.select("i", lenient_cast(F.col("v"), "boolean").alias("v")).orderBy("i").collect()] == [True, True, False, None]


def test_event_date(spark):
    rows = spark.createDataFrame([(1781082674559,), (0,), (-1,), (None,), (2**62,)], "t long")
    assert [str(r.d) for r in rows.select(event_date(F.col("t")).alias("d")).collect()][:4] == ["2026-06-10", "1970-01-01", "1969-12-31", "None"]
