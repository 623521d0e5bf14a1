"""Shared helpers: durable intermediate tables and the A-Z lower-casing rule."""

from __future__ import annotations

import re
import string
import tempfile
import uuid
import zipfile
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Bits of the filter in ``maybe_in``: at most 2**18 rows of two longs are broadcast.
_FILTER_BITS = 1 << 24


def shared_dir(spark: SparkSession) -> str:
    """The folder for durable intermediates: ``spark.checkpoint.dir`` where it is set.

    Only a local master without that setting (unit tests, one machine) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    return _LOCAL_DIRS[app]


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result has no lineage to recompute and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` on which nothing lazy depends any more."""
    path = _PATHS.pop(df, None)
    if path:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to clash with no column."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def maybe_in(df: DataFrame, column: str, wanted: DataFrame, other: bool = False) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be in the one long column of ``wanted``; with ``other``, the rest.

    A bit filter of a fixed size decides, so that a join behind it moves few of the other rows; it
    never leaves out a row that is in.  ``column`` has no nulls.
    """
    word, bits, place = spare_names(df, "word", "bits", "place")
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(_FILTER_BITS))
    at = spot(wanted.columns[0])
    words = wanted.select(F.shiftright(at, 6).alias(word), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    words = words.groupBy(word).agg(F.bit_or("bit").alias(bits))
    placed = df.withColumn(place, spot(column)).withColumn(word, F.shiftright(place, 6))
    hit = F.coalesce(F.getbit(bits, F.pmod(place, F.lit(64)).cast("int")), F.lit(0)) == 1
    return placed.join(F.broadcast(words), word, "left").filter(~hit if other else hit).select(*df.columns)


def without(docs: DataFrame, mark: Column, odd: DataFrame) -> DataFrame:
    """``docs`` without some rows; ``odd`` has doc_id, mark and copies of those not simply kept.

    Of rows with copies 0 none stays, of others one.  Rows outside a filter over ``odd`` are never
    shuffled.
    """
    m, k, i, n, d = spare_names(docs, "mark", "key", "id", "copies", "doc")
    rows = docs.withColumn(m, mark)
    keys = odd.select(F.col("mark").alias(k), F.col("doc_id").alias(i), F.col("copies").alias(n))
    plain = maybe_in(rows, m, odd.select("mark"), other=True).select(*docs.columns)
    held = maybe_in(rows, m, odd.select("mark")).withColumn(d, F.col("doc_id").cast("long"))
    joined = held.join(keys, (F.col(m) == F.col(k)) & F.col(d).eqNullSafe(F.col(i)), "left")
    out = plain.unionByName(joined.filter(F.col(n).isNull()).select(*docs.columns))
    if odd.filter("copies > 0").isEmpty():
        return out
    return out.unionByName(joined.filter(F.col(n) > 0).dropDuplicates([m, d]).select(*docs.columns))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidewell-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; the rule of the held-out folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)
