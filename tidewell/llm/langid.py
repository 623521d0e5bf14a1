"""Language identification with bit-sliced Bloom filters of character n-grams.

Fitting: the n-grams of a bounded sample of labelled rows per language are counted with Spark.  An
n-gram belongs to a language if it makes up at least ``MIN_RATE`` of the language's n-grams and at
least ``MIN_SHARE`` of its highest rate in any language, so a language has at most 1/MIN_RATE
n-grams and the filters are bounded.  Filters of all languages are bit-sliced: the table holds, for
each position, one bit per language, and the AND of an n-gram's positions is the mask of all
languages that contain it.

Predicting: each text's masks give per-language popcounts; with the filter's known rate f of false
positives the count of n n-grams is corrected to (hits - f n) / (1 - f).  The language with the
largest corrected count wins and its share of the sum is the score.

N-grams are taken over lower-cased UTF-8 bytes with every run of other ASCII bytes as one blank, and one
blank before the text.
Edge cases: ``und`` with score 0 for a null text or one without a letter; a text with letters but
no known n-gram gets the most frequent language with score 0; ties go to the language that sorts
first; rows with a null lang or doc_id are not learned from.  If there is nothing to learn from,
every prediction is ``und``.  Repeated rows each get their row; other columns are ignored, and the
stage form carries them through, whatever their names; an empty table gives an empty result.  A
block of texts is held as several 8-byte arrays a byte, so a task needs memory for the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .blocks import ALNUM_BREAKS, LOWER, U64, blocks, mix, text_buffer
from .common import doc_remainder, maybe_in, ship_package, spare_names

#: At most so many labelled rows of each language are learned from.
SAMPLE_PER_LANG = 2000
#: Rows that are ordered for each one that is drawn.
DRAWN = 4
NGRAM = 5
MIN_RATE, MIN_SHARE = 2e-5, 0.25
TABLE_BITS, HASHES = 20, 4
_LETTERS = ALNUM_BREAKS.copy()
_LETTERS[0x30:0x3A] = True


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as a number, row) of all n-grams; a blank stands before every word."""
    rows = len(offsets) - 1
    # one separator byte in front of each row, so that rows never touch
    spread = np.zeros(len(data) + rows + 1, np.uint8)
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    spread[np.arange(len(data)) + row_of + 1] = LOWER[data]
    owner = np.empty(len(spread), np.int64)
    owner[np.arange(len(data)) + row_of + 1] = row_of
    owner[offsets[:-1] + np.arange(rows)] = np.arange(rows)
    owner[-1] = rows
    spread[_LETTERS[spread]] = 0x20
    keep = np.r_[True, (spread[1:] != 0x20) | (spread[:-1] != 0x20) | (owner[1:] != owner[:-1])]
    spread, owner = spread[keep].astype(U64), owner[keep]
    n = max(0, len(spread) - NGRAM + 1)
    value = np.zeros(n, U64)
    for j in range(NGRAM):
        value = (value << U64(8)) | spread[j : j + n]
    inside = owner[:n] == owner[NGRAM - 1 :] if n else np.zeros(0, bool)
    return value[inside], owner[:n][inside]


def positions(gram: np.ndarray) -> Iterator[np.ndarray]:
    h = mix(gram + U64(1))
    step = (h >> U64(32)) | U64(1)
    for _ in range(HASHES):
        yield (h & U64((1 << TABLE_BITS) - 1)).astype(np.int64)
        h = h + step * U64(0x9E3779B9)


class LanguageFilters:
    """The fitted model: languages, the bit-sliced table and the rate of false positives."""

    def __init__(self, langs: list[str], grams: dict[str, np.ndarray], prior: str | None):
        self.langs, self.prior = langs, prior
        self.words = max(1, -(-len(langs) // 64))
        self.table = np.zeros((1 << TABLE_BITS, self.words), U64)
        for i, lang in enumerate(langs):
            for at in positions(grams[lang]):
                self.table[at, i // 64] |= U64(1 << (i % 64))
        fill = np.array([np.count_nonzero(self.table[:, i // 64] & U64(1 << (i % 64))) for i in range(len(langs))]) / (1 << TABLE_BITS)
        self.false_rate = fill**HASHES

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that contain it."""
        out = np.full((len(gram), self.words), ~U64(0), U64)
        for at in positions(gram):
            out &= self.table[at]
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected counts by row and language."""
        rows = len(offsets) - 1
        gram, owner = ngrams(data, offsets)
        mask = self.masks(gram)
        total = np.bincount(owner, minlength=rows)
        hits = np.empty((rows, len(self.langs)))
        for i in range(len(self.langs)):
            has = (mask[:, i // 64] >> U64(i % 64)) & U64(1)
            hits[:, i] = np.bincount(owner, has, minlength=rows)
        return np.maximum(0, (hits - self.false_rate * total[:, None]) / (1 - self.false_rate))


def fit(docs: DataFrame, usable: Column, sample: int = SAMPLE_PER_LANG) -> LanguageFilters:
    """Learn from text and lang of at most ``sample`` rows per language for which ``usable`` holds."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("lang").cast("string").alias("lang"), "text")
    texts = texts.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # the sample is drawn without the texts, which join the few rows that were drawn; only rows with
    # the least draws, DRAWN times as many as are wanted, are ordered, so no task gets a whole language
    draw = F.xxhash64("doc_id", "mark").bitwiseAND(F.lit(2**62 - 1))
    ids = texts.select("doc_id", "mark", "lang").distinct().withColumn("draw", draw)
    size = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    early = ids.join(size, "lang").filter(F.col("draw") <= F.lit(2.0**62) * DRAWN * sample / F.col("n")).drop("n")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "mark"))
    drawn = early.withColumn("nth", nth).filter(F.col("nth") <= sample).select("doc_id", "mark", "lang")
    chosen = maybe_in(texts, "mark", drawn.select("mark")).join(drawn, ["doc_id", "mark", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            labels = block.column("lang").to_pylist()
            data, offsets = text_buffer(pc.utf8_lower(block.column("text")))
            gram, owner = ngrams(data, offsets)
            for lang in sorted(set(labels)):
                mine = np.array([x == lang for x in labels])
                value, n = np.unique(gram[mine[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value), pa.string()), pa.array(value.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    counts = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    rated = counts.withColumn("rate", rate).filter(F.col("rate") >= MIN_RATE)
    best = rated.withColumn("best", F.max("rate").over(Window.partitionBy("gram")))
    # at most 1/MIN_RATE rows of each language
    found = best.filter(F.col("rate") >= MIN_SHARE * F.col("best")).select("lang", "gram", "n").toPandas()
    langs = sorted(found["lang"].unique())
    grams = {x: found.loc[found["lang"] == x, "gram"].to_numpy(np.int64).astype(U64) for x in langs}
    prior = max(langs, key=lambda x: found.loc[found["lang"] == x, "n"].sum()) if langs else None
    return LanguageFilters(langs, grams, prior)


def predict(docs: DataFrame, model: LanguageFilters, columns: list[str], made: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``columns`` of every row and the two made columns; nothing but the text is looked at."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = spare_names(docs, "text_of_row")[0]
    frame = docs.select(*columns, F.col("text").alias(held))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for block in blocks(batches, held):
            text = pc.utf8_lower(block.column(held))
            data, offsets = text_buffer(text)
            letters = np.r_[0, np.cumsum(~_LETTERS[data])]
            has = letters[offsets[1:]] > letters[offsets[:-1]]
            plain = np.r_[0, np.cumsum((data >= 0x61) & (data <= 0x7A))]
            for i in np.flatnonzero(has & (plain[offsets[1:]] == plain[offsets[:-1]])):
                has[i] = any(map(str.isalpha, text[int(i)].as_py()))
            if filters.langs:
                score = filters.scores(data, offsets)
                best, total = score.argmax(axis=1), score.sum(axis=1)
                share = np.where(total > 0, score[np.arange(len(best)), best] / np.maximum(total, 1e-300), 0.0)
                name = [("und" if not h else filters.langs[b] if t > 0 else filters.prior) for h, b, t in zip(has, best, total, strict=True)]
                share = np.where(has, share, 0.0)
            else:
                name, share = ["und"] * len(has), np.zeros(len(has))
            kept = [block.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(name, pa.string()), pa.array(share)], [*columns, *made])

    return frame.mapInArrow(judge, StructType([*frame.schema.fields[:-1], StructField(made[0], StringType()), StructField(made[1], DoubleType())]))


def learnable() -> Column:
    """Rows outside the held-out fold."""
    return doc_remainder(F.col("doc_id"), 3) != 1


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    out = predict(docs.withColumn("doc_id", F.col("doc_id").cast("long")), fit(docs, learnable()), ["doc_id"])
    held = F.coalesce(doc_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is identified; ``und`` rows go."""
    lang, score = spare_names(docs, "found_lang", "found_score")
    return predict(docs, fit(docs, learnable()), list(docs.columns), (lang, score)).filter(F.col(lang) != "und").select(*docs.columns)
