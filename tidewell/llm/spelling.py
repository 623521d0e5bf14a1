"""Spelling variants by pairless wildcard groups.

1. Words.  Runs of letters of all texts, lower-cased, one in 199 of them (by a hash of document and run)
   without one of its code points; those that are long and frequent enough make the vocabulary.  Words are
   numbered in code-point order.
2. Replacements.  Each word goes to one group for each of its code points: the words of its length that are
   the same but for that place.  A group keeps its size and its two most frequent words, which is all that a
   member needs: it has size - 1 near words there, and the best of them is the first, or the second for the
   first itself.  No pair is made, and no group has more members than the alphabet has letters.
3. Insertions and deletions.  Each word goes without one code point, each result once, to the group of the
   word that it may be.  If that word is in the vocabulary the group tells it how many longer words there are
   and which is the best, and tells each of those about it.
4. What a word learned in its groups is added up: the number of near words, and the best of all.  It is the
   word's form if it is frequent enough; a root is found by following forms, twice as far with every join.

Words are near if they differ by one code point, so two words meet in exactly one kind of group, and in one
group of it.  Groups go by 128-bit fingerprints of what stands before and behind the place, made in one pass
over a word, so a word of any length takes rows in proportion to its length, of a fixed size each.

Edge cases: null texts and texts without letters have no words; a null doc_id hashes as the empty text;
repeated rows count as often as they stand; ties of frequency go to the smaller word; an empty table, or
one without frequent words, gives an empty result; other columns are ignored whatever their names; a very
long text is split by Spark's own expressions, one row at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import U64, mix
from .common import discard, lower_ascii, ship_package, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO, DROP = 6, 5, 5, 199
#: Code points of the words in a block of one task, on average.
BLOCK_CHARS = 1 << 18
_SEEDS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_SELF, _SHORTER, _WILD = 0, 1, 2


def occurrences(docs: DataFrame) -> DataFrame:
    """word: every run of every text, as the vocabulary counts it."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(LETTERS), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % DROP == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """id, word, n of the frequent words; ids rise with the words."""
    counted = occurrences(docs).filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)
    return stored(counted.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def group_keys(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, kind, two halves of the key) of all groups of the words points[offsets[i]:offsets[i+1]].

    The fingerprint of a string is a sum over its code points, each sent with its place through a
    bijection, so leaving one out, or moving what follows it by one place, is a matter of sums.
    """
    size = np.diff(offsets)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(points)) - offsets[:-1][word]
    whole, wild, shorter = [], [], []
    for seed in _SEEDS:
        sent = lambda at: mix(points.astype(U64) * seed ^ mix(at.astype(U64) + seed))  # noqa: B023, E731
        here, moved = sent(place), sent(place - 1)
        total = np.add.reduceat(here, offsets[:-1])
        before = np.cumsum(here) - here
        behind = np.cumsum(moved)
        first, last = offsets[:-1], offsets[1:] - 1
        whole.append(mix(total ^ size.astype(U64) * seed))
        wild.append(mix(mix(total[word] - here + place.astype(U64) * seed) ^ (size[word].astype(U64) * seed)))
        rest = (before - before[first][word]) + (behind[last][word] - behind)
        shorter.append(mix(rest ^ (size[word] - 1).astype(U64) * seed))
    # leaving out either of two like neighbours gives the same string
    fresh = np.r_[True, (points[1:] != points[:-1]) | (word[1:] != word[:-1])] if len(points) else np.zeros(0, bool)
    kinds = np.repeat([_SELF, _SHORTER, _WILD], [len(size), int(fresh.sum()), len(word)])
    keys = [np.concatenate([w, s[fresh], x]) for w, s, x in zip(whole, shorter, wild, strict=True)]
    return np.concatenate([np.arange(len(size)), word[fresh], word]), kinds, keys[0], keys[1]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, n, words = batch.column("id"), batch.column("n"), batch.column("word").to_pylist()
        size = np.array([len(w) for w in words], np.int64)
        done, start = np.cumsum(size), 0
        while start < len(words):
            stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + BLOCK_CHARS, "right")))
            points = np.frombuffer("".join(words[start:stop]).encode("utf-32-le"), np.uint32)
            word, kind, a, b = group_keys(points, np.r_[0, np.cumsum(size[start:stop])])
            pick = pa.array(word + start)
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(kind.astype(np.int8)), ids.take(pick), n.take(pick)], ["a", "b", "kind", "id", "n"])
            start = stop


def _replacements(rows: DataFrame) -> DataFrame:
    """id, n_near, n and id of the best near word in each wildcard group of two words or more."""
    group = Window.partitionBy("a", "b").orderBy(F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = [F.nth_value(c, k).over(group).alias(f"{name}_{c}") for c in ("id", "n") for k, name in ((1, "first"), (2, "second"))]
    seen = rows.filter(F.col("kind") == _WILD).select("id", F.count(F.lit(1)).over(group).alias("size"), *top)
    best = lambda c: F.when(F.col("id") == F.col("first_id"), F.col(f"second_{c}")).otherwise(F.col(f"first_{c}"))
    return seen.filter("size > 1").select("id", (F.col("size") - 1).alias("n_near"), best("n").alias("near_n"), best("id").alias("near"))


def _indels(rows: DataFrame) -> DataFrame:
    """The same for the words that are one code point longer or shorter."""
    group = Window.partitionBy("a", "b")
    own, longer = F.col("kind") == _SELF, F.col("kind") == _SHORTER
    best = F.max(F.when(longer, F.struct("n", (-F.col("id")).alias("minus")))).over(group)
    seen = rows.filter(F.col("kind") != _WILD).select(
        "id", "kind", F.count_if(longer).over(group).alias("longer"), F.max(F.when(own, F.col("id"))).over(group).alias("own_id"), F.max(F.when(own, F.col("n"))).over(group).alias("own_n"), best.alias("best"))
    met = seen.filter("own_id is not null and longer > 0")
    of = lambda c, mine, others: F.when(own, mine).otherwise(others).alias(c)
    return met.select("id", of("n_near", F.col("longer"), F.lit(1)), of("near_n", F.col("best.n"), F.col("own_n")), of("near", -F.col("best.minus"), F.col("own_id")))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root of the words that have a form (id, form): the last word that forms lead to.

    A form is RATIO times as frequent as its word, so paths are short; each round doubles the step.
    """
    step = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        on = step.select(F.col("id").alias("root"), F.col("root").alias("further"))
        if step.join(on, "root", "left_semi").isEmpty():
            return step
        spent, step = step, stored(step.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
        discard(spent)


def spelling_variants(docs: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    ship_package(docs.sparkSession)
    vocab = vocabulary(docs, least_length, least_count)
    rows = stored(vocab.mapInArrow(_grouped, "a long, b long, kind byte, id long, n long"), "groups")
    heard = _replacements(rows).unionByName(_indels(rows))
    best = F.max(F.struct("near_n", (-F.col("near")).alias("minus")))
    summed = heard.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("id", "n_near", F.col("best.near_n").alias("near_n"), (-F.col("best.minus")).alias("near"))
    near = stored(vocab.select("id", "n").join(summed, "id").select("id", "n_near", F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near")).alias("form")), "near")
    discard(rows)
    forms = near.filter("form is not null")
    roots = _roots(forms.select("id", "form"))
    names = lambda c, *more: vocab.select(F.col("id").alias(f"{c}_id"), F.col("word").alias(c), *more)
    led = forms.select("id", F.col("form").alias("form_id")).join(roots.select("id", F.col("root").alias("root_id")), "id")
    named = led.join(names("form", F.col("n").alias("form_n")), "form_id").join(names("root"), "root_id").select("id", "form", "form_n", "root")
    out = vocab.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
