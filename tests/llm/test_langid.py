import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm.blocks import U64
from tidewell.llm.langid import MIN_RATE, MIN_SHARE, LanguageFilters, keep_identified, language_id


@pytest.fixture(scope="module")
def whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()


def test_held_out_accuracy(whole):
    held = whole[whole["held_out"]]
    assert len(held) > 200 and (held["lang_pred"] == held["lang"]).mean() > 0.99
    assert whole["score"].between(0, 1).all()


def test_filters_return_every_language_and_few_others():
    rng = np.random.default_rng(1)
    grams = {f"l{i:03d}": rng.integers(0, 1 << 40, 3000).astype(U64) for i in range(70)}
    model = LanguageFilters(sorted(grams), grams, None)
    for i, lang in enumerate(sorted(grams)):
        assert ((model.masks(grams[lang])[:, i // 64] >> U64(i % 64)) & U64(1)).all()
    other = model.masks(rng.integers(1 << 41, 1 << 42, 20000).astype(U64))
    for i in range(70):
        rate = ((other[:, i // 64] >> U64(i % 64)) & U64(1)).mean()
        assert rate <= model.false_rate[i] + 1e-3


def test_edge_cases(spark, documents):
    train = [(i, "the cat and the dog in the house " * 5, "en") for i in range(30)] + [(i, "le chat et le chien dans la maison " * 5, "fr") for i in range(30, 45)]
    docs = documents([*train, (100, None), (101, ""), (102, "12 !?"), (103, "世界"), (104, "¿¡ —"), (None, "the dog", "en"), (105, "le chien " * 200_000), (105, "le chien")])
    got = {(r.doc_id, r.lang_pred) for r in language_id(docs).filter("doc_id >= 100 or doc_id is null").collect()}
    assert got == {(100, "und"), (101, "und"), (102, "und"), (103, "en"), (104, "und"), (None, "en"), (105, "fr")}
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "some text"), (2, None)])
    assert [r.lang_pred for r in language_id(docs).collect()] == ["und", "und"]
    assert language_id(docs.filter(F.lit(False))).collect() == []


def grams(text):
    plain = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", b" " + text.lower().encode())
    return [plain[i : i + 5] for i in range(len(plain) - 4)]


def test_predictions_and_scores_are_those_of_exact_sets(spark, whole):
    """Sets of n-grams by plain counting: filters with corrected counts come close to them on every document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = {}
    for d in docs:
        if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 3 != 1:
            counts.setdefault(d.lang, Counter()).update(grams(d.text))
    rates = {}
    for lang, c in counts.items():
        total = sum(c.values())
        rates[lang] = {g: n / total for g, n in c.items() if n / total >= MIN_RATE}
    best = Counter()
    for r in rates.values():
        for g, x in r.items():
            best[g] = max(best[g], x)
    sets = {lang: {g for g, x in r.items() if x >= MIN_SHARE * best[g]} for lang, r in rates.items()}
    got = whole.set_index("doc_id")
    for d in docs:
        mine = grams(d.text or "")
        hits = {lang: sum(g in s for g in mine) for lang, s in sorted(sets.items())}
        row = got.loc[d.doc_id]
        if not any(map(str.isalpha, d.text or "")):
            assert row.lang_pred == "und" and row.score == 0
        elif sum(hits.values()):
            assert row.score == pytest.approx(max(hits.values()) / sum(hits.values()), abs=5e-3)
            assert hits[row.lang_pred] >= max(hits.values()) - 1e-3 * len(mine)
    assert got.held_out.to_dict() == {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 3 == 1 for d in docs}
