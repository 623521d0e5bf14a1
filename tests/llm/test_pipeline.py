import os
import subprocess
import sys
import zlib
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_minhash import shingles
from tidewell.llm.bpe import vocabulary_path

STAGES = dict(corpus_pipeline.STAGES)


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after each stage, by stage."""
    sf_dir, out = "/root/testdata/sf0.01", {}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "docs")
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect(), docs.columns, after.columns
        docs = after
    return out


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "best_fit_packing"]
    for name, (_, _, before, after) in steps.items():
        assert name == "best_fit_packing" or before == after


def test_language_id(steps):
    before, after, _, _ = steps["language_id"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if r.text is not None and any(c.isalpha() for c in r.text)}


def test_exact_dedup(steps):
    before, after, _, _ = steps["exact_dedup"]
    best = {}
    for r in before:
        best[lower(r.text)] = max(best.get(lower(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values()) and len(after) < len(before)


def test_near_dedup(steps):
    before, after, _, _ = steps["near_dedup"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small * 10 >= large * 8 and small:
            both = len(sets[a] & sets[b])
            if 10 * both >= 8 * (small + large - both):
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    assert {r.doc_id for r in after} == {i for i in sets if find(i) == i} and len(after) < len(before)


def test_decontaminate(spark, steps):
    before, after, _, _ = steps["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    rest = [(r.doc_id, r.text) for r in before if r.doc_id in gone]
    assert all(leaks(rest, items).values())
    short = [(r.doc_id, r.text) for r in after if len(r.text or "") < 400]
    assert not any(leaks(short, items).values())


def test_packing(steps):
    before, after, _, _ = steps["best_fit_packing"]
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want, total = set(), 0
    for r in before:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for at in range(0, len(ids), 4096):
            part = np.array(ids[at : at + 4096], "<u4")
            want.add((r.doc_id, at // 4096, at, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(r)[:5] for r in after} == want and len(after) == len(want)
    assert len({r.sequence_id for r in after}) <= total / 4096 * 1.02 + 1


def test_run_is_all_stages(spark, steps):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.01").drop("sequence_id", "offset").collect()
    assert {tuple(r) for r in got} == {tuple(r)[:5] for r in steps["best_fit_packing"][1]}


def test_odd_rows(spark, documents, tmp_path):
    docs = documents([(1, None), (2, ""), (2, ""), (None, "words of a null id here"), (9, "the one and only text here", "en"), (9, "the one and only text here", "en"), (10, "word " * 50_000, "en")])
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        whole, none = stage(spark, docs, str(tmp_path)), stage(spark, docs.limit(0), str(tmp_path))
        assert none.collect() == [] and whole.count() > 0
        docs = whole if name != "best_fit_packing" else docs
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 9, 10]


#: Names that stages use for columns of their own, or have used.
NAMES = """mark copies id doc key word bits place text_of_row found_lang found_score n draw digest old kept keep_id group_size historical text_sha256 node rep row least bucket
bands sketch component n_shingles first item_id similarity ids best of __text __lang __score _doc_id _sha _sha_of_row _copies _mark __found found _word bit lang_pred score""".split()


def test_columns_of_any_name_are_carried_through(spark, documents, tmp_path):
    rows = [(i, f"the {i} cat and the {i} dog stand in the garden of house number {i}", "en") for i in range(6)]
    rows += [(7, rows[1][1].upper(), "en"), (8, "a passage of the benchmark stands in here word by word for all", "en"), (9, None), (9, rows[2][1] + " too", "en")]
    docs = documents([(i, t, *rest) for i, t, *rest in rows]).drop("digest", "length")
    docs = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n if k % 2 else n.upper()) for k, n in enumerate(NAMES)))
    spark.createDataFrame([(1, "a passage of the benchmark stands in here word by word for all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    before = {tuple(r) for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        found = [tuple(r) for r in after.collect()]
        assert set(found) <= before
        sizes.append(len(found))
    assert sizes == [9, 9, 8, 9]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_stages_work_from_another_folder_without_the_table_helper(tmp_path):
    """The workers get the package from the operators, wherever the driver runs."""
    script = tmp_path / "job.py"
    script.write_text("""
import sys
sys.path.append(sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://" + sys.argv[2]).config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
from tidewell.llm.langid import keep_identified
from tidewell.llm.token_counts import token_counts
docs = spark.createDataFrame([(1, "the cat", "en"), (2, "12", "en")], "doc_id long, text string, lang string")
print("RESULT", keep_identified(docs).count(), token_counts(docs).count())
""")
    root = str(Path(corpus_pipeline.__file__).parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}  # the workers of a local master take their path from there only
    done = subprocess.run([sys.executable, str(script), root, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "RESULT 1 2" in done.stdout, done.stderr[-3000:]
