import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewell.llm.blocks import U64, text_buffer
from tidewell.llm.decontaminate import RADIUS, ItemIndex, decontaminate, keep_clean


def words(text):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", lowered)


def shingles(w):
    return Counter([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        w, found = words(text), []
        for item_id, item in items:
            x = words(item)
            if not w or not x:
                continue
            n, c = min(len(x), len(w)), shingles(x)
            for s in range(len(w) - n + 1):
                d = shingles(w[s : s + n])
                if (c & d).total() >= 0.8 * (c | d).total():
                    found.append(item_id)
                    break
        out[doc_id] = ",".join(map(str, sorted(set(found))))
    return out


def test_random_edits(spark, documents):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 9, 15, 30, 60])))) for i in range(40)]
    docs = []
    for i in range(150):
        body = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(passage))
                passage[k : k + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            at = rng.randint(0, len(body))
            body[at:at] = [p.upper() + rng.choice([",", "\n", " -"]) for p in passage]
        docs.append((i, " ".join(body)))
    benchmark = spark.createDataFrame([*items, (None, items[0][1]), (99, None), (98, "..!")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate(documents(docs), benchmark).collect()}
    want = brute(docs, items)
    assert sum(map(bool, want.values())) > 40 and got == want


def test_edge_cases(spark, documents):
    item = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(7, item), (8, item), (9, "zz")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, " ".join(item.split()[:10])), (5, "word " * 200_000 + item), (None, item), (6, "a zz b"), (7, "five six seven")]
    got = sorted((r.doc_id or 0, r.contaminated, r.item_ids) for r in decontaminate(documents(rows), benchmark).collect())
    assert got == [(0, True, "7,8"), (1, False, ""), (2, False, ""), (3, True, "7,8"), (3, True, "7,8"), (4, True, "7,8"), (5, True, "7,8"), (6, True, "9"), (7, False, "")]
    kept = keep_clean(documents(rows), benchmark)
    assert kept.columns == documents(rows).columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 7]
    assert decontaminate(documents(rows), benchmark.filter(F.lit(False))).filter("contaminated").count() == 0
    assert decontaminate(documents(rows).filter(F.lit(False)), benchmark).collect() == []


def test_multi_index_returns_all_within_the_radius():
    rng = np.random.default_rng(4)
    index = ItemIndex([(i, f"a{i} b{i * 7} c{i % 5} d e{i}") for i in range(60)])
    prints = index.prints[rng.integers(0, 60, 500)].copy()
    for k in range(500):
        for b in rng.choice(64, rng.integers(0, 24), replace=False):
            prints[k] ^= U64(1 << int(b))
    who, item = index.within_radius(prints)
    want = {(k, i) for k in range(500) for i in range(60) if int(prints[k] ^ index.prints[i]).bit_count() <= RADIUS}
    assert set(zip(who.tolist(), item.tolist())) == want


def test_recall_at_the_threshold():
    """Passages edited so far that they are just similar enough, at the head, the tail or within."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9)))
    for length in (13, 50, 130, 400):
        most = (length - 4) // 9  # shingles that may be lost on either side
        items = [[word() for _ in range(length)] for _ in range(100)]
        index = ItemIndex([(i, " ".join(w)) for i, w in enumerate(items)])
        texts = []
        for i, w in enumerate(items):
            n = most if i % 3 < 2 else max(0, most - 4)
            at = {0: 0, 1: length - n, 2: length // 2}[i % 3]
            edited = w[:at] + [word() for _ in range(n)] + w[at + n :]
            both, every = (shingles(w) & shingles(edited)).total(), (shingles(w) | shingles(edited)).total()
            assert both >= 0.8 * every
            texts.append(" ".join([word() for _ in range(60)] + edited + [word() for _ in range(60)]))
        found = index.match(*text_buffer(pa.array(texts)))
        hits = [sum(i in found[i] for i in range(k, 100, 3)) / len(range(k, 100, 3)) for k in range(3)]
        assert min(hits) >= 0.9 and sum(hits) / 3 >= 0.95, (length, hits)


def test_whole_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    known = items.collect()
    got = {r.doc_id: r.item_ids for r in decontaminate(docs, items).collect()}
    flat = {r.doc_id: " ".join(words(r.text)) for r in docs.collect()}
    for r in known:
        phrase = f" {' '.join(words(r.text))} "
        for doc_id, text in flat.items():
            if phrase in f" {text} ":
                assert str(r.item_id) in got[doc_id].split(",")
    assert 0 < sum(map(bool, got.values())) < 0.1 * len(got)
