import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm.toxicity import ExampleIndex, toxicity


@pytest.fixture(scope="module")
def whole(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()


def test_held_out_accuracy(whole):
    held = whole[whole["held_out"]]
    toxic, said = held["toxic"] == 1, held["predicted"] == 1
    assert toxic.sum() > 60 and (said & toxic).sum() > 0.85 * toxic.sum() and (said & ~toxic).sum() < 0.02 * (~toxic).sum()
    assert whole["score"].between(0, 1).all()
    # scores are probabilities: on average they meet the rate of label 1
    assert abs(held["score"].mean() - toxic.mean()) < 0.03
    near = held[said]["evidence"].iloc[0]
    assert 0 < len(near) <= 15 and near[0]["similarity"] >= near[-1]["similarity"] > 0


def test_nearest_are_exact():
    rng = np.random.default_rng(7)
    v, size = 60, 900
    dense = (rng.random((size, v)) < 0.08) * rng.integers(1, 9, (size, v))
    row, place = np.nonzero(dense)
    idf = rng.uniform(0.5, 4, v)
    ids, label = np.arange(size) * 3, rng.integers(0, 2, size)
    index = ExampleIndex(np.arange(v).astype(np.uint64), idf, np.ones(v), ids, label, row, place, dense[row, place], (1.0, 1.0))
    weights = np.where(dense > 0, 1 + np.log(np.maximum(dense, 1)), 0) * idf
    weights /= np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-300)
    weights = weights.astype(np.float32).astype(np.float64)  # as the index holds them
    place_of = {int(x): i for i, x in enumerate(index.ids)}
    for _ in range(100):
        q = (rng.random(v) < 0.15) * rng.uniform(0.1, 3, v)
        if not q.any():
            continue
        q /= np.linalg.norm(q)
        got, cosine = index.nearest(np.flatnonzero(q), q[q > 0], 15)
        want = sorted(((-round(float(c), 9), place_of[int(i)]) for c, i in zip(weights @ q, ids) if c > 0))[:15]
        assert np.allclose(cosine, [-c for c, _ in want]) and sorted(np.round(cosine, 9)) == sorted(-c for c, _ in want)
        assert len(set(got.tolist())) == len(got)


def test_edge_cases(spark, documents):
    rows = [(i, f"you are awful and vile number{i}" if i % 2 else f"what a pleasant morning number{i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "VILE awful"), (103, "pleasant " * 100_000), (None, "awful"), (104, "unrelated"), (102, "vile awful")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (100, 1), (None, 1), (101, None), (999, 1)], "doc_id long, toxic int")
    got = {(r.doc_id, r.predicted) for r in toxicity(documents(rows), labels).collect() if r.doc_id is None or r.doc_id > 60}
    assert {(102, 1), (103, 0), (None, 1)} <= got and len({p for i, p in got if i in (100, 101, 104)}) == 1
    assert len(toxicity(documents(rows), labels).collect()) == len(rows)


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity(documents([(1, "a"), (2, None)]), none).collect()] == [0.0, 0.0]
    assert [r.score for r in toxicity(documents([(1, "a"), (3, "b")]), none.sparkSession.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")).collect()] == [0.0, 0.0]
    assert toxicity(documents([(1, "a")]).filter(F.lit(False)), none).collect() == []


def brute(docs, labels):
    """Scores by doc_id, from the definitions alone: every document against every example."""
    found = {}
    for i, text in docs:
        low = "".join(c.lower() if c < "\x80" else c for c in text or "")
        words = [w.encode() for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)]
        found[i] = Counter(words + [(n, w[:n]) for w in words for n in (4, 7) if len(w) > n])
    with_text = {i for i, text in docs if text is not None}
    label = {i: y for i, y in labels.items() if i in with_text and zlib.crc32(str(i).encode()) % 4 != 2}
    size = Counter(label.values())
    df, seen = Counter(), {0: Counter(), 1: Counter()}
    for i, c in found.items():
        df.update(c.keys())
        if i in label:
            seen[label[i]].update(c.keys())

    def told(t):
        a, b = seen[1][t], seen[0][t]
        return abs(math.log((a + 0.5) / (size[1] + 1)) - math.log((b + 0.5) / (size[0] + 1))) * math.sqrt(a + b)

    def vector(c, relevant):
        out = {t: (1 + math.log(n)) * math.log(len(docs) / df[t]) * (told(t) if relevant else 1) for t, n in c.items() if seen[0][t] + seen[1][t]}
        norm = math.sqrt(sum(w * w for w in out.values())) or 1
        return {t: w / norm for t, w in out.items()}

    vectors = {i: vector(c, False) for i, c in found.items()}
    telling = {i: vector(c, True) for i, c in found.items()}

    def cosine(of, i, e):
        return sum(w * of[e].get(t, 0) for t, w in of[i].items())

    def vote(i, known):
        nearest = [(c, e) for c, e in sorted(((cosine(vectors, i, e), e) for e in known), reverse=True)[:15] if c > 0]
        close = [cosine(telling, i, e) for _, e in nearest]
        near = [((r if any(close) else c) ** 2, label[e]) for r, (c, e) in zip(close, nearest)]
        return sum(w * y for w, y in near) / sum(w for w, _ in near) if near else None

    own = sorted((v, label[i]) for i in label if (v := vote(i, [e for e in label if e != i])) is not None)
    prior = size[1] / len(label)
    # isotonic fit by its min-max formula
    fit = []
    for k in range(len(own)):
        fit.append(max(min(np.mean([y for _, y in own[i : j + 1]]) for j in range(k, len(own))) for i in range(k + 1)))
    level = sorted(set(fit))
    knots = [(np.mean([v for (v, _), f in zip(own, fit) if f == x]), (sum(y for (_, y), f in zip(own, fit) if f == x) + prior) / (fit.count(x) + 1)) for x in level]
    bare = [label[i] for i in label if not vectors[i]]
    rest = (sum(bare) + prior) / (len(bare) + 1)
    return {i: rest if (v := vote(i, label)) is None else float(np.interp(v, *zip(*knots))) for i in found}


def test_scores_equal_brute_force(spark, documents):
    rng = np.random.default_rng(11)
    plain = [f"word{i}" for i in range(120)]
    rows, labels = [], {}
    for i in range(140):
        text = rng.choice(plain, rng.integers(4, 40)).tolist()
        if i % 3 == 0:
            text += rng.choice(["awful", "terrible", "vileness"], 2).tolist()
        rows.append((i, " ".join(text) if i not in (5, 6, 7) else ["", None, "?!"][i - 5]))
        if i < 110:
            labels[i] = int(i % 3 == 0) if i % 11 else 1 - int(i % 3 == 0)
    frame = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity(documents(rows), frame).collect()}
    want = brute(rows, labels)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-6 and len({round(x, 6) for x in want.values()}) > 5
