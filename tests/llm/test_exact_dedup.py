import hashlib

import numpy as np
from pyspark.sql import functions as F

from tidewell.llm.exact_dedup import build_slots, exact_dedup, find_slots, keep_one


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        mine = groups[lower(t)]
        keep = max((x for x in mine if x is not None), default=None)
        out.append((i or -1, keep or -1, len(mine), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out)


def run(frame, **kw):
    return sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(frame, **kw).collect())


ROWS = [(1, "Same TEXT"), (2, "same text"), (9, "sAme text"), (3, None), (4, ""), (None, "same text"), (None, "only null ids"), (None, "only null ids"), (5, "É stays"), (6, "é stays"), (7, "long " * 200_000), (8, "LONG " * 200_000), (11, "twice"), (11, "twice"), (12, " twice")]


def test_groups(documents):
    assert run(documents(ROWS)) == brute(ROWS)


def test_the_result_does_not_depend_on_the_history(documents):
    docs = documents(ROWS)
    for old in (F.lit(True), F.lit(False), F.col("doc_id") > 4, F.lit(None).cast("boolean"), F.length("text") > 9):
        assert run(docs, is_history=old) == brute(ROWS)


def test_one_of_each_stays(documents):
    docs = documents(ROWS)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, lower(r.text)[:12]) for r in kept.collect())
    assert got == sorted([(-1, "only null id"), (4, ""), (5, "É stays"), (6, "é stays"), (8, "long long lo"), (9, "same text"), (11, "twice"), (12, " twice")])


def test_empty_table(documents):
    none = documents([(1, "a")]).limit(0)
    assert exact_dedup(none).collect() == [] and keep_one(none).collect() == []


def test_slots_are_a_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(0, 256, (5000, 32), dtype=np.uint8), axis=0)
    sizes, bits, slot = build_slots(known)
    assert sorted(slot.tolist()) == list(range(len(known)))
    assert (find_slots(sizes, bits, known) == slot).all()
    table = np.empty_like(known)
    table[slot] = known
    other = rng.integers(0, 256, (5000, 32), dtype=np.uint8)
    at = find_slots(sizes, bits, other)
    assert not (table[at[at >= 0]] == other[at >= 0]).all(axis=1).any()
    assert build_slots(known[:0])[2].tolist() == []
