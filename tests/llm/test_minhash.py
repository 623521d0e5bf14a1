import random
import re
from itertools import combinations

import numpy as np

from tidewell.llm import minhash
from tidewell.llm.components import connected_components
from tidewell.llm.minhash import keep_one_of_each, minhash_groups, permute


def shingles(text):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", lowered)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), least[find(i)], rows[i][0] == least[find(i)]) for i in range(len(rows)))


def run(documents, rows, percent=85):
    return sorted(tuple(r)[:4] for r in minhash_groups(documents(rows), percent).collect())


def test_words_that_collide_under_polynomial_hashes(documents):
    word = lambda n, a, b: "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))
    rows = [(i, word(n, *pair)) for i, (n, pair) in enumerate((n, p) for n in (1024, 4096) for p in ("ez", "ze"))]
    rows += [(10 + i, f"one two {t} three four five six") for i, t in rows]
    assert run(documents, rows) == brute(rows) and all(r[3] for r in brute(rows))


def test_near_copies_around_the_threshold(documents):
    rng = random.Random(5)
    rows = []
    for group in range(6):
        base = [f"w{group}x{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    assert run(documents, rows) == brute(rows)
    assert run(documents, rows, 80) == brute(rows, 80)


def test_buckets_are_cut_into_parts(documents, monkeypatch):
    """Small parts, and no further hubs: the result stays the same."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(copy)))
    want = brute(rows)
    assert 1 < len({r[2] for r in want}) < 90
    monkeypatch.setattr(minhash, "PART_ROWS", 7)
    monkeypatch.setattr(minhash, "TASK_ROWS", 50)
    monkeypatch.setattr(minhash, "COMPARED", 100)
    assert run(documents, rows) == want
    monkeypatch.setattr(minhash, "PASS_PAIRS", 0)
    assert run(documents, rows) == want


def test_recall_of_bands_and_sketches():
    """Of pairs just above the threshold none is lost before the verification."""
    rng = np.random.default_rng(4)
    for size in (20, 40, 100, 400):
        for percent in (80, 85):
            share = 2 * percent / (100 + percent)
            same = int(np.ceil(share * size))
            sets = []
            for _ in range(150):
                both = rng.integers(0, 1 << 63, same, dtype=np.uint64)
                sets += [np.unique(np.r_[both, rng.integers(0, 1 << 63, size - same, dtype=np.uint64)]) for _ in range(2)]
            value, starts = np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])[:-1]]
            sig = minhash.signatures(value, starts, minhash.ROWS_PER_BAND * minhash.BANDS)
            agree = (sig[:, ::2] == sig[:, 1::2]).reshape(minhash.BANDS, minhash.ROWS_PER_BAND, -1).all(axis=1).any(axis=0)
            assert agree.all()
            sketch = minhash.sketches(sig, value, np.repeat(np.arange(len(sets)), [len(x) for x in sets])).view(np.uint64)
            n = np.array([len(x) for x in sets])
            u = np.arange(0, len(sets), 2)
            assert minhash.close_pairs(u, u + 1, n, sketch, percent).all()


def test_edge_cases(documents):
    rows = [(1, "A b c"), (2, "a  B\tc"), (3, None), (4, ""), (5, " \n"), (6, "a b c d"), (7, "word " * 100_000), (8, "word word word word word"), (9, "a b c d"), (10, "é É x y z"), (11, "é é x y z")]
    assert run(documents, rows) == brute(rows)


def test_repeated_and_null_ids(documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words stand here now"), (None, "a b c d e f"), (None, "alone in the whole wide world"), (2, "other words stand here now")]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash_groups(documents(rows)).collect())
    assert got == [(0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_one_of_each_group_stays(documents):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (3, long.replace("w30", "x")), (3, long.replace("w31", "y")), (7, None), (8, ""), (8, ""), (None, "a null id with words"), (None, "another null id with words"), (9, "a b"), (9, "a b")]
    docs = documents(rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0), len(r.text or "")) for r in kept.collect())
    assert [i for i, _ in got] == [0, 0, 3, 7, 8, 8, 9]
    assert keep_one_of_each(docs.limit(0)).collect() == []


def test_empty_table(documents):
    assert minhash_groups(documents([(1, "a")]).limit(0)).collect() == []


def test_permutation_is_a_bijection():
    x = np.arange(1 << 18, dtype=np.uint32) * np.uint32(16381)
    assert len(np.unique(permute(x, 77))) == len(x)


def test_components_of_a_long_path(spark):
    ids = list(range(60))
    random.Random(2).shuffle(ids)
    links = spark.createDataFrame([*zip(ids, ids[1:]), (100, 101), (101, 102), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(60)}, 100: 100, 101: 100, 102: 100}
