import hashlib
import random
from collections import Counter

import pytest

from tidewell.llm import suffix_dedup
from tidewell.llm.suffix_dedup import remove_repeats

DEPTH = 200


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + DEPTH] for t in texts for i in range(len(t) - DEPTH + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - DEPTH + 1):
            if seen[t[i : i + DEPTH]] > 1:
                gone[i : i + DEPTH] = b"\1" * DEPTH
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id or -1, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(documents, rows):
    return sorted((r.doc_id or -1, *tuple(r)[1:5]) for r in remove_repeats(documents(rows)).collect())


def noise(rng, n):
    return "".join(rng.choices("abcdefgh é", k=n))


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [noise(rng, k) for k in (150, 199, 200, 201, 260, 500, 900)]
    rows = []
    for i in range(n):
        text = noise(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, 60)
            text += p[a : len(p) - rng.randint(0, 60)] + noise(rng, rng.randint(0, 250))
        rows.append((i, text))
    return rows + [(100 + i, rng.choice(rows)[1]) for i in range(6)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(documents, seed):
    rows = passages(seed)
    want = brute(rows)
    assert run(documents, rows) == want and 10 < sum(r[2] > 0 for r in want) < len(rows)


def test_large_groups_are_split(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 3)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 10)
    rows = passages(3, 120)
    assert run(documents, rows) == brute(rows)


def test_periodic_texts(documents):
    rows = [(1, "ab" * 1000), (2, "ab" * 99), (3, "a" * 201), (4, "a" * 200 + "b"), (5, "word " * 60), (6, "x" + "word " * 39 + "word"), (7, "é" * 101)]
    assert run(documents, rows) == brute(rows)


def test_edge_cases(documents):
    rng = random.Random(9)
    long = noise(rng, 400)
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (4, long), (None, long[:250]), (None, noise(rng, 300)), (4, noise(rng, 300)), (5, "z" * 3_000)]
    assert run(documents, rows) == brute(rows)
    assert remove_repeats(documents(rows).limit(0)).collect() == []


def test_a_very_long_text(documents):
    rng = random.Random(4)
    body = noise(rng, 2_500_000)
    rows = run(documents, [(1, body), (2, "q" * 50 + body[1_000_000:1_000_300])])
    assert [r[2:4] for r in rows] == [(len(body[1_000_000:1_000_300].encode()), 1)] * 2
