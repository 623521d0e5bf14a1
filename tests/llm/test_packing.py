import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewell.llm.bpe import vocabulary_path
from tidewell.llm.packing import CAPACITY, nonnegative_least_squares, pack, plan

TEXTS = [(1, "One small text."), (2, None), (3, ""), (4, "word " * 9000), (4, "word " * 9000), (None, "no id"), (6, "l'été, it's 12"), (7, "日本 <|endoftext|>"), *((10 + i, "".join(pair[j.bit_count() % 2] for j in range(n))) for i, (n, pair) in enumerate((n, p) for n in (1024, 4096) for p in ("ez", "ze"))), (20, "long text, " * 60_000)]


def brute(rows):
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), CAPACITY):
            part = ids[start : start + CAPACITY]
            out.append((doc_id, start // CAPACITY, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(by)


def test_pieces_and_sequences(documents):
    rows = pack(documents(TEXTS)).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(brute(TEXTS), key=key)
    check(rows)


def test_empty_table(documents):
    assert pack(documents([(1, "a")]).limit(0)).collect() == []


def test_whole_table_is_packed_tightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs).collect()
    assert sorted(tuple(r[:5]) for r in rows) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]))
    least = -(-sum(r.length for r in rows) // CAPACITY)
    assert check(rows) <= least * 1.01 + 1


@pytest.mark.parametrize("histogram", [{4096: 7}, {1: 5000}, {2049: 10, 2047: 4}, {1500: 30, 1000: 9, 96: 400}, {}])
def test_plan_holds_exactly_the_histogram(histogram):
    got = defaultdict(int)
    for lengths, count in plan(histogram):
        assert sum(lengths) <= CAPACITY
        for x in lengths:
            got[x] += count
    assert dict(got) == histogram


def test_nonnegative_least_squares():
    rng = np.random.default_rng(0)
    a, x = rng.random((12, 20)), np.maximum(rng.normal(size=20), 0)
    found = nonnegative_least_squares(a, a @ x)
    assert (found >= 0).all() and np.allclose(a @ found, a @ x, atol=1e-6)
