import pytest
from tokenizers import Tokenizer

from tidewell.llm.bpe import vocabulary_path
from tidewell.llm.token_counts import token_counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))


def want(library, text):
    n = len(library.encode(text or "", add_special_tokens=False).ids)
    return len((text or "").encode()), n, n > 2048


def alternating(n, a, b):
    """A Thue-Morse string: with its complement it collides under any polynomial hash modulo 2**64."""
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_long_words_are_told_apart_by_their_bytes(documents, library):
    texts = [alternating(n, *pair) for n in (16, 24, 25, 1024, 2048, 4096) for pair in ("ez", "ze", "ab", "ba")]
    texts += ["a\x00b a a\x00 a\x00\x00", " ".join("x" * n for n in (23, 24, 25, 24, 25, 26)), ("y" * 25 + " ") * 3]
    got = {r.doc_id: r.n_tokens for r in token_counts(documents(list(enumerate(texts)))).collect()}
    assert got == {i: want(library, t)[1] for i, t in enumerate(texts)}


def test_odd_texts(documents, library):
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    texts = [
        None, "", " ", "\n\n  \t", "a", "Hello, world! It's 12345 o'clock", "naïve café — 世界 🙂👩‍👩‍👧 ₿", "é é İ ǅ ﬁ", "x" * 5000, "ab" * 50_000, "word " * 60_000, "tail ", " head",
        *special, *(f"before {s} after{s}{s}" for s in special), "".join(special), "\x00\x01​﻿", "don't DON'T we're I'LL", "1 22 333 4444 55555", "a b　c", "\r\n\r\nx\ty",
    ]
    rows = [*enumerate(texts), (None, "a null id"), (3, "again"), (3, "again")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(documents(rows)).collect())
    assert got == sorted((-1 if i is None else i, *want(library, t)) for i, t in rows)


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs).collect()}
    assert got == {r.doc_id: want(library, r.text) for r in docs.collect()} and any(x[2] for x in got.values())


def test_limits_and_empty_table(documents):
    docs = documents([(1, "one two three")])
    assert [r.over_limit for r in token_counts(docs, limit=2).collect()] == [True]
    assert token_counts(docs.limit(0)).collect() == []
