"""Token counts of whole texts; see ``bpe`` for the rank-synchronous merging that makes them.

Null counts as the empty text, which has 0 bytes and 0 tokens.  Strings of added tokens inside a
text count as the library's default has it: one token each.  Repeated rows each get their row, a
null doc_id is carried through, and other columns are ignored whatever their names; an empty table
gives an empty result.  Texts are handled in blocks of bounded size, a longer text in one of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import blocks, text_buffer
from .bpe import engine, vocabulary_path
from .common import ship_package

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(vocabulary_path(vocabulary))
        for block in blocks(batches):
            data, offsets = text_buffer(block.column("text"))
            _, n = bpe.encode_rows(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    ship_package(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
