"""Token counts by rank-synchronous array merging.

The pre-tokens of a slice of texts are ragged numpy arrays. All sequences step
together, each merging its lowest-rank pair, until none has a known pair; the
symbols left are the tokens (``bpe.RankMerger``). Each different pre-token is
merged once per worker. One scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketgrain.llm import bpe, common
from marketgrain.llm import textarrays as ta

LIMIT = 512


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of every whole text, one row per input row.

    Only ``doc_id`` and ``text`` are read, whatever else the table has. A null
    text counts as empty: 0 bytes, 0 tokens. Null and repeated ids keep their
    rows. Special strings inside a text are one token each, as the library has
    it by default. An empty table gives no rows. Texts of any length are counted
    whole; one text is never cut.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.merger(vocabulary)
        for batch in ta.slices(batches):
            text = batch.column(1)
            n = own.count(text)
            size = np.diff(ta.flat(text)[1])
            yield pa.record_batch(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(count, schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(common.table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
