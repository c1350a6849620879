"""Token counts of texts (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from opinara.llm.tokenization import encoder

DEFAULT = "byte_bpe_50k.json"


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    Texts are encoded whole in Arrow batches balanced by bytes, long texts split at safe
    boundaries; only the lengths leave the function. ``tokenizer`` is the path of a .json
    or .model file and defaults to the public 50k byte-level file.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are counted
    row by row; other columns are ignored whatever their names; no rows, no counts.
    """
    path = tokenizer or public_tokenizers.path(DEFAULT)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            texts = batch.column("text")
            n_tokens = np.zeros(len(batch), np.int64)
            for first, _, offsets in model.encode(texts):
                n_tokens[first:first + len(offsets) - 1] = np.diff(offsets)
            n_bytes = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
