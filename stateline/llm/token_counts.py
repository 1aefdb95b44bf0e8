"""Token counts: batch encoding in Arrow functions that return lengths only (operator 3)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.llm import encoding
from stateline.llm.words import blocks, bytes_of


def token_counts(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    limit: int = 512,
    tokenizer: str = encoding.TOKENIZER,
    ranks: str | None = encoding.RANKS,
) -> DataFrame:
    """Per row of ``docs`` its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    One narrow pass without a shuffle. Arrow batches are cut anew by bytes, so a batch of long texts
    holds fewer of them, and a long text is encoded in parts that end at safe boundaries; ids never
    leave the task. A null text counts as empty: 0 bytes, 0 tokens. A null id and repeated rows are
    counted like others, an empty table gives an empty result, other columns are ignored.
    ``ranks`` names the same vocabulary for the faster library; None uses the tokenizer file alone.
    """
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def count(batches):
        for block in blocks(batches, "text", encoding.BATCH_BYTES):
            texts = block.column("text")
            n_bytes = np.diff(bytes_of(texts)[1])
            n_tokens = np.fromiter(
                (len(ids) for ids in encoding.ids_of(texts.to_pylist(), tokenizer, ranks)), np.int64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    counted = narrow.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return counted.withColumnRenamed("id", id)
