"""Token counts of a table of documents by the compiled transducers."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import process_cache, slices, text_bytes
from dockline.llm.transducer import TokenCounter

LIMIT = 1024


def token_counts(docs: DataFrame, tokenizer: bytes, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row, over whole texts.

    * Null texts count as empty: no bytes, no tokens.
    * Repeated rows come out each; a null doc_id stays null; extra columns are not read; empty in, empty out.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        content = shipped.value
        counter = process_cache(f"counter-{zlib.crc32(content)}", lambda: TokenCounter(content))
        for batch in slices(batches, 2048, 4 << 20):
            raw = batch.column(1).to_pylist()
            found = counter.count([t.decode("utf-8", "replace") for t in raw])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in raw], pa.int64()), pa.array(found)],
                                             ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
