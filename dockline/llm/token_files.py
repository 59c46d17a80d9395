"""Token ids of whole texts in files of canonical Huffman codes.

Texts are encoded once, where they lie, into a table of ids in the shared folder; the counts of all ids go with
it. From the counts the driver makes one code book, whose size is bounded by the vocabulary. The ids are then
packed and dealt out by ranges of (doc_id, hash of the text), so that the files hold the documents in ascending
order; the bounds come from a sample of those two columns, and rows that equal several bounds are spread over
all their ranges. One row of the files is one block that can be read on its own: the packed codes of a
document, its number of ids, and the bit offset of every 128th id.

* Null texts count as empty: such a document holds the end id alone.
* A null doc_id sorts first and stays null. Repeated rows are all written.
* Extra columns are not read. An empty table gives empty files and an empty result.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.llm.bytepair import PartEncoder
from dockline.llm.common import list_column, process_cache, slices, text_bytes
from dockline.llm.huffman import STRIDE, Codebook, code_lengths
from dockline.session import shared_path

FILE_SCHEMA = "doc_id bigint, part int, at bigint, n_tokens bigint, codes binary, marks array<bigint>"
ID_SCHEMA = "doc_id bigint, part int, at bigint, n_tokens bigint, ids array<bigint>"


def _encoder(content: bytes) -> PartEncoder:
    return process_cache(f"parts-{zlib.crc32(content)}", lambda: PartEncoder(content))


def _planes(ids: np.ndarray, per_text: np.ndarray) -> list[bytes]:
    """The ids of every text with their bytes sorted by place, which compresses far better; before them the number
    of bytes of an id, two where that is enough for all."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    lead, places = bytes([width]), ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.copy()
    ends = np.cumsum(per_text)
    return [lead + places[:, b:e].tobytes() for b, e in zip((ends - per_text).tolist(), ends.tolist())]


def _from_planes(content: bytes) -> np.ndarray:
    width = content[0]
    return np.frombuffer(content, np.uint8, offset=1).reshape(width, -1).T.copy().view(f"<u{width}").reshape(-1)


def encoded_ids(docs: DataFrame, tokenizer: bytes, end_id: int) -> DataFrame:
    """(doc_id, tie, planes) of every row, written to the shared folder, and beside them the counts of ids.

    A row with ``counts`` holds those of a part of the input, in place of a document's ids.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer)

    def encode(batches):
        encoder, end = _encoder(shipped.value), np.uint32(end_id).tobytes()
        size = max(encoder.size, end_id + 1)
        total = np.zeros(size, np.int64)
        for batch in slices(batches, 4096, 8 << 20):
            ids, n = encoder.batch(batch.column(1).cast(pa.string()), end)
            total += np.bincount(ids, minlength=size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_planes(ids, n), pa.binary()),
                                              pa.nulls(len(n), pa.binary())], ["doc_id", "tie", "planes", "counts"])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([total.tobytes()], pa.binary())], ["doc_id", "tie", "planes", "counts"])

    path = shared_path(spark, "ids")
    schema = "doc_id bigint, tie bigint, planes binary, counts binary"
    docs.select("doc_id", text_bytes().alias("text"), F.xxhash64("text").alias("tie")).mapInArrow(encode, schema) \
        .write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def code_table(stored: DataFrame) -> np.ndarray:
    """Rows (id, bits) for every id that occurs; at most the vocabulary reaches the driver."""
    def add(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                counts = np.frombuffer(part, np.int64)
                total = counts + (total if len(total) else 0)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids], pa.int64())], ["id", "n"])

    rows = stored.where("counts IS NOT NULL").select("counts").mapInArrow(add, "id bigint, n bigint") \
        .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    counts = np.array([r["n"] for r in rows], np.int64)
    return np.stack([np.array([r["id"] for r in rows], np.int64), code_lengths(counts).astype(np.int64)], 1)


def _range_bounds(stored: DataFrame, parts: int, each: int = 64) -> list[tuple]:
    """At most parts - 1 keys (has an id, doc_id, tie) that cut the rows into about equal ranges.

    They are taken from about ``each`` rows a range, those with a low hash of key and place, so that a key that
    many rows share comes up as often as its share.
    """
    keys = stored.where("counts IS NULL").select("doc_id", "tie")
    share = min(1.0, parts * each / max(1, keys.count()))
    pick = F.pmod(F.xxhash64("doc_id", "tie", F.monotonically_increasing_id()), F.lit(1 << 30))
    drawn = keys.where(pick < math.ceil(share * (1 << 30))).collect()
    rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]) for r in drawn)
    return [rows[len(rows) * k // parts] for k in range(1, parts)] if rows else []


def write_token_files(docs: DataFrame, path: str, tokenizer: bytes, end_id: int = 0) -> None:
    """Writes ``path``/ids (the blocks, in ascending order) and ``path``/codes (the code book)."""
    spark = docs.sparkSession
    stored = encoded_ids(docs, tokenizer, end_id)
    codes = code_table(stored)
    spark.createDataFrame([(int(i), int(b)) for i, b in codes], "id bigint, bits int").coalesce(1) \
        .write.parquet(f"{path}/codes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shipped = spark.sparkContext.broadcast((codes, _range_bounds(stored, parts)))

    def pack(batches):
        rows, bounds = shipped.value
        book, turn = Codebook(rows[:, 0], rows[:, 1]), 0
        for batch in slices(batches, 256, 512 << 10):  # what is worked on stays in the processor's cache
            ids = [_from_planes(p) for p in batch.column("planes").to_pylist()]
            n = np.array([len(i) for i in ids], np.int64)
            packed, size, marks = book.pack(np.concatenate(ids), n)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            part = []
            for doc, tie in zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()):
                key = (doc is not None, doc or 0, tie)
                low, high = bisect_left(bounds, key), bisect_right(bounds, key)
                turn += 1
                part.append(low + turn % (high - low + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("tie"), pa.array(part, pa.int32()), pa.array(n),
                pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]),
                list_column((n + STRIDE - 1) // STRIDE, marks, pa.int64()),
            ], ["doc_id", "tie", "part", "n_tokens", "codes", "marks"])

    def number(batches):
        at = 0
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            begin = np.cumsum(n) - n + at
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part")), pa.array(begin),
                                              *(batch.column(c) for c in ("n_tokens", "codes", "marks"))],
                                             ["doc_id", "part", "at", "n_tokens", "codes", "marks"])

    packed = stored.where("counts IS NULL").select("doc_id", "tie", "planes").mapInArrow(
        pack, "doc_id bigint, tie bigint, part int, n_tokens bigint, codes binary, marks array<bigint>")
    packed.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "tie").mapInArrow(number, FILE_SCHEMA) \
        .write.parquet(f"{path}/ids")


def _decoded(spark: SparkSession, path: str, make, schema: str) -> DataFrame:
    book = [(r["id"], r["bits"]) for r in spark.read.schema("id bigint, bits int").parquet(f"{path}/codes").collect()]
    shipped = spark.sparkContext.broadcast(np.array(book, np.int64).reshape(-1, 2))

    def decode(batches):
        book = Codebook(shipped.value[:, 0], shipped.value[:, 1])
        for batch in slices(batches, 512, 1 << 20):
            codes = batch.column("codes").to_pylist()
            size = np.array([len(c) for c in codes], np.int64)
            n = batch.column("n_tokens").to_numpy()
            marks = batch.column("marks").flatten().to_numpy()
            yield make(batch, book.unpack(b"".join(codes), np.cumsum(size) - size, n, marks), n)

    return spark.read.schema(FILE_SCHEMA).parquet(f"{path}/ids").mapInArrow(decode, schema)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document's ids, with the file part and the place inside it."""
    def rows(batch, ids, n):
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "part", "at", "n_tokens")), list_column(n, ids.astype(np.int64), pa.int64())],
            ["doc_id", "part", "at", "n_tokens", "ids"])

    return _decoded(spark, path, rows, ID_SCHEMA)


def token_file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the decoded files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the place inside the part plus the ids of all parts before it; the totals are one row per
    part, so their running sum needs no spread.
    """
    def rows(batch, ids, n):
        whole, ends = memoryview(np.ascontiguousarray(ids, "<u4").tobytes()), 4 * np.cumsum(n)
        sums = [zlib.crc32(whole[e - 4 * k:e]) for e, k in zip(ends.tolist(), n.tolist())]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "part", "at", "n_tokens")), pa.array(sums, pa.int64())],
            ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    totals = (
        spark.read.schema(FILE_SCHEMA).parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("total"))
        .selectExpr("part", "coalesce(sum(total) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base")
    )
    return (
        _decoded(spark, path, rows, "doc_id bigint, part int, at bigint, n_tokens bigint, ids_crc32 bigint")
        .join(totals, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_file_round_trip(docs: DataFrame, tokenizer: bytes, end_id: int = 0) -> DataFrame:
    """Writes the files below the shared folder and returns what reading them back gives."""
    path = shared_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return token_file_checksums(docs.sparkSession, path)
