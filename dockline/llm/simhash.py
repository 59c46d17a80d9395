"""SimHash near-duplicates over an inverted index of positional bytes.

Two 64-bit fingerprints that differ in at most two bits share at least six of their eight bytes in place.
The index has one posting for a set of positions and the bytes found there; every six positions hold one of
the sets, so each qualifying pair meets in some posting. There the shared bytes of a pair are tallied over all
eight positions, pairs below six are let go, and the rest is verified by the differing bits.

A set has five positions, so a posting holds at most 2**24 distinct fingerprints, and a large one is split by
the further bytes before any pair is looked at. Only distinct fingerprints are in the index, whatever the
number of documents behind them. A posting gives the links of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices, text_bytes
from dockline.llm.components import connected_components, local_roots
from dockline.session import cut_lineage

BYTES, MOST_BITS, SHINGLE, SEED = 8, 2, 3, 42
NEEDED = BYTES - MOST_BITS
BLOCK = 512


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 values of all word shingles."""
    words = text.lower().split()  # bytes: A-Z only, and white space is 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-1]]
        digest, view = xxhash.xxh64_intdigest, memoryview(joined)
        hashes = [digest(view[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    major = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(major).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""
    def run(batches):
        for batch in slices(batches, 2048):
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def position_sets(size: int = NEEDED - 1) -> list[tuple[int, ...]]:
    """Sets of ``size`` positions such that any NEEDED of the BYTES positions hold at least one of them."""
    open_, chosen = set(combinations(range(BYTES), NEEDED)), []
    while open_:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(o) for o in open_))
        chosen.append(best)
        open_ = {o for o in open_ if not set(best) <= set(o)}
    return chosen


def posting_links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (as places in ``values``, all distinct) within MOST_BITS; a spanning forest of them.

    Pairs are tallied in blocks. A posting over one block is first cut by the values of the bytes on which
    its members still differ: a pair that shares NEEDED bytes shares all but MOST_BITS of those.
    """
    n = len(values)
    if n > BLOCK:
        octets = values.view(np.uint8).reshape(n, 8)
        free = [p for p in range(8) if (octets[:, p] != octets[0, p]).any()]
        if len(free) > MOST_BITS:
            a, b = [], []
            for more in combinations(free, len(free) - MOST_BITS):
                key = np.zeros(n, np.uint64)
                for p in more:
                    key = key << np.uint64(8) | octets[:, p]
                order = np.argsort(key, kind="stable")
                cut = np.flatnonzero(np.diff(key[order])) + 1
                for group in np.split(order, cut):
                    if len(group) > 1:
                        x, y = posting_links(values[group])
                        a.append(group[x])
                        b.append(group[y])
            a, b = np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])
            return _forest(n, a, b)
    a, b = [], []
    for i in range(0, n, BLOCK):
        for j in range(i, n, BLOCK):
            differ = values[i:i + BLOCK, None] ^ values[None, j:j + BLOCK]
            shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(2)
            x, y = np.nonzero(shared >= NEEDED)
            near = np.bitwise_count(differ[x, y]) <= MOST_BITS
            x, y = x[near] + i, y[near] + j
            a.append(x[x < y])
            b.append(y[x < y])
    return _forest(n, np.concatenate(a), np.concatenate(b))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    root = local_roots(n, a, b)
    other = np.flatnonzero(root != np.arange(n))
    return other, root[other]


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between the fingerprints of ``distinct`` (fp) that span all pairs within MOST_BITS."""
    keys = []
    for number, places in enumerate(position_sets()):
        key = F.lit(number).cast("bigint")
        for p in places:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255))
        keys.append(key)

    def run(batches):
        left_key, left_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch, last in _with_last(batches):
            key = np.concatenate([left_key, batch.column(0).to_numpy()]) if batch is not None else left_key
            fp = np.concatenate([left_fp, batch.column(1).to_numpy()]) if batch is not None else left_fp
            whole = len(key) if last else int(np.searchsorted(key, key[-1])) if len(key) else 0
            left_key, left_fp = key[whole:], fp[whole:]
            yield _links_of(key[:whole], fp[:whole])

    index = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
    return index.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint").where("a is not null")


def _with_last(batches):
    """Each batch with whether it is the last one; an empty input gives one round."""
    held = None
    for batch in batches:
        if held is not None:
            yield held, False
        held = batch
    yield held, True


def _links_of(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    ends = np.append(starts[1:], len(key))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    pair = ends - starts == 2  # most postings: one comparison each, all at once
    x, y = fp[starts[pair]], fp[starts[pair] + 1]
    near = np.bitwise_count(x ^ y) <= MOST_BITS
    a.append(x[near])
    b.append(y[near])
    for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
        group = np.ascontiguousarray(fp[s:e]).view(np.uint64)
        x, y = posting_links(group)
        a.append(fp[s:e][x])
        b.append(fp[s:e][y])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) for every row.

    * Null and empty texts, and texts of white space alone, have the fingerprint zero and link like any other.
    * Repeated rows each come out; a null doc_id stays null and never is the smallest of a component, unless
      no row of it has an id (then component_id is null).
    * Long texts are hashed whole. Extra columns are not read. An empty table gives an empty result.
    """
    prints = cut_lineage(fingerprints(docs), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = cut_lineage(distinct, "distinct-fingerprints")
    member = connected_components(fingerprint_links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    linked = cut_lineage(distinct.join(member, "fp"), "linked-fingerprints")
    best = linked.groupBy("root").agg(F.min("least").alias("component"))
    found = linked.join(best, "root").select("fp", "component")
    component = distinct.join(found, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    return prints.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of every group, all columns: of the rows with the smallest doc_id that of the least text hash.

    The choice is made on (fingerprint, id, hash) alone; texts are read once more, and only rows that a group
    keeps are taken. Of rows that agree in id and text one stays; rows without id keep one per group only
    where the group has no id at all. Which rows are repeated is known from ids and hashes, so only those are
    compared once more.

    * Null and empty texts form one group. Extra columns come out as they went in; empty in, empty out.
    """
    spare = "_fp"
    while spare in docs.columns:
        spare += "_"

    @F.pandas_udf("bigint")
    def fp(texts):
        return texts.map(fingerprint).map(lambda v: v - (1 << 64) if v >> 63 else v).astype("int64")

    prints = cut_lineage(docs.select("doc_id", F.xxhash64("text").alias("tie"), fp(text_bytes()).alias("fp")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tie", (F.col("rows") > 1).alias("many"))
    counted = prints.groupBy("fp", "doc_id", "tie").agg(F.count("*").alias("rows"))
    distinct = cut_lineage(counted.groupBy("fp").agg(F.min(order).alias("least")), "distinct-fingerprints")
    member = connected_components(fingerprint_links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    chosen = cut_lineage(
        distinct.join(member, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
        .select(F.col("least.doc_id").alias("_doc"), F.col("least.tie").alias("_tie"), F.col("least.many").alias("_many")), "chosen")
    names = [F.col(f"`{c}`") for c in docs.columns]
    numbered = docs.select("*", F.xxhash64("text").alias(spare))

    def kept(some: DataFrame) -> DataFrame:
        return numbered.join(some, numbered["doc_id"].eqNullSafe(some["_doc"]) & (numbered[spare] == some["_tie"]), "left_semi")

    once = kept(chosen.where("NOT _many")).select(*names)
    many = kept(chosen.where("_many")).dropDuplicates(["doc_id", spare]).select(*names)
    return once.unionByName(many)
