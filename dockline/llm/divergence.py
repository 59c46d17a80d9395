"""How far the sources of a language differ in their words, in exact integers.

CountVectorizer builds one vocabulary per language and turns every document into a sparse vector of counts. Vectors
are summed per (language, source) over their non-zero places only, and pairs of sources are compared from those sums:
terms that one of two sources lacks enter through a histogram of counts, so only shared terms are joined.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from dockline.llm.common import list_column, slices, text_bytes
from dockline.session import cut_lineage, shared_path

LEAST_DOCUMENTS, TOP_TERMS, UNIT = 10, 10, 1_000_000_000
LARGEST_VOCABULARY = 2 ** 31 - 1
FEW = 10_000
BLOCK_BITS, PENDING = 10, 2_000_000
SUMS = "v int, source string, place int, n bigint"
BLOCKS = "v int, source string, block int, places array<int>, counts array<bigint>"


def _letters() -> bytes:
    """What a byte of UTF-8 becomes: A-Z lower-cased, other letters and all bytes above ASCII kept, the rest a space."""
    kept = set(range(65, 91)) | set(range(97, 123)) | set(range(128, 256))
    return bytes((b + 32 if b < 91 else b) if b in kept else 32 for b in range(256))


LETTERS = _letters()


def term_lists(texts: pa.Array) -> pa.Array:
    """The terms of every text, found for a whole batch of texts at once."""
    joined, ends, at = [], np.zeros(len(texts), np.int64), 0
    for i, text in enumerate(texts.to_pylist()):
        joined.append(text.translate(LETTERS))
        at += len(text) + 1
        ends[i] = at
    octets = np.frombuffer(b" ".join(joined) + b" ", np.uint8)
    inside = octets != 32
    border = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, stop = border[::2], border[1::2]
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(stop - start, out=offsets[1:])
    terms = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(octets[inside]))
    counts = np.searchsorted(start, ends)
    return list_column(np.diff(counts, prepend=0), terms, pa.string())


def terms_table(docs: DataFrame) -> DataFrame:
    """(lang, source, terms) of every row; only A-Z are lower-cased, a term is a run of other signs than ASCII's non-letters."""
    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), term_lists(batch.column(0))], ["lang", "source", "terms"])

    return docs.select(text_bytes().alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]) \
        .mapInArrow(run, "lang string, source string, terms array<string>")


def _known(frame: DataFrame, rows: int) -> DataFrame:
    """A frame made from ``rows`` rows of the driver, broadcast while they are few."""
    return F.broadcast(frame) if rows <= FEW else frame


def document_vectors(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Languages, vocabularies and document vectors.

    Returns (lang, v, n_terms): a number for each language and the size of its vocabulary; (v, place, term): what
    stands at each place of it; and (v, source, vector) for every document. Terms are written below a folder for
    each language, so that a fit reads its own language only; vocabularies are held by the driver, one at a time.

    Every fit is a job of its own, so the number of languages should be moderate; the number of sources is free.

    * Null text, lang and source count as ''. A language without a frequent term has an empty vocabulary.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    names = [r["lang"] for r in docs.select(lang.alias("lang")).distinct().orderBy("lang").collect()]  # one row per language
    numbers = spark.createDataFrame(list(enumerate(names)), "v int, lang string")
    path = shared_path(spark, "terms")
    terms_table(docs).join(_known(numbers, len(names)), "lang").select("v", "source", "terms") \
        .write.partitionBy("v").parquet(path)
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least_documents), vocabSize=LARGEST_VOCABULARY)
    sizes, vocabularies, vectors = [], [], []
    for v, name in enumerate(names):
        own = spark.read.schema("source string, terms array<string>").parquet(f"{path}/v={v}")
        model = vectorizer.fit(own)
        kept = shared_path(spark, "vocabulary")
        model.write().save(kept)
        vectors.append(model.transform(own).select(F.lit(v).alias("v"), "source", "vector"))
        sizes.append((v, name, len(model.vocabulary)))
        vocabularies.append(spark.read.schema("vocabulary array<string>").parquet(f"{kept}/data").select(
            F.lit(v).alias("v"), F.posexplode("vocabulary").alias("place", "term")))
    known = _known(spark.createDataFrame(sizes, "v int, lang string, n_terms bigint"), len(sizes))
    empty = spark.createDataFrame([], "v int, place int, term string")
    if not names:
        return known, empty, spark.createDataFrame([], "v int, source string"), []
    groups = spark.read.schema("source string, v int").parquet(path).select("v", "source")
    return known, reduce(DataFrame.unionByName, vocabularies, empty), groups, vectors


def _block_rows(v: int, sources: pa.Array, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sums as one row per (source, block of places); ``keys`` ascend and hold the source's number above the place."""
    block = keys >> BLOCK_BITS
    first = np.flatnonzero(np.diff(block, prepend=-1))
    lengths = np.diff(first, append=len(keys))
    head, in_key = block[first], 32 - BLOCK_BITS
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(first), v, np.int32)), sources.take(pa.array(head >> in_key)),
        pa.array((head & (1 << in_key) - 1).astype(np.int32)),
        list_column(lengths, (keys & 0xFFFFFFFF).astype(np.int32), pa.int32()), list_column(lengths, counts, pa.int64())],
        ["v", "source", "block", "places", "counts"])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys, each once, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _sum_vectors(batches):
    """Blocks of sums of (v, source, vector) rows of one v; at most PENDING sums wait in the task."""
    names: dict = {}
    waiting, held, v = [], 0, 0

    def flush():
        keys, counts = _summed(*[np.concatenate(part) for part in zip(*waiting)])
        return _block_rows(v, pa.array(list(names), pa.string()), keys, counts)

    for batch in slices(batches, 4096, 32 << 20):
        sources = batch.column(1).dictionary_encode()
        vector = batch.column(2)
        places = vector.field("indices")
        place, count = places.flatten().to_numpy(), vector.field("values").flatten().to_numpy()
        if not len(place):
            continue
        v = batch.column(0)[0].as_py()
        number = np.array([names.setdefault(name, len(names)) for name in sources.dictionary.to_pylist()], np.int64)
        group = np.repeat(number[sources.indices.to_numpy()], np.diff(places.offsets.to_numpy()))
        size = int(place.max()) + 1
        if size * len(names) <= 16 * len(place):  # few cells: one sum each
            sums = np.bincount(group * size + place, count)  # exact: whole numbers far below 2**53
            at = np.flatnonzero(sums)
            keys, n = at // size << 32 | at % size, sums[at].astype(np.int64)
        else:
            keys, n = _summed(group << 32 | place, count.astype(np.int64))
        waiting.append((keys, n))
        held += len(keys)
        if held > PENDING:
            yield flush()
            names, waiting, held = {}, [], 0
    if waiting:
        yield flush()


def _merge_blocks(batches):
    """(v, source, place, n) from rows of blocks that are sorted by (v, source, block); one block stays open."""
    last, open_sums = None, None
    names = ["v", "source", "place", "n"]

    def told(keys, sums):
        row, at = np.nonzero(sums)
        v, source, block = (pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int32())))
        place = block.to_numpy()[row] << BLOCK_BITS | at
        row = pa.array(row)
        return pa.RecordBatch.from_arrays([v.take(row), source.take(row), pa.array(place.astype(np.int32)), pa.array(sums[sums != 0])], names)

    for batch in slices(batches, 1024):
        rows = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
        keys = [k for i, k in enumerate(rows) if i == 0 or k != rows[i - 1]]
        number = np.cumsum([i > 0 and k != rows[i - 1] for i, k in enumerate(rows)])
        lengths = np.diff(batch.column(3).offsets.to_numpy())
        at = np.repeat(number, lengths) << BLOCK_BITS | batch.column(3).flatten().to_numpy() & (1 << BLOCK_BITS) - 1
        sums = np.zeros(len(keys) << BLOCK_BITS, np.int64)
        np.add.at(sums, at, batch.column(4).flatten().to_numpy())
        sums = sums.reshape(len(keys), -1)
        if keys[0] == last:
            sums[0] += open_sums
        elif last is not None:
            yield told([last], open_sums[None])
        last, open_sums = keys[-1], sums[-1]
        yield told(keys[:-1], sums[:-1])
    if last is not None:
        yield told([last], open_sums[None])


def group_sums(vectors: list[DataFrame], spark: SparkSession) -> DataFrame:
    """(v, source, place, n): summed counts of every group, for the places where they are not 0.

    Sparse vectors are summed by (source, place) inside the tasks. What is shuffled is one row per (source, block of
    1,024 places) with its sums, so a hot source is spread over its blocks; rows of a block are then added up as they
    come, and no task holds more than one batch of them.
    """
    parts = [frame.mapInArrow(_sum_vectors, BLOCKS) for frame in vectors]
    key = ["v", "source", "block"]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], BLOCKS)) \
        .repartition(*key).sortWithinPartitions(*key).mapInArrow(_merge_blocks, SUMS)


def _share(n: str, total: str, terms: str = "n_terms") -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact for any long; null where there are no terms.

    Counts whose product with UNIT could pass a long are multiplied as decimals.
    """
    whole = f"nullif({total} + 2 * {terms}, 0)"
    return F.expr(f"1 + CASE WHEN {n} < 9000000000 THEN ({UNIT} * ({n} + 2)) div {whole} "
                  f"ELSE (cast({n} + 2 AS decimal(20,0)) * cast({UNIT} AS decimal(10,0))) div cast({whole} AS decimal(20,0)) END")


def _apart(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so their squares are longs."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def source_pairs(groups: DataFrame, marked: DataFrame) -> DataFrame:
    """(g, h, value) for every ordered pair of groups of one language, summed over all its terms.

    ``groups`` holds (g, v, n_terms, zero), the share of a term that a group lacks; ``marked`` holds (g, v, zero,
    place, p) where a group has a term. A sum over all terms is the sum as if both lacked them all, plus what
    each group's own terms change (from its histogram of shares), plus what shared terms change beyond that.
    """
    other = groups.select("v", F.col("g").alias("h"), F.col("zero").alias("other_zero"))
    none = groups.join(other, "v").where("g <> h").select("g", "h", F.expr(f"n_terms * ({_apart('zero', 'other_zero')})").alias("value"))
    histogram = marked.groupBy("g", "v", "zero", "p").agg(F.count("*").alias("terms"))
    alone = histogram.join(other, "v").where("g <> h").groupBy("g", "h").agg(
        F.sum(F.expr(f"terms * (({_apart('p', 'other_zero')}) - ({_apart('zero', 'other_zero')}))")).alias("value"))
    second = marked.select("v", "place", F.col("g").alias("h"), F.col("p").alias("q"), F.col("zero").alias("other_zero"))
    shared = marked.join(second, ["v", "place"]).where("g < h").groupBy("g", "h").agg(F.sum(F.expr(
        f"({_apart('p', 'q')}) - ({_apart('p', 'other_zero')}) - ({_apart('zero', 'q')}) + ({_apart('zero', 'other_zero')})")).alias("value"))
    ways = F.explode(F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h"))))
    both = alone.unionByName(shared).select("value", ways.alias("w")).select("w.g", "w.h", "value")
    return none.unionByName(both).groupBy("g", "h").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value"))


def marking_terms(sizes: DataFrame, sums: DataFrame, marked: DataFrame, vocabularies: DataFrame) -> DataFrame:
    """(g, item, value) for the terms commoner in a group than in its whole language."""
    whole = sums.groupBy("v", "place").agg(F.sum("n").alias("n"))
    totals = whole.groupBy("v").agg(F.sum("n").alias("total")).join(sizes, "v")
    usual = whole.join(F.broadcast(totals), "v").select("v", "place", _share("n", "total").alias("q"))  # a row per language
    return marked.join(usual, ["v", "place"]).where("p > q").join(vocabularies, ["v", "place"]).select(
        "g", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))


def source_divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: of each source, how far the others are and what marks it.

    Part ``pair`` ranks all other sources of the language by the sum over its terms of (p - q)^2 / (p + q), rounded
    down, part ``term`` the ``top`` terms that are commoner in the source than in the language.

    * Null text, lang and source count as ''; a group without terms still has pairs. Without frequent terms all pairs
      have the value 0 and there are no terms. Ties rank by the UTF-8 of the item.
    * Repeated rows are documents of their own; extra columns are not read; empty in, empty out.
    """
    sizes, vocabularies, sources, vectors = document_vectors(docs, least_documents)
    sums = cut_lineage(group_sums(vectors, docs.sparkSession), "group-sums")
    totals = sums.groupBy("v", "source").agg(F.sum("n").alias("total"))
    groups = sources.distinct().join(totals, ["v", "source"], "left").join(sizes, "v") \
        .select("v", "lang", "source", "n_terms", F.coalesce("total", F.lit(0)).alias("total"))
    groups = cut_lineage(groups.withColumn("zero", _share("0", "total")).withColumn("g", F.monotonically_increasing_id()), "groups")
    marked = cut_lineage(sums.join(groups.select("g", "v", "source", "n_terms", "total", "zero"), ["v", "source"]).select(
        "g", "v", "place", "zero", _share("n", "total").alias("p")), "shares")
    other = groups.select(F.col("g").alias("h"), F.col("source").alias("item"))
    place = Window.partitionBy("g").orderBy(F.col("value").desc(), "item")
    pairs = source_pairs(groups.select("g", "v", "n_terms", "zero"), marked).join(other, "h").drop("h").withColumn("rank", F.row_number().over(place))
    terms = marking_terms(sizes, sums, marked, vocabularies).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.join(groups.select("g", "lang", "source"), "g").select(
        "lang", "source", "part", "item", F.col("value").cast("bigint").alias("value"), "rank")
