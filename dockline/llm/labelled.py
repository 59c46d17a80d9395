"""Bounded samples of labelled documents, to fit a classifier on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LONG, FEWEST = 64, 4


def held_out(remainder: int, modulus: int) -> Column:
    """True where crc32 of the doc_id's decimal digits leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most_rows: int,
                   most_bytes: int = 32 << 20) -> tuple[list[bytes], np.ndarray, float]:
    """Distinct whole texts with label 0 or 1 among the rows that ``learn`` allows, and the share of label 1
    among all of those rows.

    The sample is bounded: of each class the ``most_rows`` ids of least hash, and of those as many whole texts,
    in the same order, as half of ``most_bytes`` holds. An id with a text over a LONG-th of that half stands
    behind all others, shorter ones first, so a long text takes no other's place; the first FEWEST of a class
    are taken at any length. Rows without id or label are left out, an id labelled twice counts with its larger
    label, and an id with several texts with the least of them. Ids are chosen by hash and length; texts are
    not moved before the join with the chosen ids, by broadcast, has thinned them.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(learn)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label")).where("_label IN (0, 1)")
    ones = known.agg(F.avg("_label")).first()[0]
    whole = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    sizes = known.join(whole.groupBy("doc_id").agg(F.max(F.octet_length("_text")).cast("bigint").alias("_bytes")), "doc_id")
    long = F.when(F.col("_bytes") > most_bytes // 2 // LONG, F.col("_bytes")).otherwise(0)
    order = [long, F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = sizes.where(F.col("_label") == value).orderBy(*order).limit(most_rows)
        chosen = part if chosen is None else chosen.unionAll(part)
    ranked = W.partitionBy("_label").orderBy(*order)
    chosen = chosen.select("doc_id", "_label", F.sum("_bytes").over(ranked.rowsBetween(W.unboundedPreceding, 0)).alias("_sum"),
                           F.row_number().over(ranked).alias("_rank"))
    chosen = chosen.where((F.col("_sum") <= most_bytes // 2) | (F.col("_rank") <= FEWEST)).select("doc_id", "_label")
    rows = whole.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min("_text").alias("_text")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").select(F.col("_text").cast("binary").alias("_text"), "_label").collect()
    seen: dict[bytes, int] = {}
    for r in rows:
        text = bytes(r["_text"])
        seen[text] = max(seen.get(text, 0), r["_label"])
    return list(seen), np.array(list(seen.values()), np.int64), float(ones or 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; ``x`` holds its own constant column."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
