"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Terms are hashed byte trigrams, trigrams of character shapes, and words that repeat their predecessor. Their
document frequencies come from all documents; the space and the labelled vectors from a bounded sample, which
is broadcast. Every document is compared with all of them, in blocks of exact cosine products.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices, text_bytes
from dockline.llm.labelled import held_out, labelled_texts

HASHED, SHAPES = 4096, 512
TERMS = HASHED + SHAPES + 1
RANK, NEAREST, SHARPNESS = 64, 15, 8
SAMPLE = 2000  # labelled texts of each class at most


def _shape_classes() -> np.ndarray:
    """Lower case, upper case, digits, white space, stops, other signs, bytes of wider characters, the rest."""
    table = np.full(256, 7, np.uint8)
    table[128:] = 6
    for signs, kind in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t\n\v\f\r", 3), (b".,;:?'\"-()", 4),
                        (b"!#$%&*+/<=>@[\\]^_`{|}~", 5)):
        table[list(signs)] = kind
    return table


SHAPE = _shape_classes()


def term_counts(text: bytes) -> np.ndarray:
    """How often each term occurs in the text."""
    octets = np.frombuffer(text, np.uint8)
    out = np.zeros(TERMS, np.float32)
    if len(octets) >= 3:
        wide = octets.astype(np.uint32)
        gram = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761) >> np.uint32(20)
        out[:HASHED] = np.bincount(gram, minlength=HASHED)
        kind = SHAPE[octets].astype(np.uint16)
        out[HASHED:-1] = np.bincount(kind[:-2] << 6 | kind[1:-1] << 3 | kind[2:], minlength=SHAPES)
    words = text.split()
    out[-1] = sum(map(eq, words, words[1:]))
    return out


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents; each task sends one row of TERMS sums."""
    def run(batches):
        total, n = np.zeros(TERMS, np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total += term_counts(text) > 0
                n += 1
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(ids, TERMS).astype(np.int32)), pa.array(np.append(total[ids], n))], ["term", "n"])

    rows = docs.select(text_bytes().alias("text")).mapInArrow(run, "term int, n bigint") \
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


@dataclass
class NeighbourModel:
    weight: np.ndarray      # inverse document frequencies
    space: np.ndarray       # terms to latent dimensions
    vectors: np.ndarray     # labelled documents, unit length
    labels: np.ndarray
    prior: float

    def embed(self, texts: list[bytes]) -> np.ndarray:
        return _unit(_unit(np.log1p(np.stack([term_counts(t) for t in texts])) * self.weight) @ self.space)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
        if not len(self.vectors):
            return np.full(len(texts), self.prior)
        near = self.embed(texts) @ self.vectors.T
        k = min(NEAREST, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        say = np.clip(np.take_along_axis(near, best, 1).astype(np.float64), 0, 1) ** SHARPNESS
        return ((say * self.labels[best]).sum(1) + 1e-3 * self.prior) / (say.sum(1) + 1e-3)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit_neighbours(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> NeighbourModel:
    """Fits on at most ``sample`` labelled texts of each class; without labels every score is 0.5."""
    texts, label, _ = labelled_texts(docs, labels, "quality", ~held_out(1, 3), sample)
    counts, n = document_frequencies(docs)
    weight = np.log((n + 1) / (counts + 1)).astype(np.float32) + np.float32(0.1)
    empty = np.zeros((0, RANK), np.float32)
    model = NeighbourModel(weight, np.zeros((TERMS, RANK), np.float32), empty, label, float(label.mean()) if len(label) else 0.5)
    if not texts:
        return model
    rows = _unit(np.log1p(np.stack([term_counts(t) for t in texts])) * weight)
    # Leading right singular vectors by subspace iteration, from a fixed start.
    basis = np.random.default_rng(0).standard_normal((TERMS, min(RANK, len(texts)))).astype(np.float32)
    for _ in range(8):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    model.space = basis.astype(np.float32)
    model.vectors = _unit(rows @ model.space)
    return model


def quality_scores(docs: DataFrame, model: NeighbourModel) -> DataFrame:
    """(doc_id, score) for every row, over whole texts.

    * Null and empty texts have the zero vector, so that no neighbour votes: the score is the labels' share.
    * Repeated rows come out each; a null doc_id stays null; extra columns are not read; empty in, empty out.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, 256):
            scores = shipped.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = quality_scores(docs, fit_neighbours(docs, labels))
    return scored.select("doc_id", held_out(1, 3).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
