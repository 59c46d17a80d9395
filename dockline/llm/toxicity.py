"""Toxicity by compression distance between two zstandard dictionaries.

The ordinary dictionary is trained on words of ordinary texts. The toxic one is that dictionary behind what
training on toxic strings adds, so that a window's two compressed lengths differ only where toxic strings
help. Toxic strings are the stretches of words whose byte n-grams occur in toxic texts far more often than in
ordinary ones. A document's largest differences, with its number of windows, give a score whose weights are
calibrated on the labelled sample, each half with dictionaries trained on the other.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices, text_bytes
from dockline.llm.labelled import held_out, labelled_texts, logistic

GRAM, WINDOW, SIZE = 5, 60, 8192
SHARE, RATIO, FEWEST = 0.003, 20, 4
SAMPLE = 1500  # labelled texts of each class at most
THRESHOLD = 0.3
CUT = re.compile(rb"\S(?:.{0,%d}(?!\S)|.{%d}\S*)" % (WINDOW - 1, WINDOW - 1), re.S)


def _words(text: bytes) -> list[bytes]:
    return [b" " + w + b" " for w in text.lower().split()]


def _grams(content: bytes) -> np.ndarray:
    """All byte n-grams as numbers."""
    octets = np.frombuffer(content, np.uint8).astype(np.uint64)
    n = max(0, len(octets) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = out << np.uint64(8) | octets[i:i + n]
    return out


def _lower_line(text: bytes) -> bytes:
    return b" " + b" ".join(text.lower().split()) + b" "


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [np.unique(_grams(_lower_line(t))) for t in texts]
    return np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)


def toxic_strings(toxic: list[bytes], ordinary: list[bytes]) -> Counter:
    """Stretches of toxic words covered by n-grams that mark toxic texts, with how often they occur."""
    grams, times = _document_counts(toxic)
    known, others = _document_counts(ordinary)
    there = np.isin(grams, known)
    in_ordinary = np.zeros(len(grams))
    in_ordinary[there] = others[np.searchsorted(known, grams[there])]
    mark = (times >= max(FEWEST, SHARE * len(toxic))) & (
        times * max(1, len(ordinary)) >= RATIO * (in_ordinary + 0.5) * len(toxic))
    marking = set(grams[mark].tolist())
    words = Counter(w for t in toxic for w in _words(t))
    out: Counter = Counter()
    for word, n in words.items():
        covered = bytearray(len(word))
        for k, gram in enumerate(_grams(word).tolist()):
            if gram in marking:
                covered[k:k + GRAM] = b"\1" * GRAM
        if any(covered):
            out[bytes(b for b, c in zip(word, covered) if c)] += n
    return out


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except (zstandard.ZstdError, MemoryError):
        return b"".join(sorted(set(samples)))[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    given = zstandard.ZstdCompressionParameters(
        window_log=16, hash_log=16, chain_log=16, search_log=6, min_match=GRAM, strategy=6, target_length=32,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    if not content:
        return zstandard.ZstdCompressor(compression_params=given)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=given)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=given)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    silent: float  # score of texts in which no window is shorter with the toxic dictionary

    def open(self):
        """The scoring function; compressors live in the task."""
        plain, extended = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)

        def features(text: bytes) -> np.ndarray:
            windows = [b" " + w + b" " for w in CUT.findall(text.lower())]
            gains = [len(plain.compress(w)) - len(extended.compress(w)) for w in windows]
            best = (sorted((g for g in gains if g > 0), reverse=True) + [0, 0, 0])[:3]
            return np.array([1.0, *best, np.log1p(len(windows))])

        return features

    def score(self, features: np.ndarray) -> float:
        if features[1] <= 0:
            return self.silent
        return float(1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30))))


def fit(texts: list[bytes], toxic: np.ndarray, share: float) -> ToxicityModel:
    """``share`` is that of toxic rows among all labelled ones, of which the sample holds another.

    Without toxic or without ordinary texts every score is the share of toxic ones (0 without labels).
    """
    prior = float(toxic.mean()) if len(toxic) else 0.0

    def dictionaries(rows):
        bad = [texts[i] for i in rows if toxic[i]]
        good = [texts[i] for i in rows if not toxic[i]]
        strings = toxic_strings(bad, good) if bad and good else Counter()
        words = [w for t in good for w in _words(t)]
        rng = np.random.default_rng(0)
        picked = [words[i] for i in rng.choice(len(words), 200_000)] if words else []
        # The commonest strings stand last, where matches are nearest.
        added = b"".join(s for s, n in sorted(strings.items(), key=lambda x: (x[1], x[0])) if n >= 2)[-SIZE:]
        return ToxicityModel(_trained(picked, 2 * SIZE)[-SIZE:] if picked else b"", added, np.zeros(5), prior)

    every = np.arange(len(texts))
    model = dictionaries(every)
    if prior in (0.0, 1.0):
        model.toxic = b""
        return model
    x = np.zeros((len(texts), 5))
    for half in (0, 1):
        features = dictionaries(every[every % 2 != half]).open()
        for i in every[every % 2 == half]:
            x[i] = features(texts[i])
    heard = x[:, 1] > 0
    if heard.any():
        model.weights = logistic(x[heard], toxic[heard])
        model.weights[0] += np.log(share / (1 - share)) - np.log(prior / (1 - prior))
    bad, good = toxic[~heard].sum() / prior * share, (1 - toxic[~heard]).sum() / (1 - prior) * (1 - share)
    model.silent = float(bad / (1 + bad + good))
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fits on at most ``sample`` labelled texts of each class; rows held out by contract are never read."""
    return fit(*labelled_texts(docs, labels, "toxic", ~held_out(2, 4), sample))


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) for every row, over whole texts.

    * Null and empty texts have no window and get the score of texts without a toxic gain.
    * Repeated rows come out each; a null doc_id stays null; extra columns are not read; empty in, empty out.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        features = shipped.value.open()
        for batch in slices(batches):
            scores = [shipped.value.score(features(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = toxicity_scores(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out(2, 4).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents, all columns, whose score stays below the threshold."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        model = shipped.value
        features = model.open()
        return texts.map(lambda t: model.score(features(t)) < THRESHOLD)

    return docs.where(clean(text_bytes()))
