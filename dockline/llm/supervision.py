"""Quality rules under weak supervision.

Every rule votes good or bad on a document or abstains. Expectation-maximisation over the vote patterns of all
documents estimates how each rule votes on good and on bad ones; a document is kept when its posterior
probability of being good is at least one half. There are at most 3**rules patterns, so their counts are the
only thing that reaches the driver, whatever the number of documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices, text_bytes
from dockline.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
SIGNS = SYMBOLS + b"!"
WINDOW = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ABSTAIN, GOOD, BAD = 0, 1, 2
# A rule reads one measure: good up to the first bound, bad from the second on, no vote between them. Each kind
# of junk moves two or three of the measures, which is what tells it from a rule that errs. Repetition is left
# to the base rule.
RULES = {
    "symbols": ("symbols a word", 0.05, 0.2),
    "symbol words": ("share of words with a symbol", 0.03, 0.12),
    "capitals": ("share of capitals among A-Z and a-z", 0.15, 0.4),
    "shouts": ("exclamation marks a word", 0.05, 0.2),
    "signs": ("share of words with a symbol or an exclamation mark", 0.1, 0.3),
    "runs": ("longest run of one word", 2, 5),
    "length": ("characters a word", 10, 20),
}
CONTINUED = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(65, 91))
NO_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of five that the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:n + i] for i in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    seen = Counter(windows)
    hit = np.fromiter((seen[w] > 1 for w in windows), bool, n)
    cover = np.zeros(n + WINDOW, np.int64)
    cover[:n] += hit
    cover[WINDOW:] -= hit
    return int((np.cumsum(cover) > 0).sum())


def measures(text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base columns, and the measures of the rules in their order."""
    words = text.split()
    n = len(words)
    characters = len(b"".join(words).translate(None, CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    shouts = text.count(b"!")
    lines = [line for line in text.split(b"\n") if line.strip()]
    marked = sum(len(w.translate(None, SYMBOLS)) < len(w) for w in words) if symbols else 0
    signed = sum(len(w.translate(None, SIGNS)) < len(w) for w in words) if shouts else marked
    again = repeated_words(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    letters = len(text.translate(None, NO_LETTER))
    longest = run = 1 if n else 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        if run > longest:
            longest = run
    share = lambda x, of: x / of if of else 0.0
    return ((n, characters, symbols, len(lines) - len(set(lines)), again),
            (share(symbols, n), share(marked, n), share(capitals, letters), share(shouts, n), share(signed, n), longest,
             share(characters, n)))


def pattern_of(values) -> int:
    """The votes as one number to the base three."""
    out = 0
    for value, (_, good, bad) in zip(values, RULES.values()):
        out = 3 * out + (GOOD if value <= good else BAD if value >= bad else ABSTAIN)
    return out


def votes_of(patterns: np.ndarray) -> np.ndarray:
    """(patterns, rules) votes."""
    powers = 3 ** np.arange(len(RULES))[::-1]
    return patterns[:, None] // powers % 3


@dataclass
class VoteModel:
    """How rules vote: ``table[y, rule, vote]`` for bad (0) and good (1) documents, and the share of good ones."""
    table: np.ndarray
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        votes = votes_of(patterns)
        each = np.log(self.table)[:, np.arange(votes.shape[1]), votes].sum(2)
        odds = each[1] - each[0] + np.log(self.good / (1 - self.good))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation on the patterns, each weighted with its documents.

    It starts from the belief that a document with a bad vote is bad, so that "good" keeps its meaning. One
    imagined document of every vote and class keeps all probabilities positive; without documents every
    pattern with a good vote and no bad one is good.
    """
    votes = votes_of(patterns)
    belief = np.where((votes == BAD).any(1), 0.05, 0.95)
    one_hot = np.stack([votes == v for v in (ABSTAIN, GOOD, BAD)], 2).astype(float)
    # Imagined documents: a good one votes good, a bad one bad, a little more often than otherwise.
    lean = np.array([[1.0, 0.5, 1.5], [1.0, 1.5, 0.5]])[:, None, :]
    model = None
    for _ in range(rounds):
        weight = np.stack([counts * (1 - belief), counts * belief])
        table = np.einsum("yp,prv->yrv", weight, one_hot) + lean
        table /= table.sum(2, keepdims=True)
        total = weight.sum(1) + 1
        model = VoteModel(table, float(total[1] / total.sum()))
        new = model.posterior(patterns)
        if np.abs(new - belief).max(initial=0) < 1e-9:
            break
        belief = new
    return model


def fit_votes(measured: DataFrame) -> VoteModel:
    """From the pattern counts of all documents that the base rule does not reject."""
    rows = measured.where("NOT base_failed").groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    return estimate(np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.float64))


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def measured_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base columns, base_failed and the vote pattern of every row."""
    def run(batches):
        for batch in slices(batches):
            got = [measures(t) for t in batch.column(1).to_pylist()]
            base = np.array([g[0] for g in got], np.int64).reshape(-1, len(BASE))
            votes = [pattern_of(g[1]) for g in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in base.T), pa.array(votes, pa.int64())],
                                             ["doc_id", *BASE, "pattern"])

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", pattern bigint"
    rows = docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, schema)
    return rows.withColumn("base_failed", F.expr(BASE_FAILED))


def quality_votes(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base columns, base_failed, posterior and kept for every row.

    * Null texts count as empty: no words, base_failed, not kept.
    * Repeated rows are judged (and counted) each; a null doc_id stays null; extra columns are not read; an
      empty table gives an empty result. Long texts are measured whole.
    """
    measured = cut_lineage(measured_documents(docs), "votes")
    model = fit_votes(measured)
    every = np.arange(3 ** len(RULES))
    shipped = docs.sparkSession.createDataFrame(
        [(int(p), float(q)) for p, q in zip(every, model.posterior(every))], "pattern bigint, posterior double")
    return measured.join(F.broadcast(shipped), "pattern").select(
        "doc_id", *BASE, "base_failed", "posterior", (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"))


def passing(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that ``quality_votes`` keeps."""
    model = fit_votes(measured_documents(docs))
    good = docs.sparkSession.sparkContext.broadcast(model.posterior(np.arange(3 ** len(RULES))) >= 0.5)

    @F.pandas_udf("boolean")
    def kept(texts):
        def one(text):
            base, values = measures(text)
            return base[0] >= 10 and 100 * base[4] <= 20 * base[0] and bool(good.value[pattern_of(values)])
        return texts.map(one).astype(bool)

    return docs.where(kept(text_bytes()))
