"""Mixing documents to target weights over soft domains.

A classifier learnt from the labelled documents gives every document its domain posteriors. Rates, one per
document and never negative, are fitted by projected gradient steps of a least-squares problem: the expected
domain totals (tokens x rate x posterior, summed) shall match the targets. A step needs only the residual of
each domain, so it is one aggregate over the documents; a document's rate is recomputed from the short
history of residuals, and no per-document state passes through the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.llm.common import slices, text_bytes
from dockline.session import cut_lineage

HASHED = 4096
SAMPLE = 1000  # labelled texts of each domain at most
ROUNDS, CLOSE = 60, 1e-6
MOST_DOMAINS, OTHER = 64, "(other)"


def grams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased text."""
    octets = np.frombuffer(text.lower(), np.uint8).astype(np.uint32)
    if len(octets) < 3:
        return np.zeros(HASHED, np.float32)
    key = (octets[:-2] << 16 | octets[1:-1] << 8 | octets[2:]) * np.uint32(2654435761) >> np.uint32(20)
    return np.bincount(key, minlength=HASHED).astype(np.float32)


@dataclass
class DomainModel:
    """Multinomial naive Bayes with a temperature that grows with the text, so that posteriors stay soft."""
    domains: list[str]
    log_prior: np.ndarray
    log_term: np.ndarray
    pooled: frozenset[str] = frozenset()  # domains of the weights that are part of OTHER

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        counts = np.stack([grams(t) for t in texts])
        size = np.maximum(counts.sum(1, keepdims=True), 1)
        score = self.log_prior + counts @ self.log_term.T / np.sqrt(size)
        score = np.exp(score - score.max(1, keepdims=True))
        return (score / score.sum(1, keepdims=True)).astype(np.float64)


def fit_domains(docs: DataFrame, labels: DataFrame, domain: str = "lang", sample: int = SAMPLE,
                weights: Mapping[str, float] | None = None, most: int = MOST_DOMAINS) -> DomainModel:
    """Domains are the values of ``domain`` on labelled documents: those that ``weights`` names, then the commonest, ``most`` at most.

    All further ones together are one domain, ``OTHER``, with texts and posteriors of its own. Of each domain at most
    ``sample`` texts are learnt from, those of least id hash; their term counts are summed on the executors, so the
    driver gets one row per domain and term. Rows without id, text or domain are not learnt from. Without any there
    is one domain, "".
    """
    known = docs.join(labels.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi") \
        .where(F.col(domain).isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col(domain).cast("string").alias("_domain"))
    sizes = known.groupBy("_domain").count()
    asked = [k for k, w in (weights or {}).items() if w > 0]
    first = F.col("_domain").isin(asked) if asked else F.lit(False)
    common = sizes.orderBy(first.desc(), F.desc("count"), "_domain").limit(most).collect()
    names = sorted(r["_domain"] for r in common)
    if not names:
        return DomainModel([""], np.zeros(1), np.zeros((1, HASHED)))
    size_of = {r["_domain"]: r["count"] for r in common}
    rest = ~F.col("_domain").isin(names)
    beyond = sizes.where(rest).agg(F.sum("count")).first()[0] or 0  # one number
    pooled = frozenset(r["_domain"] for r in sizes.where(rest & first).collect()) if beyond and len(asked) > most else frozenset()
    parts = [(name, F.col("_domain") == name) for name in names]
    if beyond:
        parts.append((OTHER, rest))
        size_of[OTHER] = beyond
    chosen = None
    for name, own in parts:
        part = known.where(own).groupBy("doc_id", "_domain").count() \
            .orderBy(F.xxhash64("doc_id"), "doc_id", "_domain").limit(sample).select("doc_id", "_domain", F.lit(name).alias("_class"))
        chosen = part if chosen is None else chosen.unionAll(part)
    names = [name for name, _ in parts]
    place = {n: i for i, n in enumerate(names)}

    def count(batches):
        total = np.zeros((len(place), HASHED))
        for batch in slices(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[place[name]] += np.minimum(grams(text), 50)
        at, term = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(term.astype(np.int32)), pa.array(total[at, term])],
                                         ["at", "term", "n"])

    rows = docs.select("doc_id", F.col(domain).cast("string").alias("_domain"), text_bytes().alias("_text")) \
        .join(F.broadcast(chosen), ["doc_id", "_domain"]).select("_class", "_text") \
        .mapInArrow(count, "at int, term int, n double").groupBy("at", "term").agg(F.sum("n").alias("n")).collect()
    total = np.ones((len(names), HASHED))
    for r in rows:
        total[r["at"], r["term"]] += r["n"]
    prior = np.array([size_of[n] for n in names], float)
    return DomainModel(names, np.log(prior / prior.sum()), np.log(total / total.sum(1, keepdims=True)), pooled)


def membership(docs: DataFrame, model: DomainModel) -> DataFrame:
    """(doc_id, tokens, posteriors) for every row; tokens are the words of the whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, 256):
            texts = batch.column(1).to_pylist()
            post = shipped.value.posteriors(texts)
            tokens = np.array([len(t.split()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(tokens), pa.FixedSizeListArray.from_arrays(pa.array(post.reshape(-1)), post.shape[1])
                .cast(pa.list_(pa.float64()))], ["doc_id", "tokens", "posteriors"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, tokens bigint, posteriors array<double>")


@dataclass
class Rates:
    """The fitted steps: a document's rate is 1, changed by each step in turn and never below ``least``."""
    domains: list[str]
    targets: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: list[np.ndarray]
    least: float

    def column(self, posteriors: Column) -> Column:
        rate = F.lit(1.0)
        for step in self.steps:
            rate = F.greatest(F.lit(self.least), rate - _dot(posteriors, step))
        return rate

    def of(self, posteriors: np.ndarray) -> np.ndarray:
        rate = np.ones(len(posteriors))
        for step in self.steps:
            rate = np.maximum(self.least, rate - posteriors @ step)
        return rate

    def report(self, spark: SparkSession) -> DataFrame:
        """(domain, target, before, after): tokens wanted, had and reached of every domain."""
        rows = zip(self.domains, self.targets.tolist(), self.before.tolist(), self.after.tolist())
        return spark.createDataFrame(list(rows), "domain string, target double, before double, after double")


def _shares(domains: list[str], weights: Mapping[str, float] | None, pooled: frozenset[str], strict: bool) -> np.ndarray:
    """Target shares of the domains; weights of pooled domains go to OTHER, and one that nothing serves is told."""
    if weights is None:
        return np.full(len(domains), 1 / len(domains))
    unserved = sorted(d for d, w in weights.items() if w > 0 and d not in domains and d not in pooled)
    if unserved:
        said = f"no labelled document serves the weights of {unserved}; the others share their part"
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=3)
    share = np.array([float(weights.get(d, 0.0)) for d in domains])
    if OTHER in domains:
        share[domains.index(OTHER)] += sum(weights[d] for d in pooled)
    return share / share.sum() if share.sum() > 0 else np.full(len(domains), 1 / len(domains))


def _dot(posteriors: Column, weights: np.ndarray) -> Column:
    out = F.lit(0.0)
    for i, w in enumerate(weights):
        out = out + posteriors[i] * float(w)
    return out


def fit_rates(members: DataFrame, domains: list[str], weights: Mapping[str, float] | None = None,
              total: float | None = None, least: float = 0.0, pooled: frozenset[str] = frozenset(), strict: bool = False) -> Rates:
    """Projected gradient on 1/2 sum_d ((T_d - sum_i rate_i tokens_i p_id) / scale_d)^2 over rate_i >= ``least``.

    ``weights`` are the target shares of the domains (equal shares if None; missing ones count 0); ``total`` is
    the number of tokens to reach (None: the least that takes no domain below what it has). Gradients are taken
    in the inner product that weighs a document with its tokens, so that a rate does not depend on the length
    of the text; the projection stays one maximum per document. scale_d is the domain's own curvature
    sum_i tokens_i p_id^2, which makes one step size fit all domains. It ends when every domain is within
    CLOSE of its target, relative to the total, or a step moves none by more than that (a lower bound on the
    rates can keep targets out of reach), or after ROUNDS steps. The totals reached are kept beside the targets
    (``Rates.report``). A positive weight that no domain serves is warned of, or with ``strict`` an error.
    """
    n = len(domains)
    share = _shares(domains, weights, pooled, strict)
    got = members.agg(*(F.sum(F.col("tokens") * F.col("posteriors")[i]).alias(f"t{i}") for i in range(n)),
                      *(F.sum(F.col("tokens") * F.col("posteriors")[i] * F.col("posteriors")[j]).alias(f"c{i}_{j}")
                        for i in range(n) for j in range(n))).first()
    before = np.array([got[f"t{i}"] or 0.0 for i in range(n)])
    scale = np.array([got[f"c{i}_{i}"] or 0.0 for i in range(n)])
    goal = share * total if total is not None else share * max(
        (before[i] / share[i] for i in range(n) if share[i] > 0), default=0.0)
    if not before.sum():
        return Rates(domains, goal, before, before, [], least)
    safe = np.where(scale > 0, scale, 1.0)
    gram = np.array([[got[f"c{i}_{j}"] or 0.0 for j in range(n)] for i in range(n)]) / np.sqrt(np.outer(safe, safe))
    pace = 1 / max(np.linalg.eigvalsh(gram).max(), 1e-12)
    rates, now = Rates(domains, goal, before, before, [], least), before

    def totals():
        def run(batches):
            sums = np.zeros(n)
            for batch in slices(batches, 65536):
                tokens = batch.column(0).to_numpy().astype(float)
                post = batch.column(1).flatten().to_numpy().reshape(len(tokens), n)
                sums += (rates.of(post) * tokens) @ post
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(sums)], ["at", "sum"])

        rows = members.select("tokens", "posteriors").mapInArrow(run, "at int, sum double") \
            .groupBy("at").agg(F.sum("sum").alias("sum")).collect()
        out = np.zeros(n)
        for r in rows:
            out[r["at"]] = r["sum"]
        return out

    for _ in range(ROUNDS):
        if np.abs(now - goal).max() <= CLOSE * max(goal.sum(), 1.0):
            break
        rates.steps.append(pace * (now - goal) / safe)
        last, now = now, totals()
        if np.abs(now - last).max() <= CLOSE * max(goal.sum(), 1.0):
            break
    rates.after = now
    return rates


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None, domain: str = "lang",
                    total: float | None = None, least: float = 0.0, strict: bool = False) -> DataFrame:
    """doc_id, tokens, domain (the likeliest), rate and copies for every row.

    copies is the rate rounded up or down by a fixed hash of the id, so that copies have the rate as their mean.
    * Null and empty texts have no tokens; their rate is 1. A null id is hashed as a value of its own.
    * Repeated rows get equal rates; extra columns are not read; an empty table gives an empty result.
    """
    model = fit_domains(docs, labels, domain, weights=weights)
    members = cut_lineage(membership(docs, model), "membership")
    rates = fit_rates(members, model.domains, weights, total, least, model.pooled, strict)
    names = F.array(*(F.lit(d) for d in model.domains))
    likeliest = names[F.array_position("posteriors", F.array_max("posteriors")).cast("int") - 1]
    return members.select("doc_id", "tokens", likeliest.alias("domain"),
                          rates.column(F.col("posteriors")).alias("rate")) \
        .withColumn("copies", copies(F.col("rate"), F.col("doc_id")))


def copies(rate: Column, key: Column) -> Column:
    even = F.pmod(F.xxhash64(F.lit(9), key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + even).cast("bigint")


def mixed(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None, domain: str = "lang",
          total: float | None = None, least: float = 1.0) -> DataFrame:
    """The documents, all columns, each as often as its copies say; with ``least`` 1 every one stays.

    * Null and empty texts have no tokens; their rate is 1, so they stay once. Repeated rows get equal rates, and
      each comes out as often. Columns named like those used inside come out as they went in; empty in, empty out.
    """
    model = fit_domains(docs, labels, domain, weights=weights)
    rates = fit_rates(cut_lineage(membership(docs, model), "membership"), model.domains, weights, total, least, model.pooled)
    shipped = docs.sparkSession.sparkContext.broadcast((model, rates))

    @F.pandas_udf("double")
    def rate(texts):
        model, rates = shipped.value
        import pandas as pd
        out = []
        for i in range(0, len(texts), 256):
            part = texts.iloc[i:i + 256].tolist()
            out.append(rates.of(model.posteriors(part)))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    names = [f"`{c}`" for c in docs.columns]
    spare = "_copy"
    while spare in docs.columns:
        spare += "_"
    times = F.array_repeat(F.lit(0), copies(rate(text_bytes()), F.col("doc_id")).cast("int"))
    return docs.select("*", F.explode(times).alias(spare)).select(*names)
