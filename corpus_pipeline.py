"""From raw documents to a mixed, tokenised corpus: five stages, each on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.llm import mixing, pieces, simhash, supervision, toxicity
from dockline.llm.common import table
from dockline.llm.queries import DOMAIN_WEIGHTS, tokenizer_file
from dockline.session import cut_lineage

# No SQL states trained models and tokenizers; the tests hold each stage against a plain version.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def passing_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose votes make them good."""
    return supervision.passing(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group: the one with the smallest id."""
    return simhash.without_near_copies(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, those of scarce domains more than once, in the target shares of tokens."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), DOMAIN_WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids and the digests of ids and decoded text."""
    return pieces.piece_digests(pieces.encode_pieces(docs, tokenizer_file("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", passing_rules),
    ("simhash near-dedup", one_of_each_group),
    ("mixing", mixed_to_weights),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs, "stage")
    return docs
