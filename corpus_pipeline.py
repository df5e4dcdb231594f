"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing, BPE. Each stage's result is written and read again.

An empty table gives an empty table at each stage; texts may have any length; further columns of any name pass through all
stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm import bpe, lines, mixing, simhash, toxicity
from tickertide.llm.common import park, table
from tickertide.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 1 does not reject. Null and empty texts score as the bias says and stay;
    without labels all stay. Repeated rows go or stay together."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are kept elsewhere; n_chars follows the text. A null text stays null, one whose lines
    all go stays as an empty text. Rows equal in id and text stay alike, rows that share only the id are documents of their own."""
    kept = lines.dedup(docs, counted=False)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id: SimHash fingerprints within two bits, or sets of
    five-word shingles at a similarity of 0.8, verified exactly. Empty and null texts are one group. Rows without an id stay."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Empty and null texts have no words and are never taken."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the digests of ids and of the decoded text; a null text has no tokens."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Stages learn, hash and tokenise, which SQL cannot; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = park(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
