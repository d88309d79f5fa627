"""From raw documents to token ids: language, near-duplicates, secrets, mix, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes the result of each as
Parquet in the shared folder and gives it to the next. All stages but the last return the
columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm import bpe, language, mixing, near_dedup, secret_scan
from quotemill.llm.queries import vocabulary
from quotemill.llm.scratch import clear, kept, written
from quotemill.llm.shipping import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; a null lang becomes the one predicted."""
    ship(spark)
    return language.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, a similarity of 0.8 or more."""
    ship(spark)
    return near_dedup.deduplicated(docs, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    ship(spark)
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed(docs, weights=(1, 2, 3), max_epochs=3)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns without the text, and the ids of the text."""
    ship(spark)
    # Fewer remembered fragments than op8 has: the executors come here with the memory of four stages behind them.
    return bpe.encode(docs, vocabulary(), keep=[c for c in docs.columns if c != "text"], ids="token_ids", remembered=150_000)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("bpe_encode", encode_documents),
]

# Profiles learned by rank and a vocabulary's merges are beyond SQL; the tests compare the
# pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    begun = written()
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, begun, but_last=True)  # what the stage before kept, and what this one needed on its way
    return docs
