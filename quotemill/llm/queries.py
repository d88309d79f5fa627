"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, bpe, cross_polytope, exact_topk, language, mixing, near_dedup, pii, secret_scan, token_files, toxicity, warc, whitening,
)
from .shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary of the public tokenizers package, by its path on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(build: Callable) -> Callable:
    def run(spark: SparkSession, root: str) -> DataFrame:
        ship(spark)
        return build(lambda table: spark.read.parquet(f"{root}/{table}.parquet"))

    QUERIES[build.__name__] = run
    return run


@_query
def op1_mix_sources(read) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(read("documents"), weights=(1, 2, 3), max_epochs=3).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query
def op2_exact_top_k(read) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector."""
    return exact_topk.exact_top_k(read("embeddings"), F.col("vec_id") % 50 == 0, 5)


@_query
def op3_secret_scan(read) -> DataFrame:
    """Secrets of every text."""
    return secret_scan.scan(read("documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@_query
def op4_toxicity(read) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = read("documents")
    return toxicity.score(docs, toxicity.fit(docs, read("labels")))


@_query
def op5_warc(read) -> DataFrame:
    """Every page as its archive record has it, by way of the merged capture index."""
    return warc.archived(read("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op6_near_dedup(read) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_dedup.near_duplicates(read("documents"), percent=85)


@_query
def op7_nearest(read) -> DataFrame:
    """The ten nearest vectors found of every hundredth vector."""
    return cross_polytope.nearest(read("embeddings"), F.col("vec_id") % 100 == 0, 10)


@_query
def op8_bpe(read) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    return bpe.digests(read("documents"), vocabulary())


@_query
def op9_token_files(read) -> DataFrame:
    """Place and checksum of every document in the token files, read back from them."""
    return token_files.checked_offsets(token_files.encoded_files(read("documents"), vocabulary(), end_id=0))


@_query
def op10_language(read) -> DataFrame:
    """The language of every document by its rank-order profile."""
    return language.identify(read("documents"))


@_query
def op11_align_tokens(read) -> DataFrame:
    """Groups and links of the tokens of two vocabularies, and how often the linked ids go together."""
    return alignment.linked(read("documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


@_query
def op12_whitening(read) -> DataFrame:
    """Every vector on the first eight components, whitened. A deviation beyond a long is null."""
    return whitening.whitened(read("embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


@_query
def op13_personal_data(read) -> DataFrame:
    """Personal data of every text, and the terms of the text that give it away."""
    found = pii.personal_data(read("documents"), keep=["doc_id"])
    return found.select("doc.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.listed_spans(found).alias("spans"))
