"""Vector tables for the searches: valid rows, bounded blocks, best-k per query."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import kept

BLOCK_ROWS = 4096
BLOCK_QUERIES = 2048


def finite(vector: Column) -> Column:
    """True for arrays without null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))



def search_blocks(
    members: DataFrame, queries: DataFrame, bucket: Sequence[str], score: Callable, k: int, kind: str, largest: bool,
) -> DataFrame:
    """Best ``k`` members per query among the buckets it asks for, as (query_id, vec_id, score).

    ``members``: bucket columns, vec_id, vector. ``queries``: bucket columns, query_id and
    what ``score`` needs, one row for each bucket that the query looks into. A bucket of any
    size is dealt into blocks of about BLOCK_ROWS members and BLOCK_QUERIES queries; each pair of
    blocks is one group, of bounded size, and ``score(members, queries)`` returns its best.
    """
    per_bucket = kept(members.groupBy(*bucket).agg(F.count("*").alias("members")), "search-buckets")
    asked = kept(queries.groupBy(*bucket).agg(F.count("*").alias("asking")), "search-asked")
    deal = kept(
        per_bucket.join(asked, list(bucket)).select(
            *bucket,
            F.ceil(F.col("members") / BLOCK_ROWS).cast("int").alias("blocks"),
            F.ceil(F.col("asking") / BLOCK_QUERIES).cast("int").alias("query_blocks")),
        "search-deal")
    left = members.join(deal, list(bucket)).withColumns({
        "block": F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"),
        "query_block": F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)),
    }).drop("blocks", "query_blocks")
    right = queries.join(deal, list(bucket)).withColumns({
        "query_block": F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int"),
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    }).drop("blocks", "query_blocks")
    key = [*bucket, "block", "query_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        score, f"query_id long, vec_id long, score {kind}")
    return best(found.distinct(), k, largest)


def best(found: DataFrame, k: int, largest: bool) -> DataFrame:
    """query_id, rank from 1, vec_id, score: ties to the smaller vec_id."""
    order = F.desc("score") if largest else F.asc("score")
    return (
        found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(order, "vec_id")))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def top_rows(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, without the own id.
    ``ids`` ascend."""
    open_ = np.flatnonzero(ids != own)
    if len(open_) > k:
        values = scores[open_]
        least = np.partition(values, len(values) - k)[len(values) - k]
        open_ = open_[values >= least]
    order = np.argsort(-scores[open_], kind="stable")[:k]
    return open_[order]


def matrix(column: pd.Series, dtype) -> np.ndarray:
    return np.array(column.tolist(), dtype=dtype).reshape(len(column), -1)


def results(parts: list, kind) -> pd.DataFrame:
    query = np.concatenate([np.full(len(v), q, np.int64) for q, v, _ in parts]) if parts else np.empty(0, np.int64)
    ids = np.concatenate([v for _, v, _ in parts]) if parts else np.empty(0, np.int64)
    score = np.concatenate([s for _, _, s in parts]) if parts else np.empty(0, kind)
    return pd.DataFrame({"query_id": query, "vec_id": ids.astype(np.int64), "score": score.astype(kind)})
