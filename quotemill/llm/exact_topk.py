"""Exact top-k inner products by norm buckets.

Vectors are grouped by length: a bucket holds lengths within a quarter of a doubling of the
squared length. A bounded set of the longest vectors gives every query a first threshold, its
k-th best score among them; no score below it can be in the result. A query looks only into
buckets whose longest member, times its own length, reaches its threshold. In a block of a
bucket the threshold becomes a local cosine threshold. Where that is high, members are
pruned by their coordinates: on the query's largest axes a direction within the angle has to
lie in an interval. Where it is low, they are pruned by length alone. What is left is
verified by exact integer products.

Rows so long that their products may not fit 64 bits (a squared integer length from 2^59) are searched
apart, with all rows of their dimension: products in doubles with a bound of their error choose what is multiplied out in whole
numbers of any size.

Defined cases. Null or non-finite components or a null id: the row takes no part. A score that does not fit a long is no
result; its pair is left out. Rows that repeat id and vector count once. Queries and
candidates of different dimension do not meet. Where one id has several vectors each is a
candidate; as a query the smallest vector asks. Vectors of zeros score 0.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import kept
from .vectors import best, finite, matrix, results, search_blocks, top_rows

SEEDS = 1024
COORDINATES_FROM = 0.6
AXES = 4
SLICE = 256
EXACT_DOUBLE = 2.0 ** 52
LONG = 2.0 ** 59
FITS = 2.0 ** 63


def _products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer products (queries x rows)."""
    largest = np.sqrt(float((rows.astype(float) ** 2).sum(1).max(initial=0)) * float((queries.astype(float) ** 2).sum(1).max(initial=0)))
    if largest < EXACT_DOUBLE:
        return np.rint(queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _scorer(k: int):
    def score(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if members.empty or queries.empty:
            return results([], np.int64)
        members = members.sort_values("vec_id", kind="stable")
        ids = members["vec_id"].to_numpy()
        rows = matrix(members["vector"], np.int64)
        asked = matrix(queries["vector"], np.int64)
        own = queries["query_id"].to_numpy()
        floor = queries["threshold"].to_numpy(dtype=float)
        length = np.sqrt((rows.astype(float) ** 2).sum(1))
        reach = np.sqrt((asked.astype(float) ** 2).sum(1))
        longest = length.max()
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(reach > 0, floor / reach, np.where(floor > 0, np.inf, -np.inf))
            cosine = np.where(longest > 0, needed / longest, np.where(floor > 0, np.inf, -np.inf))
            unit = np.where(length[:, None] > 0, rows / length[:, None], 0.0)
        parts = []

        def add(at: int, chosen: np.ndarray, scores: np.ndarray) -> None:
            keep = top_rows(scores, ids[chosen], own[at], k)
            keep = keep[scores[keep] >= floor[at]]
            parts.append((own[at], ids[chosen][keep], scores[keep]))

        by_axis = np.flatnonzero((cosine >= COORDINATES_FROM) & (cosine <= 1 + 1e-9))
        for at in by_axis:
            t = min(1.0, cosine[at])
            direction = asked[at] / reach[at]
            axes = np.argsort(-np.abs(direction))[:AXES]
            half = np.sqrt(max(0.0, 1 - t * t)) * np.sqrt(np.maximum(0.0, 1 - direction[axes] ** 2))
            low, high = direction[axes] * t - half - 1e-9, direction[axes] * t + half + 1e-9
            # Beyond the cosine's own axis the interval reaches to the end of the axis.
            low = np.where(direction[axes] < -t, -1.0, low)
            high = np.where(direction[axes] > t, 1.0, high)
            near = unit[:, axes]
            chosen = np.flatnonzero(((near >= low) & (near <= high)).all(1) & (length >= needed[at] * (1 - 1e-9)))
            if len(chosen):
                add(at, chosen, _products(rows[chosen], asked[at:at + 1])[0])
        by_length = np.flatnonzero(cosine < COORDINATES_FROM)
        for begin in range(0, len(by_length), SLICE):
            part = by_length[begin:begin + SLICE]
            # Rows long enough for the least demanding query of the slice.
            chosen = np.flatnonzero(length >= needed[part].min() * (1 - 1e-9))
            if len(chosen):
                for at, scores in zip(part, _products(rows[chosen], asked[part])):
                    add(at, chosen, scores)
        return results(parts, np.int64)

    return score


def _thresholds(queries: DataFrame, seeds: list, k: int) -> DataFrame:
    """Each query's k-th best score among the seeds, or minus infinity."""
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {len(s.vector) for s in seeds}:
        chosen = [s for s in seeds if len(s.vector) == dim]
        by_dim[dim] = (
            np.array([s.vec_id for s in chosen], np.int64),
            np.array([s.vector for s in chosen], np.int64).reshape(len(chosen), dim))

    def first(batches):
        for batch in batches:
            found = np.full(len(batch), -np.inf)
            for at, (own, vector) in enumerate(zip(batch["query_id"], batch["vector"])):
                ids, rows = by_dim.get(len(vector), (np.empty(0, np.int64), None))
                scores = _products(rows, np.array(vector, np.int64)[None])[0][ids != own] if len(ids) else ids
                if len(scores) >= k:
                    found[at] = float(np.partition(scores, len(scores) - k)[len(scores) - k])
            yield batch.assign(threshold=found)

    return queries.mapInPandas(first, "query_id long, vector array<bigint>, norm2 long, dim int, threshold double")


def _floored(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double: exact, as it is a whole number already from 2^53 on."""
    scaled = x * F.lit(float(scale))
    return F.when(F.abs(scaled) < 2.0 ** 53, F.floor(scaled).cast("double")).otherwise(scaled)


def _whole(vector, scale: int) -> list[int]:
    """floor(scale * x) of each component, of any size."""
    return [int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(x * scale) for x in vector]


def _long_scorer(k: int, scale: int):
    """Products of any size; those that fit 64 bits count."""
    def score(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if members.empty or queries.empty:
            return results([], np.int64)
        members = members.sort_values("vec_id", kind="stable")
        ids = members["vec_id"].to_numpy()
        exact_rows = [_whole(x, scale) for x in members["x"]]
        # float() of a whole number is off by 2^-53 of it at most; beyond the range of doubles it counts as infinite.
        rows = np.array([[_double(c) for c in r] for r in exact_rows]).reshape(len(exact_rows), -1)
        parts = []
        for own, x in zip(queries["query_id"].to_numpy(), queries["x"]):
            exact = _whole(x, scale)
            asked = np.array([_double(c) for c in exact])
            with np.errstate(over="ignore", invalid="ignore"):
                rough = rows @ asked
                off = (np.abs(rows) @ np.abs(asked)) * (2.0 ** -50 * (len(asked) + 2)) + 1
                low, high = rough - off, rough + off
                unsure = ~np.isfinite(low) | ~np.isfinite(high)
                may_fit = (ids != own) & (unsure | ((low < FITS) & (high >= -FITS)))
                sure = may_fit & ~unsure & (high < FITS) & (low >= -FITS)
            floor = np.partition(low[sure], -k)[-k] if sure.sum() > k else -np.inf
            chosen = np.flatnonzero(may_fit & (unsure | (high >= floor)))
            scores = [sum(a * b for a, b in zip(exact_rows[i], exact)) for i in chosen]
            fit = [at for at, s in enumerate(scores) if -(1 << 63) <= s < 1 << 63]
            chosen, scores = chosen[fit], np.array([scores[at] for at in fit], np.int64)
            order = np.lexsort((ids[chosen], ~scores))[:k]  # ~ turns the order around for every long
            parts.append((own, ids[chosen[order]], scores[order]))
        return results(parts, np.int64)

    return score


def _double(value: int) -> float:
    try:
        return float(value)
    except OverflowError:
        return math.inf if value > 0 else -math.inf


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, *, scale: int = 256,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products per query.

    Components become floor(scale * x). ``is_query`` is a condition on ``vec_id``; candidates
    are all rows but those with the query's own id.
    """
    valid = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"),
        F.transform(vectors[embedding], lambda x: x.cast("double")).alias("x"), is_query.alias("asks")
    ).where(F.col("vec_id").isNotNull() & finite(F.col("x")))
    whole_number = F.transform("x", lambda x: _floored(x, scale))
    sized = valid.withColumn("size2", F.aggregate("x", F.lit(0.0), lambda s, x: s + (scale * x) * (scale * x)))
    long_rows = kept(
        sized.where(~(F.col("size2") < LONG)).select("vec_id", "asks", "x", whole_number.alias("vector"))
        .dropDuplicates(["vec_id", "x"]), "topk-long")
    some_long = not long_rows.isEmpty()
    short = sized.where(F.col("size2") < LONG)
    whole = short.select("vec_id", "asks", F.transform("x", lambda x: F.floor(scale * x).cast("long")).alias("vector"))
    rows = whole.dropDuplicates(["vec_id", "vector"]).withColumn(
        "norm2", F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    ).withColumns({
        "dim": F.size("vector"),
        "length_class": F.floor(4 * F.log2(F.col("norm2") + F.lit(1.0))).cast("int"),
    })
    rows = kept(rows, "topk-vectors")
    seeds = rows.orderBy(F.desc("norm2"), "vec_id").limit(SEEDS).select("vec_id", "vector").collect()
    asks = rows.where("asks").select("vec_id", "vector")
    if some_long:
        # An id asks by its smallest vector, which may be a long one.
        every = asks.select("vec_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"), F.lit(False).alias("long")).unionByName(
            long_rows.where("asks").select("vec_id", "vector", F.lit(True).alias("long")))
        least = every.groupBy("vec_id").agg(F.min_by("long", "vector").alias("long"))
        asks = asks.join(least.where("NOT long").select("vec_id"), "vec_id", "left_semi")
    queries = asks.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    queries = queries.withColumns({
        "norm2": F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x), "dim": F.size("vector")})
    queries = kept(_thresholds(queries, seeds, k), "topk-queries")
    classes = kept(rows.groupBy("dim", "length_class").agg(F.max("norm2").alias("longest2")), "topk-classes")
    within = F.sqrt(F.col("norm2").cast("double")) * F.sqrt(F.col("longest2").cast("double")) * (1 + 1e-9) >= F.col("threshold")
    asking = queries.join(classes, "dim").where(within).select("dim", "length_class", "query_id", "vector", "threshold")
    members = rows.select("dim", "length_class", "vec_id", "vector")
    found = search_blocks(members, asking, ["dim", "length_class"], _scorer(k), k, "long", True)
    if not some_long:
        return found
    # Every query with the long rows, and long queries with all rows.
    near = rows.select("vec_id", F.transform("vector", lambda x: (x / F.lit(float(scale)))).alias("x"))
    wide = long_rows.select("vec_id", "x")
    short_asks = queries.select("query_id", F.transform("vector", lambda x: (x / F.lit(float(scale)))).alias("x"))
    long_asks = long_rows.where("asks").join(least.where("long").select("vec_id"), "vec_id", "left_semi").groupBy(
        F.col("vec_id").alias("query_id")).agg(F.min_by("x", "vector").alias("x"))
    searches = [
        search_blocks(m.withColumn("dim", F.size("x")), q.withColumn("dim", F.size("x")), ["dim"], _long_scorer(k, scale), k, "long", True)
        for m, q in ((wide, short_asks), (near.unionByName(wide), long_asks))]
    union = reduce(DataFrame.unionByName, [found, *searches]).drop("rank")
    return best(kept(union, "topk-found"), k, True)
