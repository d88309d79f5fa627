"""Keep-one-per-key, top-N-per-key and keyed merge.

A key may hold a large share of all rows. Ranking followed by a filter on the rank lets
Catalyst put a ``WindowGroupLimit`` in front of the shuffle, so every map task passes on
at most N rows of a key, however many it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _flip(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    slices: int = 0,
) -> DataFrame:
    """The first ``n`` rows of every key under ``order``, which must be total.

    Up to the session's group-limit threshold the cut is made in front of the shuffle. For a
    greater ``n``, and wherever ``slices`` says so, rows are ranked within (key, slice of
    the input) first, so that a key with very many rows spreads over many tasks and at
    most ``n`` rows of each slice go on. The slice only decides where a row is ranked first,
    never whether it stays.
    """
    col = rank or "_rank"
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if slices > 1 or n > limit:
        slice_of = F.spark_partition_id() % F.lit(slices) if slices > 1 else F.spark_partition_id()
        within = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = df.withColumn("_slice", slice_of).withColumn("_rank", F.row_number().over(within))
        df = df.where(F.col("_rank") <= n).drop("_slice", "_rank")
    window = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn(col, F.row_number().over(window)).where(F.col(col) <= n)
    return df if rank else df.drop(col)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) under ``order``. Null keys equal each other."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    columns = _flip(order) if keep == "last" else [F.col(c).asc_nulls_last() for c in order]
    return top_n_per_key(df, keys, columns, 1)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_one(df, keys, order, "last")


def same_key(keys: Sequence[str], null_safe: bool, left: str = "base", right: str = "found") -> Column:
    """Key equality of two aliased frames; ``null_safe`` lets null equal null."""
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, tests)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    found = other.select(*keys).alias("found")
    return df.alias("base").join(found, same_key(keys, null_safe), "left_anti").select(*df.columns)


def merge_by_key(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """Upsert: the batch wins over what exists, its last row per key wins within it.

    ``null_safe`` treats null keys as equal. Without it a null key matches nothing, as in
    a database MERGE: existing rows stay and every such batch row is inserted.
    """
    if null_safe:
        fresh = keep_last(batch, keys, order)
    else:
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        fresh = keep_last(batch.where(complete), keys, order).unionByName(batch.where(~complete))
    kept = without_keys(existing, fresh, keys, null_safe)
    return kept.unionByName(fresh, allowMissingColumns=True)


def merge_by_version(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Upsert in which the row with the greater ``order`` stays, whichever side it is on."""
    return keep_last(existing.unionByName(batch, allowMissingColumns=True), keys, order)


def last_versions(base: DataFrame, appended: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A table with one row a key and versions appended to it: of each key the row with the greatest ``order``.

    Only rows of the base whose key was appended are ranked; the others pass by, by a join whose
    side is the appended keys.
    """
    newest = keep_last(appended, keys, order)
    found = newest.select(*keys).alias("found")
    met = base.alias("base").join(found, same_key(keys, True), "left_semi").select(*base.columns)
    ranked = keep_last(met.unionByName(newest, allowMissingColumns=True), keys, order)
    return without_keys(base, newest, keys).unionByName(ranked, allowMissingColumns=True)
