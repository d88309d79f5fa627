"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

_WRITTEN: list[str] = []


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a written table: computed once, whatever is lost later.

    The planner knows the size of its files, so joins with it are broadcast or shuffled
    by that size against the session's threshold.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, which ``clear`` deletes."""
    path = scratch_path(spark, name)
    _WRITTEN.append(path)
    return path


def written() -> int:
    """How many intermediate tables there are, for ``clear``."""
    return len(_WRITTEN)


def clear(spark: SparkSession, since: int = 0, but_last: bool = False) -> None:
    """Delete the intermediate tables written since (all so far), or all of these but the last one; frames that read
    them end with it."""
    gone = _WRITTEN[since:len(_WRITTEN) - but_last]
    del _WRITTEN[since:len(_WRITTEN) - but_last]
    for path in gone:
        delete_path(spark, path)


def running_sums(df: DataFrame, order: list, sums: dict, name: str) -> DataFrame:
    """``df`` with the sum of each column of ``sums`` over all rows up to each row.

    ``sums`` maps new column names to the columns summed. Rows are range-partitioned by
    ``order`` and written; one total per partition carries the sums from one range to the
    next. Only the totals, a row a partition, meet in one task. The order has to be total.
    """
    from pyspark.sql import Window as W

    ranged = kept(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(
        *[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_range", *[
        F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in sums])
    inner = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return ranged.join(starts, "_range").select(*df.columns, *[
        (F.col(f"_start_{n}") + F.sum(c).over(inner)).alias(n) for n, c in sums.items()])
