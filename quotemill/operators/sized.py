"""Joining against a derived side whose size is known only once it is computed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, scratch_path

_WRITTEN: list[str] = []


def settled(df: DataFrame) -> DataFrame:
    """The frame computed once, as a table in the shared folder.

    For sides Catalyst cannot estimate, such as the distinct keys of a large table: without
    this both sides of the join are shuffled before adaptive execution learns the size. The
    planner knows the bytes of a written table and broadcasts it below the session's
    threshold; above it the join stays a shuffled one, in which adaptive execution splits
    hot keys. It also cuts the lineage and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, "settled")
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_settled(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that ``settled`` has written since (all so far); frames that read them end with it."""
    gone = _WRITTEN[since:]
    del _WRITTEN[since:]
    for path in gone:
        delete_path(spark, path)


@contextmanager
def cleared_after(spark: SparkSession) -> Iterator[None]:
    """For jobs that return no frame: what was settled within is deleted at the end."""
    since = len(_WRITTEN)
    try:
        yield
    finally:
        clear_settled(spark, since)
