"""Filling in from a chain of sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import same_key, top_n_per_key
from .sized import settled

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")

Source = DataFrame | Callable[[], DataFrame]


def fallback_by_key(
    sources: Sequence[tuple[str, DataFrame]],
    keys: Sequence[str] = ("symbol",),
    out: str = "source",
    unique: bool = False,
) -> DataFrame:
    """For every key all rows of the first source that has any.

    Which source owns a key is one aggregation over the keys alone; the rows are then
    filtered by that table, which is small where a key has many rows. Where the key is
    ``unique`` in each source, such as (symbol, date) to fill single days, that table would
    be as long as the data, and the first row per key is kept instead, in one shuffle.
    """
    keys = list(keys)
    tagged = [df.withColumn("_source", F.lit(i)) for i, (_, df) in enumerate(sources)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if unique:
        owned = top_n_per_key(rows, keys, [F.col("_source").asc()], 1)
    else:
        seen = reduce(DataFrame.unionByName, [t.select(*keys, "_source").distinct() for t in tagged])
        owner = settled(seen.groupBy(*keys).agg(F.min("_source").alias("_source")))
        owned = rows.alias("base").join(
            owner.alias("found"), same_key([*keys, "_source"], True), "left_semi")
    names = F.array(*[F.lit(name) for name, _ in sources])
    return owned.withColumn(out, F.get(names, F.col("_source"))).drop("_source")


def first_with_rows(sources: Sequence[tuple[str, Source]]) -> tuple[str, DataFrame]:
    """The first source with any row, whole. Looking costs one row a source, in order;
    later sources are not touched. A source that does not exist or cannot be opened counts as empty; any other
    failure, such as a wrong cast or a lost cluster, is not a reason to take another source."""
    tried = []
    for name, source in sources:
        try:
            df = source() if callable(source) else source
            if not df.isEmpty():
                return name, df
            tried.append(f"{name}: no rows")
        except OSError as error:
            tried.append(f"{name}: {error}")
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            tried.append(f"{name}: absent")
    raise ValueError("all sources are empty: " + "; ".join(tried))
