"""Comparison of the same bars from several sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import consistency_band, null_if_nan, relative_difference
from ..schemas import COMPARED_FIELDS, DEFAULT_TOLERANCE, TOLERANCE


def align(
    sources: Sequence[tuple[str, DataFrame]],
    fields: Sequence[str] = tuple(COMPARED_FIELDS),
    key: str = "symbol",
    date: str = "date",
) -> DataFrame:
    """One row per (key, date), with a struct of fields per source.

    The sources are stacked, shuffled once and aggregated; joins by pairs would read and
    sort every source twice. (key, date) has to be unique in each source (``keep_last``), so
    a group has one row a source, however many rows a key has, and ``max`` only moves the
    value. Hence also the explicit shuffle: partial aggregates in front of it would reduce
    nothing and send a column per source and field instead of one per field.
    """
    stacked = []
    for i, (_, df) in enumerate(sources):
        values = [
            null_if_nan(F.col(f).cast("double")).alias(f) if f in df.columns
            else F.lit(None).cast("double").alias(f)
            for f in fields
        ]
        stacked.append(df.select(key, date, F.lit(i).alias("_src"), *values))
    rows = reduce(DataFrame.unionByName, stacked).repartition(key, date)
    moved = [
        F.max(F.when(F.col("_src") == i, F.col(f))).alias(f"_{i}_{f}")
        for i in range(len(sources)) for f in fields
    ]
    return rows.groupBy(key, date).agg(*moved)


def _cells(
    sources: Sequence[tuple[str, DataFrame]],
    fields: Sequence[str],
    tolerance: dict[str, float],
    key: str,
    date: str,
) -> DataFrame:
    """One row per comparable (key, date, pair, field): neither side missing, not both zero."""
    names = [name for name, _ in sources]
    cells: list[Column] = []
    for i, k in combinations(range(len(names)), 2):
        for f in fields:
            cells.append(F.struct(
                F.lit(f).alias("field"), F.lit(names[i]).alias("src1"), F.lit(names[k]).alias("src2"),
                F.col(f"_{i}_{f}").alias("a"), F.col(f"_{k}_{f}").alias("b"),
                F.lit(tolerance.get(f, DEFAULT_TOLERANCE)).alias("threshold"),
            ))
    aligned = align(sources, fields, key, date)
    return _comparable(aligned.select(key, date, F.inline(F.array(*cells))))


def _comparable(cells: DataFrame) -> DataFrame:
    comparable = F.col("a").isNotNull() & F.col("b").isNotNull() & ~((F.col("a") == 0) & (F.col("b") == 0))
    return cells.where(comparable).withColumn("rel", relative_difference("a", "b"))


def _cells_in_place(
    sources: Sequence[tuple[str, DataFrame]],
    fields: Sequence[str],
    tolerance: dict[str, float],
    key: str,
    date: str,
) -> DataFrame:
    """The same of sources stored in the same buckets of (key, date): pairs are joined bucket by bucket, and
    what is compared is what both sides have, so that no row is shuffled."""
    found = []
    for (name1, one), (name2, two) in combinations(sources, 2):
        sides = []
        for df in (one, two):
            values = [
                null_if_nan(F.col(f).cast("double")).alias(f) if f in df.columns else F.lit(None).cast("double").alias(f)
                for f in fields]
            sides.append(df.select(key, date, *values))
        joined = sides[0].alias("a").join(sides[1].alias("b"), [key, date])
        cells = [F.struct(
            F.lit(f).alias("field"), F.lit(name1).alias("src1"), F.lit(name2).alias("src2"), F.col(f"a.{f}").alias("a"),
            F.col(f"b.{f}").alias("b"), F.lit(tolerance.get(f, DEFAULT_TOLERANCE)).alias("threshold")) for f in fields]
        found.append(_comparable(joined.select(key, date, F.inline(F.array(*cells)))))
    return reduce(DataFrame.unionByName, found)


def source_differences(
    sources: Sequence[tuple[str, DataFrame]],
    fields: Sequence[str] = tuple(COMPARED_FIELDS),
    tolerance: dict[str, float] | None = None,
    key: str = "symbol",
    date: str = "date",
    main_only: bool = True,
    in_place: bool = False,
) -> DataFrame:
    """Differences above tolerance between every two sources, for all keys at once. ``in_place`` is for sources stored in
    the same buckets of (key, date), see ``sinks.bucketed``; the rows are the same.

    With ``main_only`` a key the first source does not have at all gives nothing, not even
    differences between the others.
    """
    cells = (_cells_in_place if in_place else _cells)(sources, fields, tolerance or TOLERANCE, key, date)
    found = cells.where(F.col("rel") > F.col("threshold"))
    if main_only and len(sources) > 2:
        # only differences meet the key list here, not the bars
        found = found.join(sources[0][1].select(key).distinct(), key, "left_semi")
    return found.select(
        key, date, "field", "src1", "src2",
        F.round("a", 6).alias("val1"), F.round("b", 6).alias("val2"),
        F.round(F.abs(F.col("a") - F.col("b")), 6).alias("abs_diff"),
        F.round("rel", 6).alias("rel_diff"), "threshold",
    )


def consistency_by_symbol(
    differences: DataFrame,
    symbols: DataFrame,
    n_fields: int = len(COMPARED_FIELDS),
    n_pairs: int = 3,
    key: str = "symbol",
    date: str = "date",
) -> DataFrame:
    """Per key of ``symbols``: differences, days with one, and 1 - differences / cells of
    those days. A key without differences is fully consistent."""
    cells = n_fields * n_pairs
    counted = differences.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_diffs"), F.count_distinct(date).alias("n_dates")
    )
    share = F.col("n_diffs") / F.greatest(F.col("n_dates") * cells, F.lit(1))
    return (
        symbols.select(key).distinct().join(counted, key, "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_diffs", "n_dates")})
        .withColumn("consistency", F.round(1 - share, 4))
    )


def consistency_of_cells(
    sources: Sequence[tuple[str, DataFrame]],
    fields: Sequence[str] = tuple(COMPARED_FIELDS),
    tolerance: dict[str, float] | None = None,
    key: str = "symbol",
    date: str = "date",
) -> DataFrame:
    """The same share over all cells compared, not only those of days with a difference."""
    cells = _cells(sources, fields, tolerance or TOLERANCE, key, date)
    counted = cells.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("rel") > F.col("threshold")).alias("n_diffs"),
    )
    return counted.withColumn("consistency_all", F.round(1 - F.col("n_diffs") / F.col("n_cells"), 4))


def overall_consistency(by_symbol: DataFrame) -> DataFrame:
    total = F.sum(F.col("consistency").cast("decimal(28,4)")).cast("double")
    n = F.count(F.lit(1))
    return by_symbol.agg(
        n.alias("n_symbols"),
        F.coalesce(F.round(total / F.nullif(n, F.lit(0)), 4), F.lit(0.0)).alias("avg_consistency"),
        F.coalesce(F.sum("n_diffs"), F.lit(0)).alias("total_diffs"),
    )


def _distribution(differences: DataFrame, label: Column, name: str) -> DataFrame:
    counted = differences.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n_diffs"))
    # over one row a label; a second aggregate would compare the sources again
    total = F.sum("n_diffs").over(Window.partitionBy())
    return counted.withColumn("share", F.col("n_diffs") / total)


def differences_by_field(differences: DataFrame) -> DataFrame:
    return _distribution(differences, F.col("field"), "field")


def differences_by_pair(differences: DataFrame) -> DataFrame:
    return _distribution(differences, F.concat_ws(" vs ", "src1", "src2"), "pair")


def symbol_details(by_symbol: DataFrame, cells_per_day: int = 18) -> DataFrame:
    return by_symbol.select(
        "symbol", "n_dates", (F.col("n_dates") * cells_per_day).alias("comparisons"),
        "n_diffs", "consistency", consistency_band("consistency").alias("band"),
    )
