"""Bar series: ranges, last N bars, percent change, close matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .keyed import top_n_per_key


def relative_change(value: Column, previous: Column, scale: float = 100.0) -> Column:
    """value / previous - 1, scaled. From zero it is infinite, from zero to zero null."""
    infinite = F.lit(float("inf"))
    from_zero = F.when(value > 0, infinite).when(value < 0, -infinite)
    return F.when(previous == 0, from_zero).otherwise((value / previous - 1) * scale)


def pct_change(
    df: DataFrame,
    key: str = "symbol",
    time: str = "date",
    value: str = "close",
    span: str = "year",
    out: str = "pct_chg",
) -> DataFrame:
    """Percent change against the previous bar of the same key, over all of history.

    A window over the bare key would put a whole series into one task. Here a series is
    cut into calendar spans, so that a task has a year of a key at most; each span looks
    back within itself, and its first bar takes the last value of the span before from a
    table of one row per (key, span). Shorter spans make smaller groups and a longer table.
    (key, time) has to be unique, see ``keep_last``.
    """
    cut = df.withColumn("_span", F.date_trunc(span, F.col(time)))
    ends = cut.groupBy(key, "_span").agg(F.max_by(value, time).alias("_end"))
    over_spans = Window.partitionBy(key).orderBy("_span")
    carried = ends.select(key, "_span", F.lag("_end").over(over_spans).alias("_carried"))
    within = Window.partitionBy(key, "_span").orderBy(time)
    joined = cut.join(carried.hint("shuffle_hash"), [key, "_span"], "left")
    previous = F.when(F.row_number().over(within) == 1, F.col("_carried")).otherwise(
        F.lag(value).over(within)
    )
    return (
        joined.withColumn("_previous", previous)
        .withColumn(out, relative_change(F.col(value), F.col("_previous")))
        .select(*df.columns, out)
    )


def last_n_bars(
    df: DataFrame,
    n: int = 250,
    key: str = "symbol",
    time: str = "date",
    value: str = "close",
    out: str = "pct_chg",
    slices: int = 0,
) -> DataFrame:
    """The newest ``n`` bars of every key with percent change; the first kept bar has none."""
    newest = top_n_per_key(df, [key], [F.col(time).desc()], n, slices=slices)
    within = Window.partitionBy(key).orderBy(time)  # n rows at most
    return (
        newest.withColumn("_previous", F.lag(value).over(within))
        .withColumn(out, relative_change(F.col(value), F.col("_previous")))
        .drop("_previous")
    )


def newest_dates(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    return df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)


def close_matrix_long(
    df: DataFrame, days: int = 60, key: str = "symbol", date: str = "date", value: str = "close"
) -> DataFrame:
    """(date, key, value) for the newest ``days`` distinct dates of the whole table.

    The cut is one scalar, so the data side is filtered in the scan and not joined.
    """
    first = newest_dates(df, days, date).agg(F.min(date)).scalar()
    return df.where(F.col(date) >= first).select(date, key, value)


def close_matrix(
    df: DataFrame,
    symbols: Sequence[str] | None = None,
    days: int | None = None,
    key: str = "symbol",
    date: str = "date",
    value: str = "close",
) -> DataFrame:
    """One row per date, one column per listed key; a missing bar is null.

    A list fixes the schema; without one all keys are looked up, by one more job. A full outer join of single series is what this replaces, by one aggregation.
    """
    long = df.select(date, key, value) if days is None else close_matrix_long(df, days, key, date, value)
    return long.groupBy(date).pivot(key, list(symbols) if symbols is not None else None).agg(F.max(value))


def between_dates(df: DataFrame, start: str | dt.date, end: str | dt.date, time: str = "kline_time") -> DataFrame:
    """Inclusive day range on a date or timestamp column, open-ended at the day's end."""
    first = F.to_date(F.lit(str(start)))
    after = F.date_add(F.to_date(F.lit(str(end))), 1)
    return df.where((F.col(time) >= first) & (F.col(time) < after))


def on_day(df: DataFrame, day: str | dt.date, time: str = "kline_time") -> DataFrame:
    return between_dates(df, day, day, time)


def in_lookback(as_of: str | dt.date, days: int, date: str = "date") -> Column:
    last = F.to_date(F.lit(str(as_of)))
    return (F.col(date) >= F.date_sub(last, days)) & (F.col(date) < F.date_add(last, 1))


def lookback(df: DataFrame, as_of: str | dt.date, days: int, date: str = "date") -> DataFrame:
    """Rows of the days [as_of - days, as_of]."""
    return df.where(in_lookback(as_of, days, date))


def in_task_range(
    *,
    incremental: bool = False,
    as_of: str | dt.date | None = None,
    lookback_days: int = 5,
    start: str | None = None,
    end: str | None = None,
    date: str = "date",
) -> Column:
    """Whether a row is in the range of a task: the lookback if incremental, else its own start and end, days inclusive."""
    if incremental:
        if as_of is None:
            raise ValueError("an incremental range needs as_of")
        return in_lookback(as_of, lookback_days, date)
    within = F.lit(True)
    if start:
        within = within & (F.col(date) >= F.to_date(F.lit(start)))
    if end:
        within = within & (F.col(date) < F.date_add(F.to_date(F.lit(end)), 1))
    return within


def task_range(df: DataFrame, **limits) -> DataFrame:
    """The date range of a task, see ``in_task_range``."""
    return df.where(in_task_range(**limits))
