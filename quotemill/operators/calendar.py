"""Trading days: open days, the trading-day gate, missing days, completeness."""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import int_date, to_day, weekdays_between
from .keyed import same_key


def open_days(calendar: DataFrame, date: str = "date") -> DataFrame:
    """Distinct open days as DATE and as int, from rows of any date form and a 0/1 flag."""
    days = calendar.where(F.col("is_open").cast("string") == "1").select(to_day(date).alias("date"))
    return days.distinct().select("date", int_date("date").alias("day"))


def open_days_of_year(calendar: DataFrame, year: int) -> DataFrame:
    return open_days(calendar).where(F.year("date") == year).orderBy("date")


def _calendar_days(calendar: DataFrame, name: str) -> DataFrame:
    """Distinct open days, to be broadcast: some 250 a year whatever the data size, and
    never more than the days DATE can name."""
    return open_days(calendar).select(F.col("date").alias(name))


def is_trading_day(calendar: DataFrame, day: str | dt.date) -> bool:
    return not open_days(calendar).where(F.col("date") == F.to_date(F.lit(str(day)))).isEmpty()


def on_trading_days(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Rows of open days only."""
    return df.join(F.broadcast(_calendar_days(calendar, date)), date, "left_semi")


BITS = 62  # open days in one word, short of the sign


def open_days_through(calendar: DataFrame, last: int | None = None, as_of: str | dt.date | None = None) -> list[dt.date]:
    """The open days up to ``as_of``, or the newest ``last`` of them, ascending: some 250 a year, whatever the data."""
    days = _calendar_days(calendar, "date")
    if as_of is not None:
        days = days.where(F.col("date") <= F.to_date(F.lit(str(as_of))))
    days = days.orderBy(F.col("date").desc())
    return sorted(r[0] for r in (days.limit(last) if last is not None else days).collect())


def missing_days(
    df: DataFrame,
    calendar: DataFrame,
    key: str = "symbol",
    date: str = "date",
    last: int | None = None,
    as_of: str | dt.date | None = None,
    through: str = "own",
    universe: DataFrame | None = None,
    spans: DataFrame | None = None,
) -> DataFrame:
    """(key, date) of open days on which a key has no row; ``date`` may be a timestamp.

    A key is expected from its first day to its last (``through='own'``) or to the newest
    day of the table or ``as_of`` (``through='table'``). ``last`` looks at the last N open
    days only: the days listed and the rows they are compared with begin there. With a
    ``universe``, a frame of keys, each of its keys is expected on every day looked at,
    whether it has a row at all or not. ``spans``, (key, first, last), tells the first and last days of keys, if they are known
    without reading the history.

    Open days are numbered; a key's days are bits of words of 62 days each. Words of days present, one aggregate over the
    rows, meet the words of days expected, and only what is lacking becomes rows again.
    """
    listed = open_days_through(calendar, last, as_of)
    none = df.select(key, F.to_date(date).alias(date)).limit(0)
    if not listed:
        return none
    spark, begin, final = df.sparkSession, listed[0], listed[-1]
    numbered = F.broadcast(spark.createDataFrame(list(zip(listed, range(len(listed)))), "_day date, _number int"))
    present = df.where((F.col(date) >= F.lit(begin)) & (F.col(date) < F.date_add(F.lit(final), 1)))
    present = present.select(key, F.to_date(date).alias("_day")).join(numbered, "_day")
    bit = F.expr(f"shiftleft(1L, _number % {BITS})")
    have = present.groupBy(key, F.floor(F.col("_number") / BITS).cast("int").alias("_word")).agg(F.bit_or(bit).alias("_have"))
    # The number of the first open day at or after each day, and of the last at or before it.
    days = [begin + dt.timedelta(n) for n in range((final - begin).days + 1)]
    placed = F.broadcast(spark.createDataFrame(
        [(d, bisect.bisect_left(listed, d), bisect.bisect_right(listed, d) - 1) for d in days], "_day date, _next int, _previous int"))
    if universe is not None:
        numbers = universe.select(key).distinct().select(key, F.lit(0).alias("_from"), F.lit(len(listed) - 1).alias("_to"))
    else:
        if spans is None:
            spans = df.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"))
        spans = spans.select(key, F.to_date("first").alias("first"), F.to_date("last").alias("last"))
        if through == "table":
            end = final if as_of is not None else spans.agg(F.max("last")).first()[0]
            if end is None or end < begin:
                return none
            spans = spans.where(F.col("first") <= F.lit(end))
            numbers = spans.withColumn("_to", F.lit(bisect.bisect_right(listed, end) - 1))
        else:
            spans = spans.withColumn("last", F.least("last", F.lit(final))).where(F.col("last") >= F.lit(begin))
            numbers = spans.join(placed.select(F.col("_day").alias("last"), F.col("_previous").alias("_to")), "last")
        numbers = numbers.withColumn("first", F.greatest("first", F.lit(begin))).join(
            placed.select(F.col("_day").alias("first"), F.col("_next").alias("_from")), "first").where("_from <= _to")
        numbers = numbers.select(key, "_from", "_to")
    words = numbers.select("*", F.explode(
        F.expr(f"sequence(CAST(_from div {BITS} AS INT), CAST(_to div {BITS} AS INT))")).alias("_word"))
    low = F.expr(f"shiftleft(1L, greatest(_from - _word * {BITS}, 0)) - 1L")
    high = F.expr(f"shiftleft(1L, least(_to - _word * {BITS}, {BITS - 1}) + 1) - 1L")
    expected = words.select(F.col(key), "_word", high.bitwiseXOR(low).alias("_expected")).alias("base")
    both = expected.join(have.alias("found"), same_key([key, "_word"], True), "left").select(
        F.col(f"base.{key}").alias(key), "base._word",
        F.col("_expected").bitwiseAND(F.bitwise_not(F.coalesce("_have", F.lit(0).cast("bigint")))).alias("_lacking"))
    bits = F.expr(f"filter(sequence(0, {BITS - 1}), b -> shiftright(_lacking, b) & 1L = 1L)")
    lacking = both.where("_lacking <> 0").select(key, "_word", F.explode(bits).alias("_bit"))
    named = lacking.select(key, (F.col("_word") * BITS + F.col("_bit")).alias("_number")).join(numbered, "_number")
    return named.select(key, F.col("_day").alias(date))


def _gap_columns(date: Column) -> list[Column]:
    return [
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count_distinct(date).alias("days"),
        F.count(date).alias("_dated"),
    ]


def completeness(
    df: DataFrame,
    by: Sequence[str] = ("symbol",),
    date: str = "date",
    pct: str | None = None,
    threshold: float = 11.0,
) -> DataFrame:
    """Weekdays without data and extreme moves, per key; ``by=()`` pools all keys.

    Missing are the Monday-to-Friday days of [first, last] less the distinct days present.
    Fewer than two dated rows give none. ``threshold`` is on the scale of ``pct``, percent
    by default.
    """
    aggs = _gap_columns(F.col(date))
    if pct:
        aggs.append(extreme_moves(pct, threshold).alias("extreme_moves"))
    df = df.withColumn(date, to_day(date)) if dict(df.dtypes)[date] == "string" else df
    grouped = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    expected = weekdays_between("first_date", "last_date")
    missing = F.when(F.col("_dated") < 2, 0).otherwise(F.greatest(expected - F.col("days"), F.lit(0)))
    return grouped.withColumn("missing_days", F.coalesce(missing, F.lit(0)).cast("bigint")).drop("_dated")


def extreme_moves(pct: str, threshold: float = 11.0) -> Column:
    """How many values move by more than the threshold either way."""
    return F.count_if(F.abs(F.col(pct)) > threshold)


def completeness_message(df: DataFrame, spec: dict, date: str = "date") -> DataFrame:
    """The pooled findings of a task as one text: null if there are none.

    ``spec``: check_gaps (default true), pct_change_col, gap_threshold.
    """
    pct = spec.get("pct_change_col")
    pct = pct if pct in df.columns else None
    threshold = spec.get("gap_threshold", 11.0)
    found = completeness(df, (), date, pct, threshold)
    enough = F.col("days") > 0
    parts = []
    if spec.get("check_gaps", True):
        parts.append(F.when(
            F.col("missing_days") > 0,
            F.concat(F.lit("missing "), F.col("missing_days").cast("string"), F.lit(" trading days")),
        ))
    if pct:
        parts.append(F.when(
            F.col("extreme_moves") > 0,
            F.concat(F.col("extreme_moves").cast("string"), F.lit(f" extreme moves (>{threshold:g})")),
        ))
    text = F.concat_ws(", ", *parts) if parts else F.lit("")
    return found.select(F.when(enough & (text != ""), text).alias("message"))


def rows_of_missing(
    missing: DataFrame, source: DataFrame, key: str = "symbol", date: str = "date"
) -> DataFrame:
    """What a source can deliver for the missing (key, day) pairs."""
    wanted = missing.select(F.col(key).alias("_key"), F.col(date).alias("_day"))
    same = (source[key] == F.col("_key")) & (F.to_date(source[date]) == F.col("_day"))
    return source.join(wanted, same, "left_semi")
