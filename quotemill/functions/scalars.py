"""Column expressions: symbol and date dialects, price limits, bands, day counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- symbols ------------------------------------------------------------------

def complete_symbol(symbol: str | Column, market: str = ".SH") -> Column:
    """Append the market where the symbol has none."""
    symbol = col(symbol)
    return F.when(~symbol.contains("."), F.concat(symbol, F.lit(market))).otherwise(symbol)


def bare_code(symbol: str | Column) -> Column:
    """``510050.SH`` -> ``510050``."""
    return F.split_part(col(symbol), F.lit("."), F.lit(1))


def dotted_code(symbol: str | Column) -> Column:
    """``510050.SH`` -> ``sh.510050``; without or with an unknown market ``sh.``."""
    market = F.lower(F.split_part(col(symbol), F.lit("."), F.lit(2)))
    known = F.when(market == "sz", "sz.").otherwise("sh.")
    return F.concat(known, bare_code(symbol))


def prefixed_code(symbol: str | Column) -> Column:
    """``510050.SH`` -> ``sh510050``, any other market -> ``sz…``."""
    market = F.when(col(symbol).endswith(".SH"), "sh").otherwise("sz")
    return F.concat(market, bare_code(symbol))


def numbered_code(symbol: str | Column) -> Column:
    """``510050.SH`` -> ``1.510050``, any other market -> ``0.…``."""
    market = F.when(col(symbol).endswith(".SH"), "1.").otherwise("0.")
    return F.concat(market, bare_code(symbol))


def stripped_market(symbol: str | Column) -> Column:
    """Drop a known market suffix wherever it stands."""
    return F.regexp_replace(col(symbol), r"\.(SH|SZ|BJ)", "")


def symbol_from_dotted(code: str | Column) -> Column:
    """``sh.510050`` -> ``510050.SH``."""
    code = col(code)
    market = F.upper(F.split_part(code, F.lit("."), F.lit(1)))
    return F.concat(F.split_part(code, F.lit("."), F.lit(2)), F.lit("."), market)


# -- dates --------------------------------------------------------------------

def compact_date(date: str | Column) -> Column:
    """Any date or ``YYYY-MM-DD…`` text as ``YYYYMMDD`` text."""
    return F.date_format(to_day(date), "yyyyMMdd")


def int_date(date: str | Column) -> Column:
    return compact_date(date).cast("int")


def to_day(date: str | Column) -> Column:
    """DATE from a date, a timestamp, ``YYYY-MM-DD…`` or ``YYYYMMDD`` text or int; else null."""
    text = F.trim(col(date).cast("string"))
    dashed = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    plain = F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))
    return F.coalesce(dashed, plain)


# Fixed value: the form of a time with separators.
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"


def to_moment(time: str | Column) -> Column:
    """TIMESTAMP without zone from text or number: ``YYYYMMDD``, ``YYYYMMDDHHMM[SS]``, ``YYYY-MM-DD`` (or with
    slashes) and ``YYYY-MM-DD HH:MM[:SS[.f]]`` (or with a T); else null."""
    text = F.translate(F.trim(col(time).cast("string")), "/", "-")
    digits = F.when(text.rlike("^[0-9]+$"), F.length(text))

    def joined(*parts: tuple[int, str]) -> Column:
        pieces, at = [], 1
        for width, mark in parts:
            pieces += [F.lit(mark), F.substring(text, at, width)]
            at += width
        return F.concat(*pieces)

    day = ((4, ""), (2, "-"), (2, "-"))
    shown = (
        F.when(digits == 8, joined(*day)).when(digits == 12, joined(*day, (2, " "), (2, ":")))
        .when(digits == 14, joined(*day, (2, " "), (2, ":"), (2, ":"))).when(text.rlike(MOMENT), text))
    return shown.try_cast("timestamp_ntz")


def without_dashes(date: str | Column) -> Column:
    return F.replace(col(date), F.lit("-"), F.lit(""))


def weekdays_between(first: str | Column, last: str | Column) -> Column:
    """Number of Monday-to-Friday days in [first, last], without listing them."""
    first, last = col(first), col(last)

    def until(day: Column) -> Column:
        # weekdays from a fixed Monday up to and including the day
        days = F.datediff(day, F.lit("1900-01-01").cast("date"))
        return F.floor(days / 7) * 5 + F.least(F.weekday(day) + 1, F.lit(5))

    return (until(last) - until(F.date_sub(first, 1))).cast("bigint")


# -- numbers ------------------------------------------------------------------

def null_if_nan(value: str | Column) -> Column:
    value = col(value)
    return F.when(~F.isnan(value), value)


def price_limits(pre_close: str | Column, tick: str | Column, band: float = 0.1) -> tuple[Column, Column]:
    """(high, low): the close moved by the band, on whole ticks, three places."""
    pre, tick = col(pre_close), col(tick)

    def on_tick(price: Column) -> Column:
        return F.round(F.round(price / tick) * tick, 3)

    return on_tick(pre * (1 + band)), on_tick(pre * (1 - band))


def relative_difference(a: str | Column, b: str | Column) -> Column:
    a, b = col(a), col(b)
    return F.try_divide(F.abs(a - b), F.greatest(F.abs(a), F.abs(b)))


def consistency_band(consistency: str | Column) -> Column:
    c = col(consistency)
    return F.when(c >= 0.95, "green").when(c >= 0.80, "yellow").otherwise("red")


def exact_mean(value: str | Column, scale: int = 10) -> Column:
    """Mean that does not depend on the order rows arrive in: the sum is a DECIMAL."""
    value = col(value)
    total = F.sum(value.cast(f"decimal(28,{scale})")).cast("double")
    return total / F.nullif(F.count(value), F.lit(0))


def exact_sum(value: str | Column, scale: int = 10) -> Column:
    return F.sum(col(value).cast(f"decimal(28,{scale})")).cast("double")
