"""Fund holdings: latest period, largest positions, overlap, concentration.

A fund may hold a large share of all rows. Largest positions are cut before the shuffle
(``top_n_per_key``); everything else is an aggregation with partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import exact_mean, exact_sum
from .columns import in_symbols
from .keyed import top_n_per_key


def named_holdings(
    holdings: DataFrame, basics: DataFrame, funds: Sequence[str] | None = None
) -> DataFrame:
    """Holdings with the fund's name, null where it has none; optionally of some funds."""
    if funds:
        wanted = sorted({f if "." in f else f"{f}.SH" for f in funds})
        holdings = in_symbols(holdings, wanted, "fund_code")
    names = basics.select(F.col("symbol").alias("fund_code"), F.col("csname").alias("fund_name"))
    return holdings.join(names, "fund_code", "left")


def display_name(df: DataFrame, out: str = "fund_name") -> DataFrame:
    return df.withColumn(out, F.coalesce("fund_name", "fund_code"))


def latest_period(holdings: DataFrame, per_fund: bool = False) -> DataFrame:
    """Rows of the newest period: of the whole table, so that a fund not reporting then
    drops out, or of each fund."""
    if not per_fund:
        return holdings.where(F.col("date") == holdings.agg(F.max("date")).scalar())
    newest = holdings.groupBy("fund_code").agg(F.max("date").alias("date"))
    return holdings.join(newest, ["fund_code", "date"], "left_semi")


def headline(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.max("date").alias("latest_date"),
        F.count_distinct("fund_code").alias("n_funds"),
        F.count_distinct("symbol").alias("n_stocks"),
    )


def _by_ratio() -> list:
    return [F.col("stk_mkv_ratio").desc_nulls_last(), F.col("symbol").asc()]


def top_holdings(latest: DataFrame, n: int = 5, by: Sequence[str] = ("fund_code",)) -> DataFrame:
    """The n largest positions of every fund with their rank, nulls last, ties by symbol."""
    return top_n_per_key(latest, list(by), _by_ratio(), n, rank="rank")


def overlap(latest: DataFrame, least: float = 3.0, n: int | None = 20) -> DataFrame:
    """Stocks that weigh at least ``least`` percent in several funds: how many funds, mean
    weight there. ``n`` most shared ones, or all."""
    heavy = latest.where(F.col("stk_mkv_ratio") >= least)
    shared = heavy.groupBy("symbol").agg(
        F.count_distinct("fund_code").alias("fund_count"),
        exact_mean("stk_mkv_ratio").alias("avg_ratio"),
    )
    return shared if n is None else shared.orderBy(F.col("fund_count").desc(), "symbol").limit(n)


def concentration(positions: DataFrame, by: Sequence[str] = ("fund_code",)) -> DataFrame:
    """Per fund, or per fund and period: positions, weight of the three and of the five largest."""
    sizes = positions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_holdings"))
    largest = top_holdings(positions, 5, by).groupBy(*by).agg(
        exact_sum(F.when(F.col("rank") <= 3, F.col("stk_mkv_ratio"))).alias("top3"),
        exact_sum("stk_mkv_ratio").alias("top5"),
    )
    return sizes.join(largest, list(by))


def fund_holdings(holdings: DataFrame, funds: str | Sequence[str] | DataFrame) -> DataFrame:
    """All periods of a fund (or some), newest first, largest position first."""
    wanted = [funds] if isinstance(funds, str) else funds
    return in_symbols(holdings, wanted, "fund_code").orderBy(
        "fund_code", F.col("date").desc(), F.col("stk_mkv_ratio").desc_nulls_last(), "symbol"
    )


def analysis(
    holdings: DataFrame, basics: DataFrame, funds: Sequence[str] | None = None, per_fund: bool = False
) -> dict[str, DataFrame]:
    """The four result tables of one analysis over the same latest period.

    They share no cache: the latest period may be a large part of the table, and each
    result reads few columns of it. Persist ``latest_period`` yourself where it is small.
    """
    latest = latest_period(named_holdings(holdings, basics, funds), per_fund)
    return {
        "headline": headline(latest),
        "top_holdings": display_name(top_holdings(latest)),
        "overlap": overlap(latest),
        "concentration": concentration(latest),
    }
