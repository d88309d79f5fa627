"""The market tables of the test queries, derived from the given tables.

Bars come from ``events`` (a user is a symbol), holdings from ``lineitem`` (a supplier is
a fund, a part a stock), reference data from the dimension tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Reads the given tables of one folder and derives the market tables, all lazily."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def _bars(self, by: list) -> DataFrame:
        money = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
        return self.given("events").groupBy(*by).agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.count(F.lit(1)).alias("volume"),
            money.alias("amount"),
        )

    def bars_daily(self) -> DataFrame:
        market = F.when(F.col("user_id") % 2 == 0, ".SH").otherwise(".SZ")
        symbol = F.concat(F.lpad(F.col("user_id").cast("string"), 6, "0"), market)
        bars = self._bars([F.col("user_id"), F.col("ts").cast("date").alias("date")])
        return bars.select(symbol.alias("symbol"), *[c for c in bars.columns if c != "user_id"])

    def bars_min(self) -> DataFrame:
        minute = F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")
        return self._bars([F.col("event_type").alias("symbol"), minute.alias("kline_time")])

    def bars_by_type(self) -> DataFrame:
        """Daily bars of the minute series."""
        return (
            self.bars_min()
            .groupBy("symbol", F.to_date("kline_time").alias("date"))
            .agg(
                F.min_by("open", "kline_time").alias("open"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max_by("close", "kline_time").alias("close"),
                F.sum("volume").alias("volume"),
            )
        )

    def holdings(self) -> DataFrame:
        lines = self.given("lineitem").select(
            "l_suppkey",
            F.year("l_shipdate").alias("y"),
            "l_partkey",
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        )
        held = lines.groupBy("l_suppkey", "y", "l_partkey").agg(F.sum("price").alias("mkv"))
        total = held.groupBy("l_suppkey", "y").agg(F.sum("mkv").alias("total"))
        # every fund has its total, so left is inner here; Catalyst drops an unused left join
        joined = held.join(total, ["l_suppkey", "y"], "left")
        return joined.select(
            F.concat(F.lit("F"), F.col("l_suppkey").cast("string")).alias("fund_code"),
            F.make_date("y", F.lit(12), F.lit(31)).alias("date"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
            F.col("mkv").cast("double").alias("mkv"),
            (F.col("mkv").cast("double") * 100 / F.col("total").cast("double")).alias("stk_mkv_ratio"),
        )

    def fund_basic(self) -> DataFrame:
        named = self.given("supplier").where(F.col("s_suppkey") % 10 != 0)
        return named.select(
            F.concat(F.lit("F"), F.col("s_suppkey").cast("string")).alias("symbol"),
            F.col("s_name").alias("csname"),
        )

    def source_b(self) -> DataFrame:
        drift = F.when(F.col("volume") % 5 == 0, F.col("close") * 1.01).otherwise(F.col("close"))
        return (
            self.bars_daily()
            .where(F.day("date") % 11 != 0)
            .withColumns({"close": drift, "volume": F.col("volume") + F.col("volume") % 3})
        )

    def source_c(self) -> DataFrame:
        drift = F.col("open") * F.when(F.col("volume") % 4 == 0, 1.02).otherwise(1.004)
        return (
            self.bars_daily()
            .where((F.day("date") % 7 != 0) & (F.substring("symbol", 1, 6).cast("int") % 9 != 0))
            .withColumns({"open": drift, "amount": F.lit(None).cast("double")})
        )

    FEED_ORDER = [
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    ]

    def feed_dup(self) -> DataFrame:
        """Line items with repeated keys; the arrival order is that of ``FEED_ORDER``.

        A running number over the whole table would need one task to hand it out; the
        operators take the ordering columns themselves.
        """
        return self.given("lineitem").select(*self.FEED_ORDER)

    def dirty(self) -> DataFrame:
        key = F.col("o_orderkey")
        price = F.col("o_totalprice")
        close = F.when(key % 50 == 0, -price).when(key % 77 == 0, None).otherwise(price)
        return self.given("orders").select(
            F.nullif(F.col("o_custkey"), F.lit(7)).alias("symbol"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("note"),
            close.alias("close"),
            key.alias("seq"),
        )

    def run_log(self) -> DataFrame:
        return self.given("events").select(
            F.col("event_type").alias("table_name"),
            F.col("ts").cast("date").alias("data_date"),
            F.when(F.col("event_id") % 7 == 0, "error").otherwise("ok").alias("status"),
            F.floor("value").cast("bigint").alias("rows_count"),
            F.col("event_id").alias("id"),
        )

    def code_info(self) -> DataFrame:
        return self.given("part").select(
            F.col("p_partkey").alias("code"),
            F.col("p_retailprice").alias("pre_close"),
            F.lit(0.001).alias("price_tick"),
        )

    def trade_calendar(self) -> DataFrame:
        days = (
            self.given("orders").select(F.col("o_orderdate").cast("date").alias("date"))
            .union(self.given("events").select(F.col("ts").cast("date")))
            .distinct()
        )
        return days.select("date", F.when(F.weekday("date") < 5, "1").otherwise("0").alias("is_open"))

    def bars_open(self) -> DataFrame:
        open_days = self.trade_calendar().where("is_open = '1'").select("date")
        return self.bars_daily().join(open_days, "date", "left_semi")

    def raw_lines(self) -> DataFrame:
        close = F.when(F.col("volume") % 6 == 0, "-").otherwise(F.col("close").cast("string"))
        text = F.concat_ws(
            ",", F.col("date").cast("string"), F.col("open").cast("string"), close,
            F.col("high").cast("string"), F.col("low").cast("string"),
            F.col("volume").cast("string"), F.col("amount").cast("string"),
            F.lit("0.0"), F.lit("1.5"),
        )
        line = F.when(F.col("volume") % 7 == 0, "bad,line").otherwise(text)
        return self.bars_daily().select("symbol", line.alias("line"))
