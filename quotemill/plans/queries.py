"""The query catalogue: one entry per operator, over the market tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators import (
    calendar, columns, compare, fallback, holdings, keyed, quality, series, sketches, validate,
)
from ..session import scratch_path
from ..sinks import bucketed, database, sketches as sketched, store as sink
from ..sources import payloads, store
from ..sources.commits import live_files, write_note
from ..streaming.incremental import upsert_stream
from . import jobs
from .fixtures import Tables

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

AS_OF = "2024-01-30"
RUN_TIME = "2024-01-30 18:00:00"
FEED_KEYS = ["l_orderkey", "l_linenumber"]
FEED_SPLIT = "1998-01-01"
DIRTY_RULES = validate.Rules(
    required=("symbol", "date", "name"), not_null=("symbol",), unique=("symbol", "date"),
    order=("seq",), strip=True, ranges={"close": (0.001, 200000.0)},
)


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    CATALOGUE[function.__name__] = lambda spark, root: function(Tables(spark, root))
    return function


# -- stored copies the source queries read --------------------------------------

_STORED: dict[tuple[str, str, str], str] = {}


def _stored(t: Tables, table: str, write: Callable[[str], None]) -> str:
    """The root a table is stored under, written on first use in this application."""
    key = (t.spark.sparkContext.applicationId, t.root, table)
    if key not in _STORED:
        root = scratch_path(t.spark, "store")
        write(root)
        _STORED[key] = root
    return _STORED[key]


def _daily_store(t: Tables) -> str:
    return _stored(t, "etf_daily", lambda root: sink.write_series(
        t.bars_daily(), root, "etf_daily", "year", time="date"))


def _years_store(t: Tables) -> str:
    """Daily bars of three years; a symbol in three has stopped after the first."""
    bars = t.bars_daily()
    goes_on = F.substring("symbol", 1, 6).cast("int") % 3 != 0
    parts = [bars.withColumn("date", F.add_months("date", -24)), bars.withColumn("date", F.add_months("date", -12)).where(goes_on), bars.where(goes_on)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _stored(t, "years", lambda root: sink.write_series(whole, root, "etf_daily", "year", time="date"))


def _minute_store(t: Tables) -> str:
    return _stored(t, "etf_min1", lambda root: sink.write_series(
        t.bars_min(), root, "etf_min1", "month"))


def _meta_store(t: Tables) -> str:
    def write(root: str) -> None:
        sink.write_table(universe(t), root, "etf_universe")
        sink.write_table(t.code_info(), root, "code_info")
        sink.write_table(t.fund_basic(), root, "etf_basic")

    return _stored(t, "meta", write)


def universe(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    market = F.when(key % 2 == 0, ".SH").otherwise(".SZ")
    return t.given("customer").select(
        F.concat(F.lpad(key.cast("string"), 6, "0"), market).alias("code"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type"),
        F.lit("20130101").alias("list_date"),
    )


def _users(t: Tables) -> DataFrame:
    return universe(t).select(F.col("code").alias("symbol"))


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, name)


def _halves(df: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the day that splits a feed."""
    split = F.to_date(F.lit(FEED_SPLIT))
    return df.where(F.col(date) < split), df.where(F.col(date) >= split)


def _divides(n: int, column: str = "volume") -> Column:
    return F.col(column) % n == 0


# -- sources ---------------------------------------------------------------------

@query
def s1_scan_bars(t: Tables) -> DataFrame:
    return store.read_series(t.spark, _daily_store(t), "etf_daily")


@query
def s2_minute_scan(t: Tables) -> DataFrame:
    first, last = t.bars_min().agg(F.to_date(F.min("kline_time")), F.to_date(F.max("kline_time"))).first()
    return store.read_range(t.spark, _minute_store(t), "etf_min1", None, first, last)


@query
def s3_unpartitioned(t: Tables) -> DataFrame:
    return store.read_table(t.spark, _meta_store(t), "etf_basic")


@query
def s4_read_where(t: Tables) -> DataFrame:
    wanted = ["symbol", "close", "date", "not_there"]
    return store.read(t.spark, _daily_store(t), "etf_daily", wanted, where="close > open")


@query
def s6_code_list(t: Tables) -> DataFrame:
    return store.code_list(t.spark, _meta_store(t), "EXTRA_ETF")


@query
def s7_code_info(t: Tables) -> DataFrame:
    traded = t.given("lineitem").select(F.col("l_partkey").alias("code"))
    return store.code_info(t.spark, _meta_store(t), traded)


@query
def s8_fund_list(t: Tables) -> DataFrame:
    return store.fund_list(t.spark, _meta_store(t))


@query
def s11_parse_lines(t: Tables) -> DataFrame:
    return payloads.parse_bar_lines(t.raw_lines())


def _by_month(df: DataFrame, entry: Column, date: str = "date") -> DataFrame:
    """Entries as one array per symbol and month: 31 at most, as a symbol has one bar a day."""
    return df.groupBy("symbol", F.date_trunc("month", date).alias("month")).agg(
        F.collect_list(entry).alias("entries")
    )


@query
def s12_json_bars(t: Tables) -> DataFrame:
    bars = t.bars_daily()
    entry = F.struct(
        F.col("date").cast("string").alias("day"),
        F.when(_divides(7), "x").otherwise(F.col("open").cast("string")).alias("open"),
        "high", "low", F.col("close").cast("string").alias("close"),
        F.when(~_divides(6), F.col("volume")).alias("volume"),
    )
    landed = _by_month(bars, entry).select("symbol", F.to_json("entries").alias("payload"))
    return payloads.parse_json_bars(landed)


@query
def s11_rejected(t: Tables) -> DataFrame:
    """The lines that cannot be read, and why."""
    return payloads.rejected(payloads.examine_bar_lines(t.raw_lines()))


@query
def s12_rejected(t: Tables) -> DataFrame:
    """The objects that cannot be read, and the payloads that are cut off."""
    entry = F.struct(
        F.col("date").cast("string").alias("day"),
        F.when(_divides(7), "x").otherwise(F.col("open").cast("string")).alias("open"), "high", "low", "close", "volume")
    whole = F.to_json("entries")
    cut = F.when(F.substring("symbol", 1, 6).cast("int") % 9 == 0, F.substring(whole, 1, 10)).otherwise(whole)
    landed = _by_month(t.bars_daily(), entry).select("symbol", cut.alias("payload"))
    out = payloads.rejected(payloads.examine_json_bars(landed))
    return out.select("symbol", F.get_json_object("record", "$.day").alias("day"), "reason")


@query
def s12_json_props(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return t.given("events").select("event_id", parsed["k"].alias("k"))


def _object(key: Column, value: Column) -> Column:
    return F.concat(F.lit('{"data":{"'), key, F.lit('":'), value, F.lit("}}"))


@query
def s13_nested_bars(t: Tables) -> DataFrame:
    text = {c: F.col(c).cast("string") for c in ("date", "open", "close", "high", "low", "volume")}
    text["close"] = F.when(_divides(6), "-").otherwise(text["close"])
    entry = F.when(_divides(7), F.array(text["date"], text["open"])).otherwise(F.array(*text.values()))
    landed = _by_month(t.bars_daily(), entry)
    nested = _object(
        fx.prefixed_code("symbol"), F.concat(F.lit('{"qfqday":'), F.to_json("entries"), F.lit("}")),
    )
    is_list = F.substring("symbol", 1, 6).cast("int") % 9 == 0
    payload = F.when(is_list, '{"data":[]}').otherwise(nested)
    return payloads.parse_nested_bars(landed.select("symbol", payload.alias("payload")))


@query
def s14_minute_tokens(t: Tables) -> DataFrame:
    minute = F.minute("kline_time")
    token = F.concat_ws(
        " ", F.date_format("kline_time", "HHmm"),
        F.when(minute % 7 == 0, None).otherwise(F.col("close").cast("string")),
        F.when(minute % 7 == 0, None).otherwise(F.col("volume").cast("string")),
        F.when((minute % 7 == 0) | (minute % 5 == 0), None).otherwise(F.col("amount").cast("string")),
    )
    # one payload a symbol and day: 1,440 tokens at most
    landed = t.bars_min().groupBy("symbol", F.to_date("kline_time").alias("day")).agg(
        F.collect_list(token).alias("tokens")
    )
    body = F.concat(F.lit('{"data":{"data":'), F.to_json("tokens"), F.lit("}}"))
    payload = F.concat(F.lit("min_data="), _object(fx.prefixed_code("symbol"), body))
    return payloads.parse_minute_tokens(landed.select("symbol", payload.alias("payload")))


@query
def s14_minute_stored(t: Tables) -> DataFrame:
    """Minute ticks with the payload's day: parsed, stored by month, read back."""
    token = F.concat_ws(" ", F.date_format("kline_time", "HHmm"), F.col("close").cast("string"), F.col("volume").cast("string"))
    landed = t.bars_min().groupBy("symbol", F.to_date("kline_time").alias("day")).agg(F.collect_list(token).alias("tokens"))
    body = F.concat(F.lit('{"data":{"data":'), F.to_json("tokens"), F.lit("}}"))
    payload = F.concat(F.lit("min_data="), _object(fx.prefixed_code("symbol"), body))
    ticks = payloads.parse_minute_tokens(landed.select("symbol", "day", payload.alias("payload")), day="day")
    root = _scratch(t, "ticks")
    sink.write_series(ticks, root, "etf_min1", "month")
    return store.read_series(t.spark, root, "etf_min1")


@query
def s15_spot_list(t: Tables) -> DataFrame:
    item = F.struct(
        fx.bare_code("symbol").alias("f12"),
        F.when(F.col("symbol").endswith(".SZ"), "SZ").alias("f13"),
        F.concat(F.lit("N"), "symbol").alias("f14"),
        F.when(_divides(6), "-").otherwise(F.col("close").cast("string")).alias("f2"),
        F.col("volume").alias("f5"), F.col("amount").alias("f6"),
    )
    # pages of a hundred codes a day
    page = F.floor(F.substring("symbol", 1, 6).cast("int") / 100)
    landed = t.bars_daily().groupBy("date", page.alias("page")).agg(F.collect_list(item).alias("items"))
    payload = F.concat(F.lit('{"data":{"diff":'), F.to_json("items"), F.lit("}}"))
    return payloads.parse_spot_list(landed.select(payload.alias("payload")))


@query
def s16_text_bars(t: Tables) -> DataFrame:
    path = _scratch(t, "bars-csv")
    bars = t.bars_daily()
    text = {c: F.col(c).cast("string") for c in bars.columns}
    text["open"] = F.when(_divides(6), "").otherwise(text["open"])
    text["amount"] = F.when(_divides(5), "").otherwise(text["amount"])
    order = ["amount", "close", "date", "high", "low", "open", "symbol", "volume"]
    bars.select(*[text[c].alias(c) for c in order]).write.option("header", True).csv(path)
    return payloads.text_bars(payloads.read_landed_csv(t.spark, path, bars.columns))


@query
def s17_adjustments(t: Tables) -> DataFrame:
    factor = F.when(_divides(4), "").otherwise(F.col("close").cast("string"))
    landed = t.bars_daily().select("symbol", F.col("date").cast("string").alias("date"), factor.alias("adj_factor"))
    return payloads.text_adjustments(landed)


@query
def s18_open_days(t: Tables) -> DataFrame:
    landed = t.trade_calendar().select(fx.compact_date("date").alias("date"), "is_open")
    return calendar.open_days(landed)


@query
def s19_localized_bars(t: Tables) -> DataFrame:
    bars = t.bars_daily()
    landed = bars.select(
        "symbol", fx.bare_code("symbol").alias("股票代码"), F.col("date").cast("string").alias("日期"),
        F.col("open").alias("开盘"), F.col("close").alias("收盘"), F.col("high").alias("最高"),
        F.col("low").alias("最低"), F.col("volume").alias("成交量"), F.col("amount").alias("成交额"),
    )
    return payloads.localized_bars(landed)


@query
def s20_tagged_union(t: Tables) -> DataFrame:
    return columns.tagged_union({"user": t.bars_daily(), "type": t.bars_by_type()}, "origin")


@query
def s21_landed_alias(t: Tables) -> DataFrame:
    root = _scratch(t, "landed")
    vendor = t.bars_daily().withColumnsRenamed({"symbol": "ts_code", "date": "trade_date"})
    sink.write_table(vendor, root, payloads.delivered_table("etf_daily"))
    return payloads.read_landed(t.spark, root, "etf_daily", ["ts_code", "trade_date", "close", "pre_close"])


@query
def s22_bars_by_period(t: Tables) -> DataFrame:
    return store.read_period(t.spark, _daily_store(t), _users(t), "day")


# -- sinks -----------------------------------------------------------------------

@query
def k1_write_series(t: Tables) -> DataFrame:
    root = _scratch(t, "series")
    sink.write_series(t.bars_min(), root, "etf_min1", "month")
    return store.read_table(t.spark, root, "etf_min1")


@query
def k1_minute_text(t: Tables) -> DataFrame:
    """Minute bars whose time came as text."""
    root = _scratch(t, "series")
    text = t.bars_min().withColumn("kline_time", F.date_format("kline_time", "yyyy-MM-dd HH:mm:ss"))
    sink.write_series(text, root, "etf_min1", "month")
    return store.read_series(t.spark, root, "etf_min1")


@query
def k2_replace_columns(t: Tables) -> DataFrame:
    """A single table replaced as a whole: other columns, and another type of one that stays."""
    root = _scratch(t, "single")
    sink.write_table(t.fund_basic().withColumn("note", F.lit("old")), root, "etf_basic")
    sink.write_table(t.fund_basic().select("csname", F.length("symbol").alias("symbol")), root, "etf_basic")
    return store.read_table(t.spark, root, "etf_basic")


@query
def k2_write_table(t: Tables) -> DataFrame:
    root = _scratch(t, "single")
    sink.write_table(t.fund_basic(), root, "etf_basic")
    sink.write_table(t.fund_basic().where("csname is not null"), root, "etf_basic")
    return store.read_table(t.spark, root, "etf_basic")


@query
def k3_write_modes(t: Tables) -> DataFrame:
    root = _scratch(t, "modes")
    bars = t.bars_daily()
    sink.write(bars, root, "etf_daily", layout="year")
    late = bars.where(F.col("symbol").endswith(".SH") & (F.day("date") > 20))
    sink.write(late.withColumn("close", F.col("close") * 2), root, "etf_daily", "replace", layout="year")
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def k1_overwrite_one_symbol(t: Tables) -> DataFrame:
    """Half of the symbols written again, into a store that has the others and another year."""
    root = _scratch(t, "series")
    sink.write_series(_two_years(t), root, "etf_daily", "year", time="date")
    again = t.bars_daily().where(F.col("symbol").endswith(".SH")).withColumn("close", F.col("close") * 2)
    sink.write_series(again, root, "etf_daily", "year", time="date")
    return store.read_series(t.spark, root, "etf_daily")


def _two_years(t: Tables) -> DataFrame:
    """The daily bars and the same a year earlier."""
    bars = t.bars_daily()
    return bars.withColumn("date", F.add_months("date", -12)).unionByName(bars)


@query
def k4_upsert_null_date(t: Tables) -> DataFrame:
    """Rows without a date are a partition of their own; a batch replaces those of its symbols."""
    root = _scratch(t, "undated")
    undated = t.bars_daily().groupBy("symbol").agg(
        F.lit(None).cast("date").alias("date"), *[F.max(c).alias(c) for c in ("open", "high", "low", "close", "volume", "amount")])
    sink.write_series(t.bars_daily().unionByName(undated), root, "etf_daily", "year", time="date")
    batch = undated.where(F.col("symbol").endswith(".SH")).withColumn("close", F.col("close") * 2)
    sink.upsert(batch, root, "etf_daily", ["symbol", "date"], ["close"], "year")
    return store.read_series(t.spark, root, "etf_daily")


@query
def k4_upsert_new_column(t: Tables) -> DataFrame:
    """A column that comes later is null for the rows before it, and stays for those that have it."""
    root = _scratch(t, "columns")
    bars = t.bars_daily()
    sink.write_series(bars.withColumn("date", F.add_months("date", -12)), root, "etf_daily", "year", time="date")
    order = ["close"]
    sink.upsert(bars.withColumn("pct_chg", F.lit(1.5)), root, "etf_daily", ["symbol", "date"], order, "year")
    late = bars.where(F.col("symbol").endswith(".SH")).withColumn("close", F.col("close") * 2)
    sink.upsert(late, root, "etf_daily", ["symbol", "date"], order, "year")
    return store.read_series(t.spark, root, "etf_daily")


@query
def k4_upsert(t: Tables) -> DataFrame:
    root = _scratch(t, "upsert")
    for part in _halves(t.feed_dup(), "l_shipdate"):
        sink.upsert(part, root, "feed", FEED_KEYS, t.FEED_ORDER, "bucket")
    return store.read_table(t.spark, root, "feed")


@query
def k4_upsert_bars(t: Tables) -> DataFrame:
    """Into a table partitioned by year: source C first, then source B over it."""
    root = _scratch(t, "upsert-bars")
    for part in (t.source_c(), t.source_b()):
        sink.upsert(part, root, "etf_daily", ["symbol", "date"], ["volume"], "year")
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def k4_upsert_files(t: Tables) -> DataFrame:
    """One day again, and one day more, into a year that was written day by day: files without a key of the batch stay."""
    root = _scratch(t, "files")
    bars, day = t.bars_daily(), F.to_date(F.lit("2024-01-15"))
    sink.write_series(bars.where(F.col("date") < day), root, "etf_daily", "year", time="date")
    sink.upsert(bars.where(F.col("date") == day), root, "etf_daily", ["symbol", "date"], ["close"], "year")
    before = set(live_files(t.spark, f"{root}/etf_daily"))
    again = bars.where(F.col("date") == day).withColumn("close", F.col("close") * 2)
    more = bars.where(F.col("date") == F.date_add(day, 1))
    sink.upsert(again.unionByName(more), root, "etf_daily", ["symbol", "date"], ["close"], "year")
    if len(before - set(live_files(t.spark, f"{root}/etf_daily"))) != 1:
        raise RuntimeError("the one file of the day was to be rewritten")
    return store.read_series(t.spark, root, "etf_daily")


@query
def k4_upsert_wider(t: Tables) -> DataFrame:
    """A batch with a wider type of a column than the table has; rows in files that stay are read with it as well."""
    root = _scratch(t, "wider")
    bars = t.bars_daily().withColumn("volume", F.col("volume").cast("int"))
    sink.write_series(bars, root, "etf_daily", "year", time="date")
    late = bars.where(F.col("symbol").endswith(".SH")).withColumn("volume", F.col("volume").cast("bigint") + 3_000_000_000)
    sink.upsert(late, root, "etf_daily", ["symbol", "date"], ["close"], "year")
    return store.read_series(t.spark, root, "etf_daily")


@query
def k4_compact(t: Tables) -> DataFrame:
    """A year written in twelve runs, its small files merged."""
    root = _scratch(t, "compact")
    for i in range(12):
        part = t.bars_daily().where(F.day("date") % 12 == i)
        sink.write_series(part, root, "etf_daily", "year", time="date", mode="append", partitions=1)
    sink.compact(t.spark, root, "etf_daily")
    return store.read_series(t.spark, root, "etf_daily")


@query
def k5_merge_null_keys(t: Tables) -> DataFrame:
    order = ["date", "seq"]
    early, late = _halves(t.dirty(), "date")
    none = early.limit(0)
    existing = keyed.merge_by_key(none, early, ["symbol"], order, null_safe=False)
    return keyed.merge_by_key(existing, late, ["symbol"], order, null_safe=False)


@query
def k6_nan_to_null(t: Tables) -> DataFrame:
    close = F.when(_divides(6), float("nan")).otherwise(F.col("close"))
    return database.nan_to_null(t.bars_daily().withColumn("close", close))


@query
def k7_database_types(t: Tables) -> DataFrame:
    log = t.run_log().withColumn("run_date", fx.compact_date("data_date"))
    return database.database_types(log)


@query
def k8_multi_target(t: Tables) -> DataFrame:
    one, two = _scratch(t, "target"), _scratch(t, "target")
    targets = [{"root": one, "table": "bars", "layout": "year"}, {"root": two, "table": "bars"}]
    sink.write_to_targets(t.bars_daily(), targets)
    read = {"one": store.read_table(t.spark, one, "bars"), "two": store.read_table(t.spark, two, "bars")}
    both = columns.tagged_union({k: store.without_partitions(v) for k, v in read.items()}, "target")
    return both.groupBy("target", "symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("volume").alias("volume"), F.max("close").alias("close"),
    )


@query
def k8_targets_rows(t: Tables) -> DataFrame:
    """The rows of both targets, whole."""
    one, two = _scratch(t, "target"), _scratch(t, "target")
    targets = [{"root": one, "table": "bars", "layout": "month"}, {"root": two, "table": "bars", "if_exists": "replace"}]
    sink.write_to_targets(t.bars_daily(), targets)
    read = {"one": store.read_series(t.spark, one, "bars"), "two": store.read_table(t.spark, two, "bars")}
    return columns.tagged_union(read, "target")


@query
def k10_log_update(t: Tables) -> DataFrame:
    root = _scratch(t, "log")
    sink.log_update(t.bars_daily(), root, "etf_daily", "backfill", "events", RUN_TIME)
    sink.log_update(t.holdings(), root, "fund_portfolio", "backfill", "lineitem", RUN_TIME, by_symbol=False)
    log = sink.read_log(t.spark, root)
    return log.select("table_name", "run_type", "run_date", "data_date", "symbol", "source", "status", "rows_count")


@query
def k11_json_records(t: Tables) -> DataFrame:
    return sink.json_records(t.run_log().select("id", "table_name", "data_date", "status", "rows_count"))


# -- projections and filters -----------------------------------------------------

@query
def p1_transforms(t: Tables) -> DataFrame:
    return columns.apply_transforms(t.holdings(), [
        {"action": "rename", "mapping": {"fund_code": "fund", "absent": "x"}},
        {"action": "drop", "columns": ["stk_mkv_ratio", "absent"]},
        {"action": "astype", "mapping": {"mkv": "bigint", "absent": "int"}},
        {"action": "add_column", "name": "origin", "value": "lineitem"},
        {"action": "add_column", "name": "note"},
    ])


@query
def p2_drop(t: Tables) -> DataFrame:
    return columns.apply_transforms(t.bars_daily(), [{"action": "drop", "columns": ["amount", "absent"]}])


@query
def p3_astype(t: Tables) -> DataFrame:
    types = {"volume": "int", "date": "timestamp_ntz", "absent": "int"}
    return columns.apply_transforms(t.bars_daily(), [{"action": "astype", "mapping": types}])


@query
def p4_add_column(t: Tables) -> DataFrame:
    return columns.apply_transforms(t.fund_basic(), [{"action": "add_column", "name": "kind", "value": "fund"}])


@query
def p5_normalize_names(t: Tables) -> DataFrame:
    vendor = t.given("orders").select(
        F.col("o_custkey").alias("ts_code"), F.col("o_orderkey").alias("code"),
        F.col("o_orderdate").cast("date").alias("nav_date"), F.lit("x").alias("ann_date"),
        F.col("o_totalprice").alias("money_amount"), F.lit(1).alias("vol"),
    )
    return columns.normalize_names(vendor)


@query
def p6_consumer_names(t: Tables) -> DataFrame:
    return columns.consumer_names(t.bars_min().withColumnRenamed("symbol", "code"))


@query
def p8_symbol_list(t: Tables) -> DataFrame:
    return columns.in_symbols(t.bars_daily(), _users(t))


@query
def p9_date_range(t: Tables) -> DataFrame:
    return series.between_dates(t.bars_min(), "2024-01-08", "2024-01-19")


@query
def p10_minute_day(t: Tables) -> DataFrame:
    return store.read_minutes(t.spark, _minute_store(t), "2024-01-15")


@query
def p6_price_names(t: Tables) -> DataFrame:
    return columns.price_names(t.bars_daily())


@query
def p11_complete_symbol(t: Tables) -> DataFrame:
    bare = F.when(F.col("type") == "BUILDING", fx.bare_code("code")).otherwise(F.col("code"))
    return universe(t).select("name", fx.complete_symbol(bare).alias("symbol"))


@query
def p12_symbol_dialects(t: Tables) -> DataFrame:
    return universe(t).select(
        "code", fx.dotted_code("code").alias("dotted"), fx.prefixed_code("code").alias("prefixed"),
        fx.numbered_code("code").alias("numbered"), fx.bare_code("code").alias("bare"),
        fx.stripped_market("code").alias("stripped"),
        fx.symbol_from_dotted(fx.dotted_code("code")).alias("back"),
    )


@query
def p13_date_dialects(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 3 == 0, fx.compact_date(day)).otherwise(day.cast("string"))
    text = F.when(F.col("o_orderkey") % 11 == 0, "no date").otherwise(text)
    return t.given("orders").select(
        "o_orderkey", fx.compact_date(day).alias("compact"), fx.int_date(day).alias("number"),
        fx.to_day(text).alias("day"), fx.without_dashes(day.cast("string")).alias("dashless"),
    )


@query
def p14_split_code(t: Tables) -> DataFrame:
    return columns.split_code(universe(t).select(F.col("code").alias("ts_code"), "name"))


@query
def p15_lookback(t: Tables) -> DataFrame:
    return series.lookback(t.bars_daily(), AS_OF, 5)


@query
def p16_price_limits(t: Tables) -> DataFrame:
    high, low = fx.price_limits("pre_close", "price_tick")
    return t.code_info().select("code", "pre_close", high.alias("high_limited"), low.alias("low_limited"))


@query
def p18_display_name(t: Tables) -> DataFrame:
    named = holdings.named_holdings(t.holdings(), t.fund_basic())
    return holdings.display_name(named.select("fund_code", "fund_name").distinct())


@query
def p19_bands(t: Tables) -> DataFrame:
    return _by_symbol(t).select("symbol", fx.consistency_band("consistency").alias("band"))


# -- validation ------------------------------------------------------------------

@query
def v2_drop_null_keys(t: Tables) -> DataFrame:
    return validate.drop_null_keys(t.dirty(), ["symbol", "date"])


@query
def v3_keep_last(t: Tables) -> DataFrame:
    return validate.deduplicate(t.feed_dup(), FEED_KEYS, t.FEED_ORDER)


@query
def v3_keep_last_null_keys(t: Tables) -> DataFrame:
    return validate.deduplicate(t.dirty(), ["symbol"], ["seq"])


@query
def v4_strip_strings(t: Tables) -> DataFrame:
    return validate.strip_strings(t.dirty())


@query
def v5_ranges(t: Tables) -> DataFrame:
    return validate.flag_ranges(t.dirty(), {"close": (0.001, 200000.0)})


@query
def v6_preset_daily(t: Tables) -> DataFrame:
    return validate.clean(t.dirty(), validate.with_order("daily", ["seq"]))


@query
def v6_preset_basic(t: Tables) -> DataFrame:
    """Reference data delivered twice, some without a symbol, names with blanks around them."""
    named = t.fund_basic().withColumnRenamed("csname", "name")
    first = named.withColumn("name", F.concat(F.lit(" "), "name", F.lit("  "))).withColumn("seq", F.lit(1))
    again = named.withColumn("symbol", F.nullif("symbol", F.lit("F1"))).withColumn("seq", F.lit(2))
    return validate.clean(first.unionByName(again), validate.with_order("basic", ["seq"]))


@query
def v8_report(t: Tables) -> DataFrame:
    return validate.report(t.dirty(), DIRTY_RULES)


# -- joins -----------------------------------------------------------------------

@query
def j1_holdings_named(t: Tables) -> DataFrame:
    return holdings.named_holdings(t.holdings(), t.fund_basic())


@query
def j2_close_matrix(t: Tables) -> DataFrame:
    return series.close_matrix(t.bars_by_type())


@query
def j3_common_dates(t: Tables) -> DataFrame:
    a = t.source_b().select("symbol", "date", F.col("close").alias("close_b"))
    b = t.source_c().select("symbol", "date", F.col("close").alias("close_c"))
    return a.join(b, ["symbol", "date"])


@query
def j4_symbol_fallback(t: Tables) -> DataFrame:
    return fallback.fallback_by_key([("c", t.source_c()), ("a", t.bars_daily())])


@query
def j4_symbol_fallback_null(t: Tables) -> DataFrame:
    """Rows without a symbol are one key: the first source that has such rows delivers them."""
    nameless = [df.withColumn("symbol", F.when(~_divides(5), F.col("symbol"))) for df in (t.source_c(), t.bars_daily())]
    return fallback.fallback_by_key([("c", nameless[0]), ("a", nameless[1])])


@query
def j4_day_fallback(t: Tables) -> DataFrame:
    chain = [("c", t.source_c()), ("b", t.source_b()), ("a", t.bars_daily())]
    return fallback.fallback_by_key(chain, ("symbol", "date"), unique=True)


@query
def j5_table_fallback(t: Tables) -> DataFrame:
    nothing = t.bars_daily().where(F.col("volume") < 0)
    used, rows = fallback.first_with_rows([("none", nothing), ("c", t.source_c), ("a", t.bars_daily)])
    return rows.withColumn("used_source", F.lit(used))


@query
def j6_open_days(t: Tables) -> DataFrame:
    return calendar.on_trading_days(t.bars_daily(), t.trade_calendar())


@query
def j7_membership(t: Tables) -> DataFrame:
    return columns.in_symbols(universe(t), t.bars_daily().select(F.col("symbol").alias("code")), "code")


@query
def j8_missing_days(t: Tables) -> DataFrame:
    return calendar.missing_days(t.bars_open(), t.trade_calendar())


@query
def j8_missing_recent(t: Tables) -> DataFrame:
    return calendar.missing_days(
        t.bars_open(), t.trade_calendar(), last=10, as_of=AS_OF, through="table"
    )


# -- aggregations ----------------------------------------------------------------

GIVEN = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]


def _profiles(t: Tables) -> DataFrame:
    return quality.profiles({name: t.given(name) for name in GIVEN})


@query
def a1_profile(t: Tables) -> DataFrame:
    return _profiles(t)


@query
def a2_freshness(t: Tables) -> DataFrame:
    return quality.freshness(_profiles(t), AS_OF, 3)


@query
def a3_row_floor(t: Tables) -> DataFrame:
    return quality.row_floor(_profiles(t), 1000)


@query
def a4_duplicates(t: Tables) -> DataFrame:
    return t.dirty().agg(quality.duplicate_count().alias("duplicates"))


LIMITS = {"dirty": (20000, 7), "etf_daily": (30, 3), "fund_portfolio": (1000, 120), "trade_calendar": (4380, 7)}


def _quality(t: Tables) -> DataFrame:
    tables = {
        "dirty": t.dirty(), "etf_daily": t.bars_daily(), "fund_portfolio": t.holdings(),
        "trade_calendar": t.trade_calendar(), "unchecked": t.fund_basic(),
    }
    return quality.quality_report(tables, AS_OF, LIMITS)


def _as_text(report: DataFrame) -> DataFrame:
    return report.withColumn("issues", F.concat_ws("; ", "issues"))


@query
def a5_check_table(t: Tables) -> DataFrame:
    return _as_text(quality.check_table("dirty", t.dirty(), 20000, 7, AS_OF))


@query
def a6_headline(t: Tables) -> DataFrame:
    return quality.quality_headline(_quality(t))


@query
def a7_inventory(t: Tables) -> DataFrame:
    return quality.inventory(_profiles(t))


@query
def a7_inventory_headline(t: Tables) -> DataFrame:
    return quality.inventory_headline(_profiles(t))


@query
def a8_last_update(t: Tables) -> DataFrame:
    return quality.last_update(t.run_log())


@query
def a9_updated_days(t: Tables) -> DataFrame:
    return quality.updated_days(t.run_log(), AS_OF, 7)


@query
def a10_completeness(t: Tables) -> DataFrame:
    return calendar.completeness(t.bars_open())


@query
def a10_completeness_pooled(t: Tables) -> DataFrame:
    return calendar.completeness(t.bars_open(), ())


@query
def a11_extreme_moves(t: Tables) -> DataFrame:
    bars = series.pct_change(t.bars_daily(), span="month")
    return bars.groupBy("symbol").agg(calendar.extreme_moves("pct_chg", 11.0).alias("extreme_moves"))


@query
def a12_fetch_metadata(t: Tables) -> DataFrame:
    return quality.fetch_metadata(t.bars_daily().withColumnRenamed("date", "trade_date"))


def _latest(t: Tables) -> DataFrame:
    return holdings.latest_period(t.holdings())


@query
def a13_headline(t: Tables) -> DataFrame:
    return holdings.headline(_latest(t))


@query
def a13_estimated_distinct(t: Tables) -> DataFrame:
    """Distinct funds, stocks and pairs of all periods from a sketch a period, and whether they are within four percent."""
    held = t.holdings()
    columns = {"funds": "fund_code", "stocks": "symbol", "positions": F.concat_ws("|", "fund_code", "symbol")}
    found = sketches.error_against_exact(held, sketches.distinct_sketches(held, columns, ["date"]), columns)
    return found.select("name", "exact", (F.col("error") <= 0.04).alias("close"))


@query
def a4_estimated_duplicates(t: Tables) -> DataFrame:
    """Rows of a stored table, and its distinct symbols and days, from sketches renewed after a second write."""
    root = _scratch(t, "sketches")
    sink.write_series(_two_years(t), root, "etf_daily", "year", time="date")
    columns = ["symbol", "date"]
    first = sketched.refresh_sketches(t.spark, root, "etf_daily", columns)
    sink.upsert(t.source_b().withColumn("date", F.add_months("date", 12)), root, "etf_daily", ["symbol", "date"], ["close"], "year")
    second = sketched.refresh_sketches(t.spark, root, "etf_daily", columns)
    if (first, second) != (2, 1):
        raise RuntimeError(f"{first} and {second} partitions were read")
    found = sketched.stored_distinct(t.spark, root, "etf_daily", columns)
    exact = store.read_series(t.spark, root, "etf_daily").agg(F.count_distinct("symbol").alias("s"), F.count_distinct("date").alias("d")).first()
    near = [F.abs(F.col(c) - F.lit(n)) <= F.lit(0.04 * n) for c, n in (("symbol", exact["s"]), ("date", exact["d"]))]
    return found.select("rows", near[0].alias("symbols_close"), near[1].alias("days_close"))


@query
def a14_overlap(t: Tables) -> DataFrame:
    return holdings.overlap(_latest(t))


@query
def a14_overlap_all(t: Tables) -> DataFrame:
    return holdings.overlap(holdings.latest_period(t.holdings(), per_fund=True), n=None)


@query
def a15_concentration(t: Tables) -> DataFrame:
    return holdings.concentration(_latest(t))


def _three(t: Tables) -> list[tuple[str, DataFrame]]:
    return [("A", t.bars_daily()), ("B", t.source_b()), ("C", t.source_c())]


def _differences(t: Tables) -> DataFrame:
    return compare.source_differences(_three(t))


def _by_symbol(t: Tables) -> DataFrame:
    return compare.consistency_by_symbol(_differences(t), _users(t))


@query
def a16_consistency(t: Tables) -> DataFrame:
    return _by_symbol(t)


@query
def a16_consistency_all_cells(t: Tables) -> DataFrame:
    return compare.consistency_of_cells(_three(t))


@query
def a17_overall(t: Tables) -> DataFrame:
    return compare.overall_consistency(_by_symbol(t))


@query
def a18_by_field(t: Tables) -> DataFrame:
    return compare.differences_by_field(_differences(t))


@query
def a19_by_pair(t: Tables) -> DataFrame:
    return compare.differences_by_pair(_differences(t))


@query
def a20_symbol_details(t: Tables) -> DataFrame:
    return compare.symbol_details(_by_symbol(t))


@query
def a21_run_summary(t: Tables) -> DataFrame:
    return quality.run_summary(t.run_log())


@query
def a21_task_log(t: Tables) -> DataFrame:
    """The log of two runs of tasks, of which one has no source."""
    root = _scratch(t, "tasks")
    target = [{"root": root, "table": "etf_daily", "layout": "year"}]
    lines = payloads.parse_bar_lines(t.raw_lines())
    absent = lambda: t.spark.read.parquet(f"{root}/absent")
    for name, source in (("etf_daily", lines), ("etf_nav", absent)):
        jobs.run_task({"name": name, "target": target}, [("landed", source)], AS_OF, log_root=root, run_time=RUN_TIME)
    return quality.run_summary(sink.read_log(t.spark, root), by="table_name")


@query
def a22_rows_by_symbol(t: Tables) -> DataFrame:
    return quality.rows_by_symbol(t.bars_daily())


# -- windows, sorts, set operations ----------------------------------------------

@query
def w1_pct_change(t: Tables) -> DataFrame:
    return series.pct_change(t.bars_daily(), span="month")


@query
def w1_pct_change_minutes(t: Tables) -> DataFrame:
    return series.pct_change(t.bars_min(), time="kline_time", span="day")


@query
def w2_last_n_bars(t: Tables) -> DataFrame:
    return series.last_n_bars(t.bars_daily(), 10)


@query
def w2_newest_from_store(t: Tables) -> DataFrame:
    """The newest 40 bars of a symbol, from a store of several years."""
    return store.newest_bars(t.spark, _years_store(t), "etf_daily", 40)


@query
def w2_spans_of_store(t: Tables) -> DataFrame:
    """First and last day and bars of every symbol of a store of several years, from its notes."""
    spans = store.symbol_spans(t.spark, _years_store(t), "etf_daily")
    return spans.select("symbol", F.col("first").alias("first_date"), F.col("last").alias("last_date"), F.col("rows").alias("n_rows"))


@query
def w6_closes_from_store(t: Tables) -> DataFrame:
    return store.newest_closes(t.spark, _years_store(t), "etf_daily", 35)


@query
def w3_top5_holdings(t: Tables) -> DataFrame:
    return holdings.top_holdings(_latest(t))


@query
def w4_top_k_sum(t: Tables) -> DataFrame:
    """Of every period, not only the latest."""
    return holdings.concentration(t.holdings(), by=("fund_code", "date"))


@query
def w5_keep_first(t: Tables) -> DataFrame:
    return validate.deduplicate(t.feed_dup(), FEED_KEYS, t.FEED_ORDER, "first")


@query
def w6_close_matrix_long(t: Tables) -> DataFrame:
    return series.close_matrix_long(t.bars_daily(), 10)


@query
def w6_close_matrix(t: Tables) -> DataFrame:
    return series.close_matrix(t.bars_by_type(), days=10)


@query
def o1_sorted_series(t: Tables) -> DataFrame:
    return t.bars_daily().orderBy("symbol", "date")


@query
def o2_first_symbols(t: Tables) -> DataFrame:
    return universe(t).orderBy("code").limit(100)


@query
def u1_concat(t: Tables) -> DataFrame:
    return columns.union_frames(t.source_b().drop("amount"), t.source_c())


@query
def u2_union_distinct(t: Tables) -> DataFrame:
    return keyed.merge_by_version(t.source_c(), t.source_b(), ["symbol", "date"], ["close", "volume", "open", "amount"])


@query
def u3_common_dates(t: Tables) -> DataFrame:
    return t.source_b().select("symbol", "date").intersect(t.source_c().select("symbol", "date"))


@query
def u4_symbols_lacking(t: Tables) -> DataFrame:
    return t.bars_daily().select("symbol").distinct().exceptAll(t.source_c().select("symbol").distinct())


# -- compound jobs ---------------------------------------------------------------

@query
def c1_source_diffs(t: Tables) -> DataFrame:
    return _differences(t)


def _in_buckets(t: Tables) -> list[tuple[str, DataFrame]]:
    """The three sources as stored in the same buckets of (symbol, date)."""
    def write(root: str) -> None:
        for name, df in _three(t):
            bucketed.write_bucketed(df, root, name, buckets=8)

    root = _stored(t, "buckets", write)
    return [(name, bucketed.read_bucketed(t.spark, root, name)) for name in "ABC"]


@query
def c1_diffs_in_buckets(t: Tables) -> DataFrame:
    return compare.source_differences(_in_buckets(t), in_place=True)


@query
def v3_keep_last_in_buckets(t: Tables) -> DataFrame:
    """The row of each (symbol, date) with the greatest volume, of source B in its buckets."""
    return keyed.keep_last(_in_buckets(t)[1][1], ["symbol", "date"], ["volume"])


@query
def c2_run_task(t: Tables) -> DataFrame:
    root = _scratch(t, "task")
    task = {
        "name": "etf_daily", "start_date": "2024-01-08", "validate": "daily", "order": ["seq"],
        "transform": [{"action": "add_column", "name": "seq", "value": 1}],
        "completeness": {"check_gaps": True},
        "target": [{"root": root, "table": "etf_daily", "layout": "year"}],
    }
    lines = payloads.parse_bar_lines(t.raw_lines())  # days as text
    result = jobs.run_task(task, [("none", lines.limit(0)), ("lines", lines)], AS_OF)
    if result["status"] != "ok":
        raise RuntimeError(result["error"])
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def c2_minute_task(t: Tables) -> DataFrame:
    """Minute bars of two symbols whose time came as numbers in text; what cannot be read is set aside and counted."""
    root = _scratch(t, "task")
    time = F.when(F.minute("kline_time") % 7 == 0, "soon").otherwise(F.date_format("kline_time", "yyyyMMddHHmm"))
    task = {
        "name": "etf_min1", "symbols": ["click", "view"], "end_date": "2024-01-25",
        "validate": {"required": ["symbol"], "dedup_keys": ["symbol", "kline_time"]}, "order": ["volume"],
        "target": {"root": root, "table": "etf_min1", "layout": "month", "keys": ["symbol", "kline_time"], "order": ["volume"]},
    }
    result = jobs.run_task(task, [("minutes", t.bars_min().withColumn("kline_time", time))], AS_OF)
    if result["status"] != "ok":
        raise RuntimeError(result["error"])
    return store.read_series(t.spark, root, "etf_min1").withColumn("set_aside", F.lit(result["unreadable"]).cast("bigint"))


@query
def c2_task_rejected(t: Tables) -> DataFrame:
    """The records that a task has set aside, with the reason of each."""
    root = _scratch(t, "task")
    task = {
        "name": "etf_daily", "target": {"root": root, "table": "etf_daily", "layout": "year"},
        "rejected": {"root": root, "table": "etf_daily_rejected"},
    }
    result = jobs.run_task(task, [("lines", payloads.examine_bar_lines(t.raw_lines()))], AS_OF)
    rejected = store.read_table(t.spark, root, "etf_daily_rejected")
    if result["status"] != "ok" or result["unreadable"] + result["rows_written"] != t.raw_lines().count():
        raise RuntimeError(f"rows were lost: {result}")
    return rejected


@query
def c4_completeness_message(t: Tables) -> DataFrame:
    bars = series.pct_change(t.bars_daily(), span="month")
    return calendar.completeness_message(bars, {"pct_change_col": "pct_chg", "gap_threshold": 11.0})


@query
def c5_quality_report(t: Tables) -> DataFrame:
    return _as_text(quality.quality_report(
        {"dirty": t.dirty(), "etf_daily": t.bars_daily(), "fund_portfolio": t.holdings(),
         "trade_calendar": t.trade_calendar()}, AS_OF, LIMITS))


@query
def c5_quality_store(t: Tables) -> DataFrame:
    """All tables with limits over a store that has one of them."""
    return _as_text(jobs.quality_of_store(t.spark, _daily_store(t), AS_OF))


@query
def c5_corrupt_table(t: Tables) -> DataFrame:
    """A table with a file that is no Parquet is an error row; the other tables have theirs."""
    root = _scratch(t, "store")
    sink.write_series(t.bars_daily(), root, "etf_daily", "year", time="date")
    sink.write_table(t.fund_basic(), root, "etf_share")
    write_note(t.spark, f"{root}/etf_share/part=0/part-broken.parquet", {"no": "table"})
    limits = {name: LIMITS.get(name, (1, 3)) for name in ("etf_daily", "etf_share")}
    return jobs.quality_of_store(t.spark, root, AS_OF, limits).select("table", "rows", "status")


@query
def c5_alerts(t: Tables) -> DataFrame:
    return quality.alerts(_quality(t)).select("table", "status")


@query
def c6_holdings_analysis(t: Tables) -> DataFrame:
    return _analysis(t)["top_holdings"]


def _analysis(t: Tables) -> dict[str, DataFrame]:
    return holdings.analysis(t.holdings(), t.fund_basic(), per_fund=True)


@query
def c6_headline(t: Tables) -> DataFrame:
    return _analysis(t)["headline"]


@query
def c6_overlap(t: Tables) -> DataFrame:
    return _analysis(t)["overlap"]


@query
def c6_concentration(t: Tables) -> DataFrame:
    return _analysis(t)["concentration"]


@query
def c7_inventory(t: Tables) -> DataFrame:
    """Of a store: every table in it, as found."""
    return jobs.inventory_of_store(t.spark, _meta_store(t))


@query
def c8_backfill(t: Tables) -> DataFrame:
    landed, root = _scratch(t, "landed"), _scratch(t, "store")
    t.bars_daily().write.parquet(f"{landed}/etf_daily")
    # delivered per key, one folder each
    t.bars_by_type().withColumnRenamed("symbol", "code").write.partitionBy("code").parquet(f"{landed}/etf_nav")
    t.bars_min().write.parquet(f"{landed}/etf_min1")
    universe(t).write.parquet(f"{landed}/etf_universe")
    jobs.backfill(t.spark, landed, root, RUN_TIME)
    log = sink.read_log(t.spark, root)
    return log.groupBy("table_name", "status").agg(
        F.sum("rows_count").alias("n_rows"), F.count("symbol").alias("n_symbols")
    )


@query
def c8_backfill_rows(t: Tables) -> DataFrame:
    """The rows that a backfill of a series and of a table delivered per key has stored."""
    landed, root = _scratch(t, "landed"), _scratch(t, "store")
    t.bars_daily().write.parquet(f"{landed}/etf_daily")
    t.bars_by_type().withColumnRenamed("symbol", "code").write.partitionBy("code").parquet(f"{landed}/etf_nav")
    jobs.backfill(t.spark, landed, root, RUN_TIME)
    nav = store.read_table(t.spark, root, "etf_nav").withColumnRenamed("code", "symbol")
    return columns.tagged_union({"etf_daily": store.read_series(t.spark, root, "etf_daily").drop("amount"), "etf_nav": nav}, "dataset")


@query
def c8_backfill_again(t: Tables) -> DataFrame:
    """Two deliveries into one table: the log has the rows of each, not of the store."""
    root = _scratch(t, "store")
    for market, when in ((".SH", "2024-01-29 18:00:00"), (".SZ", RUN_TIME)):
        landed = _scratch(t, "landed")
        t.bars_daily().where(F.col("symbol").endswith(market)).write.parquet(f"{landed}/etf_daily")
        jobs.backfill(t.spark, landed, root, when)
    return sink.read_log(t.spark, root).select("start_time", "table_name", "symbol", "rows_count", "status")


@query
def c9_update_day(t: Tables) -> DataFrame:
    """The store up to the last day but one, then two runs for the last day: one has an effect."""
    root = _scratch(t, "store")
    bars = t.bars_daily()
    sink.write_series(bars.where(F.col("date") < F.to_date(F.lit(AS_OF))), root, "etf_daily", "year", time="date")
    chain = [("c", t.source_c()), ("a", bars)]
    for expected in ("updated", "current"):
        done = jobs.update_day(t.spark, root, "etf_daily", AS_OF, t.trade_calendar(), chain, RUN_TIME)
        if done != expected:
            raise RuntimeError(f"{expected} was expected, not {done}")
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def c9_update_minutes(t: Tables) -> DataFrame:
    """The same for minute bars, in a table stored by month that has earlier months."""
    root = _scratch(t, "store")
    bars = t.bars_min()
    day = F.to_date(F.lit(AS_OF))
    earlier = bars.withColumn("kline_time", (F.col("kline_time") - F.expr("INTERVAL 31 DAYS")).cast("timestamp_ntz"))
    sink.write_series(earlier.unionByName(bars.where(F.col("kline_time") < day)), root, "etf_min1", "month")
    done = jobs.update_day(
        t.spark, root, "etf_min1", AS_OF, t.trade_calendar(), [("none", bars.limit(0)), ("a", bars)], RUN_TIME, time="kline_time")
    if done != "updated":
        raise RuntimeError(done)
    return store.read_series(t.spark, root, "etf_min1")


@query
def c10_backfill_universe(t: Tables) -> DataFrame:
    """The newest ten open days, for all symbols there are, stored so far or not."""
    root = _scratch(t, "store")
    sink.write_series(t.source_c(), root, "etf_daily", "year", time="date")
    chain = [("b", t.source_b()), ("a", t.bars_daily())]
    jobs.backfill_missing(
        t.spark, root, "etf_daily", t.trade_calendar(), chain, RUN_TIME, days=10, as_of=AS_OF,
        universe=t.bars_daily().select("symbol"))
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def c10_backfill_missing(t: Tables) -> DataFrame:
    root = _scratch(t, "store")
    sink.write_series(t.source_c(), root, "etf_daily", "year", time="date")
    chain = [("b", t.source_b()), ("a", t.bars_daily())]
    jobs.backfill_missing(
        t.spark, root, "etf_daily", t.trade_calendar(), chain, RUN_TIME, days=None, as_of=AS_OF
    )
    return store.without_partitions(store.read_table(t.spark, root, "etf_daily"))


@query
def c11_fund_holdings(t: Tables) -> DataFrame:
    return holdings.fund_holdings(t.holdings(), t.fund_basic().select(F.col("symbol").alias("fund_code")))


@query
def c11_open_days_of_year(t: Tables) -> DataFrame:
    return calendar.open_days_of_year(t.trade_calendar(), 1998)


# -- streaming -------------------------------------------------------------------

@query
def t1_stream_upsert(t: Tables) -> DataFrame:
    """The later half of a feed arrives before the earlier one, which must not undo it."""
    landing, root = _scratch(t, "landing"), _scratch(t, "table")
    feed = t.feed_dup()
    early, late = _halves(feed, "l_shipdate")
    checkpoint = _scratch(t, "progress")
    for part in (late, early):
        part.write.mode("append").parquet(landing)
        upsert_stream(
            t.spark, landing, feed.schema, root, "feed", FEED_KEYS, t.FEED_ORDER, checkpoint,
            layout="bucket",
        ).awaitTermination()
    return store.read_table(t.spark, root, "feed")


@query
def t1_compacted(t: Tables) -> DataFrame:
    """The same feed in batches, folded into the table's files after every second one and at the end."""
    landing, root, checkpoint = _scratch(t, "landing"), _scratch(t, "table"), _scratch(t, "progress")
    feed = t.feed_dup()
    for part in (*reversed(_halves(feed, "l_shipdate")), feed.where("l_linenumber = 1")):
        part.write.mode("append").parquet(landing)
        upsert_stream(
            t.spark, landing, feed.schema, root, "feed", FEED_KEYS, t.FEED_ORDER, checkpoint,
            layout="bucket", compact_after=2,
        ).awaitTermination()
    sink.compact(t.spark, root, "feed")
    if store.appended_versions(t.spark, store.table_path(root, "feed")):
        raise RuntimeError("versions were left")
    return store.read_table(t.spark, root, "feed")

