"""Table schemas, the dataset list with its layouts, and the fixed name tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ByteType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
    TimestampNTZType,
)

TYPES = {
    "STRING": StringType(), "DATE": DateType(), "TIMESTAMP": TimestampNTZType(),
    "DOUBLE": DoubleType(), "BIGINT": LongType(),
}


# Each type and those that hold all its values and that Parquet files of it can be read as.
WIDER = {
    ByteType(): (ShortType(), IntegerType(), LongType(), DoubleType()),
    ShortType(): (IntegerType(), LongType(), DoubleType()),
    IntegerType(): (LongType(), DoubleType()),
    FloatType(): (DoubleType(),),
    DateType(): (TimestampNTZType(),),
}


def widest(a: DataType, b: DataType) -> DataType | None:
    """The one of two types that holds the values of both; None if neither does."""
    if a == b or b in WIDER.get(a, ()):
        return b
    return a if a in WIDER.get(b, ()) else None


def schema(columns: str) -> StructType:
    """``name TYPE, …`` as a schema; needs no session, as parsing DDL would."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


PRICES = "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE"

SERIES = schema(f"symbol STRING, kline_time TIMESTAMP, {PRICES}, volume BIGINT, amount DOUBLE")
BARS = schema(f"symbol STRING, date DATE, {PRICES}, volume DOUBLE, amount DOUBLE")
UNIVERSE = schema("code STRING, name STRING, type STRING, list_date STRING")
FUND_LIST = schema("symbol STRING, name STRING, type STRING")
CODE_INFO = schema(
    "code STRING, pre_close DOUBLE, high_limited DOUBLE, low_limited DOUBLE, price_tick DOUBLE"
)
CALENDAR = schema("date STRING, is_open STRING")
HOLDINGS = schema("fund_code STRING, date DATE, symbol STRING, stk_mkv_ratio DOUBLE, mkv DOUBLE")
FUND_BASIC = schema("symbol STRING, csname STRING")
ADJUSTMENT = schema("symbol STRING, date STRING, adj_factor DOUBLE")
TICKS = schema("time STRING, price DOUBLE, volume DOUBLE, amount DOUBLE, symbol STRING")
UPDATE_LOG = schema(
    "table_name STRING, run_type STRING, run_date STRING, data_date STRING, symbol STRING, "
    "source STRING, status STRING, error_msg STRING, rows_count BIGINT, start_time STRING, "
    "end_time STRING, duration_ms BIGINT"
)


def empty(spark: SparkSession, like: StructType) -> DataFrame:
    return spark.createDataFrame([], like)


@dataclass(frozen=True)
class Dataset:
    name: str
    group: str
    layout: str  # "single", "year" or "month"
    tag: str | None = None  # the key column a per-key delivery is tagged with
    priority: int = 2


# Names, groups, layouts, tag columns and priorities of the stored datasets.
DATASETS = {
    d.name: d
    for d in [
        Dataset("etf_universe", "universe", "single", None, 0),
        Dataset("index_universe", "universe", "single", None, 0),
        Dataset("stock_universe", "universe", "single", None, 0),
        Dataset("code_info", "universe", "single", None, 0),
        Dataset("etf_daily", "daily", "year", "symbol", 0),
        Dataset("etf_min1", "minute", "month", "symbol", 0),
        Dataset("etf_adj", "adjustment", "single", "code", 1),
        Dataset("stock_adj", "adjustment", "single", "code", 1),
        Dataset("index_daily", "daily", "year", "symbol", 1),
        Dataset("stock_daily", "daily", "year", "symbol", 1),
        Dataset("etf_min5", "minute", "month", "symbol", 1),
        Dataset("index_min1", "minute", "month", "symbol", 1),
        Dataset("index_min5", "minute", "month", "symbol", 1),
        Dataset("etf_nav", "fund", "single", "code", 1),
        Dataset("etf_share", "fund", "single", "code", 1),
        Dataset("index_constituent", "index", "single", "index_code", 1),
        Dataset("index_weight", "index", "single", "index_code", 1),
        Dataset("balance_sheet", "financial", "single", "code", 1),
        Dataset("income", "financial", "single", "code", 1),
        Dataset("cash_flow", "financial", "single", "code", 1),
        Dataset("profit_express", "financial", "single", "code", 1),
        Dataset("profit_notice", "financial", "single", "code", 1),
        Dataset("stock_margin_summary", "event", "single", "code", 2),
        Dataset("stock_margin_detail", "event", "single", "code", 2),
        Dataset("stock_block_trading", "event", "single", "code", 2),
        Dataset("stock_longhubang", "event", "single", "code", 2),
        Dataset("stock_dividend", "event", "single", "code", 2),
        Dataset("stock_equity_structure", "event", "single", "code", 2),
        Dataset("stock_holder_num", "event", "single", "code", 2),
        Dataset("stock_share_holder", "event", "single", "code", 2),
        Dataset("stock_equity_pledge", "event", "single", "code", 2),
        Dataset("stock_right_issue", "event", "single", "code", 2),
        Dataset("industry_base", "industry", "single", "industry_code", 2),
        Dataset("industry_constituent", "industry", "single", "industry_code", 2),
        Dataset("industry_daily", "industry", "single", "industry_code", 2),
        Dataset("industry_weight", "industry", "single", "industry_code", 2),
        Dataset("hist_code_list", "universe", "single", None, 2),
        Dataset("etf_pcf", "fund", "single", "code", 2),
    ]
}

# Security type -> universe table.
UNIVERSE_OF_TYPE = {
    "EXTRA_ETF": "etf_universe",
    "EXTRA_INDEX_A": "index_universe",
    "EXTRA_STOCK_A": "stock_universe",
}

# Bar period -> fund table.
TABLE_OF_PERIOD = {"day": "etf_daily", "1min": "etf_min1", "5min": "etf_min5"}

# Requested data type -> delivered table.
DELIVERED = {
    "etf_daily": "fund_daily",
    "etf_adj": "fund_adj",
    "etf_adj_factor": "fund_adj",
    "etf_share": "fund_share",
    "etf_nav": "fund_nav",
    "stock_basic": "stock_basic",
    "daily": "daily",
    "adj_factor": "adj_factor",
    "etf_basic": "etf_basic",
    "fund_basic": "fund_basic",
    "fund_daily": "fund_daily",
    "fund_adj": "fund_adj",
    "fund_share": "fund_share",
    "fund_nav": "fund_nav",
    "fund_mins": "fund_mins",
    "index_daily": "index_daily",
    "index_basic": "index_basic",
    "index_weight": "index_weight",
    "trade_cal": "trade_cal",
    "money_flow": "money_flow",
    "limit_list": "limit_list",
    "stk_limit": "stk_limit",
    "suspend_d": "suspend_d",
    "namechange": "namechange",
    "fund_portfolio": "fund_portfolio",
}

# Vendor column -> standard column, in order of precedence.
STANDARD_NAMES = [
    ("trade_date", "date"), ("cal_date", "date"), ("nav_date", "date"), ("end_date", "date"),
    ("ann_date", "date"), ("ts_code", "symbol"), ("code", "symbol"), ("vol", "volume"),
    ("volume_amount", "volume"), ("money_amount", "amount"),
]

# Localized header -> bar column.
LOCALIZED_HEADER = {
    "股票代码": "code", "日期": "kline_time", "开盘": "open", "收盘": "close",
    "最高": "high", "最低": "low", "成交量": "volume", "成交额": "amount",
}

# Fixed values: (rows expected at least, days without new data allowed) of the checked tables.
QUALITY_LIMITS = {
    "trade_calendar": (4380, 7),
    "etf_basic": (2500, 7),
    "etf_daily": (30, 3),
    "etf_adj_factor": (20000, 7),
    "etf_share": (500, 7),
    "etf_nav": (500, 7),
    "index_daily": (30, 3),
    "fund_portfolio": (1000, 120),
    "stk_limit": (7000, 3),
    "etf_spot_ths": (1500, 7),
    "etf_scale_sse": (500, 14),
    "etf_minute": (1000, 1),
}

# Relative difference two sources may have, per field; else the default.
TOLERANCE = {
    "open": 0.005, "high": 0.005, "low": 0.005, "close": 0.005, "volume": 0.02, "amount": 0.02,
}
DEFAULT_TOLERANCE = 0.01
COMPARED_FIELDS = ["open", "high", "low", "close", "volume", "amount"]
