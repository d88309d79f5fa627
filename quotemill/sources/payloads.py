"""Vendor payloads landed as text, parsed to rows.

Each payload is one row of text with the symbol it was asked for. Everything is parsed by
built-in functions, so that it stays in generated code; a record that cannot be read is
left out and the others of its payload stay. What was left out, and why, is a second output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import prefixed_code, to_day, to_moment, without_dashes
from ..operators.columns import select_existing, split_code
from ..schemas import DELIVERED, LOCALIZED_HEADER

# The fields of a bar line in their order.
BAR_FIELDS = ("open", "close", "high", "low", "volume", "amount")


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _number(text: Column) -> Column:
    """A decimal number, or null; the cast alone would take ``1d`` for one."""
    text = F.trim(text)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


# -- records with the reason why they cannot be read ------------------------------
#
# ``examine_*`` returns every record of every payload: its columns, the record as it came, and ``reason``, null where
# it can be read. Rows in are rows out and rows set aside; ``readable`` and ``rejected`` are the two sides.

def readable(examined: DataFrame) -> DataFrame:
    return examined.where(F.col("reason").isNull()).drop("record", "reason")


def rejected(examined: DataFrame) -> DataFrame:
    """(symbol, record, reason) of what cannot be read."""
    return examined.where(F.col("reason").isNotNull()).select("symbol", "record", "reason")


def _first_reason(*tests: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(test, reason) for test, reason in tests])


def _no_numbers(*names: str) -> list[tuple[Column, str]]:
    return [(F.col(n).isNull(), f"{n} is no number") for n in names]


def _records(df: DataFrame, items: Column, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """A row an item, as the VARIANT ``_i``; one without an item for a payload that has no list of items."""
    listed = F.coalesce(items, F.array(F.lit(None).cast("variant")))
    rows = df.select("symbol", *keep, F.col(payload).alias("_payload"), F.explode(listed).alias("_i"))
    return rows.withColumn("record", F.coalesce(F.to_json("_i"), "_payload"))


def _parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def _part(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


NO_LIST = "no JSON with a list of records"


def examine_bar_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """``date,open,close,high,low,volume,amount[,amplitude,pct_chg,change,turnover]``: seven fields at least, all
    numbers but the first; the last three may be missing, and are null then."""
    # exploding the one list keeps its split from being repeated in every test of a field
    rows = df.select("symbol", F.col(line).alias("record"), F.explode(F.array(F.split(F.col(line), ","))).alias("_p"))
    numbers = {name: _number(F.get("_p", i + 1)) for i, name in enumerate(BAR_FIELDS)}
    optional = {name: F.get("_p", i) for i, name in ((8, "pct_chg"), (9, "change"), (10, "turnover_rate"))}
    rows = rows.withColumns(numbers | {n: _number(text) for n, text in optional.items()})
    short = F.coalesce(F.size("_p"), F.lit(0)) < 7
    reason = _first_reason(
        (short, "fewer than seven fields"), *_no_numbers(*numbers),
        *[(text.isNotNull() & F.col(n).isNull(), f"{n} is no number") for n, text in optional.items()])
    return rows.select(
        "symbol", without_dashes(F.get("_p", 0)).alias("date"), "open", "high", "low", "close", "volume", "amount",
        "pct_chg", "change", "turnover_rate", "record", reason.alias("reason"),
    )


def parse_bar_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """The bars of the lines that can be read, see ``examine_bar_lines``."""
    return readable(examine_bar_lines(df, line))


def examine_json_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A JSON array of objects day, open, high, low, close, volume; numbers may be text. A missing number is 0, an
    unreadable or null one makes the object unreadable."""
    rows = _records(df, _part(_parsed(F.col(payload)), "$", "array<variant>"), payload)
    names = ("open", "high", "low", "close", "volume")

    def number(name: str) -> Column:
        missing = _part(F.col("_i"), f"$.{name}", "variant").isNull()
        return F.when(missing, F.lit(0.0)).otherwise(_number(_part(F.col("_i"), f"$.{name}", "string")))

    day = F.coalesce(_part(F.col("_i"), "$.day", "string"), F.lit(""))
    rows = rows.withColumns({"date": without_dashes(day)} | {n: number(n) for n in names})
    reason = _first_reason(
        (F.col("_i").isNull(), NO_LIST), (~F.schema_of_variant("_i").startswith("OBJECT"), "no object"), *_no_numbers(*names))
    return rows.select("symbol", "date", *names, "record", reason.alias("reason"))


def parse_json_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The bars of the objects that can be read, see ``examine_json_bars``."""
    return readable(examine_json_bars(df, payload))


def _of_market(df: DataFrame, text: Column, path: str) -> Column:
    """``data.<market code>.<path>``, a list. Where ``data`` is a list itself, or lacks the code, there are no records."""
    whole = _parsed(text)
    data = _part(whole, "$.data", "map<string,variant>")
    entry = _part(F.try_element_at(data, prefixed_code("symbol")), path, "array<variant>")
    return F.when(whole.isNotNull(), F.coalesce(entry, F.array().cast("array<variant>")))


def examine_nested_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``data.<market code>.qfqday``, an array of arrays date, open, close, high, low, volume."""
    rows = _records(df, _of_market(df, F.col(payload), "$.qfqday"), payload)
    names = ("open", "close", "high", "low", "volume")
    rows = rows.withColumn("_p", _part(F.col("_i"), "$", "array<string>"))
    rows = rows.withColumns({"date": F.get("_p", 0)} | {n: _number(F.get("_p", i + 1)) for i, n in enumerate(names)})
    short = F.coalesce(F.size("_p"), F.lit(0)) < 6
    reason = _first_reason((F.col("_i").isNull(), NO_LIST), (short, "fewer than six fields"), *_no_numbers(*names))
    return rows.select("symbol", "date", "open", "high", "low", "close", "volume", "record", reason.alias("reason"))


def parse_nested_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The bars of the entries that can be read, see ``examine_nested_bars``."""
    return readable(examine_nested_bars(df, payload))


def examine_minute_tokens(df: DataFrame, payload: str = "payload", day: str | None = None) -> DataFrame:
    """``name={json}`` with ``data.<market code>.data.data``, an array of blank-separated
    tokens time, price, volume[, amount].

    With ``day``, the column of the payload's day, the time becomes ``kline_time`` and rows can be stored; without it ``time``
    is ``HHMM`` as it came.
    """
    text = F.regexp_replace(F.col(payload), r"^[^=]*=", "")
    rows = _records(df, _of_market(df, text, "$.data.data"), payload, [day] if day else [])
    rows = rows.withColumn("_p", F.split(F.trim(_part(F.col("_i"), "$", "string")), r"\s+"))
    amount = F.get("_p", 3)
    rows = rows.withColumns({
        "time": F.get("_p", 0), "price": _number(F.get("_p", 1)), "volume": _number(F.get("_p", 2)),
        "amount": F.when(amount.isNull(), 0.0).otherwise(_number(amount)),
    })
    tests = [
        (F.col("_i").isNull(), NO_LIST), (F.coalesce(F.size("_p"), F.lit(0)) < 3, "fewer than three fields"),
        *_no_numbers("price", "volume", "amount")]
    shown = ["time"]
    if day:
        rows = rows.withColumn("kline_time", to_moment(F.concat(F.date_format(to_day(day), "yyyyMMdd"), F.lpad("time", 4, "0"))))
        tests.append((F.col("kline_time").isNull(), "time is no time of a day"))
        shown = ["kline_time"]
    return rows.select(*shown, "price", "volume", "amount", "symbol", "record", _first_reason(*tests).alias("reason"))


def parse_minute_tokens(df: DataFrame, payload: str = "payload", day: str | None = None) -> DataFrame:
    """The ticks of the tokens that can be read, see ``examine_minute_tokens``."""
    return readable(examine_minute_tokens(df, payload, day))


def parse_spot_list(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``data.diff``, an array of numbered fields, to one row per symbol."""
    items = F.from_json(F.col(payload), "data struct<diff:array<map<string,string>>>")["data"]["diff"]
    rows = df.select(F.explode(items).alias("_m"))

    def field(name: str) -> Column:
        return F.try_element_at("_m", F.lit(name))

    code = F.coalesce(field("f12"), F.lit(""))
    market = F.coalesce(field("f13"), F.lit("SH"))
    return rows.select(
        F.concat_ws(".", code, market).alias("symbol"),
        F.coalesce(field("f14"), F.lit("")).alias("name"),
        _number(field("f2")).alias("close"), _number(field("f3")).alias("pct_chg"),
        _number(field("f5")).alias("volume"), _number(field("f6")).alias("amount"),
    )


def text_bars(df: DataFrame) -> DataFrame:
    """All-text bar rows to typed ones, by column name: an empty price is null, an empty
    volume or amount 0."""
    prices = [_number(F.col(c)).alias(c) for c in ("open", "high", "low", "close")]
    counts = [F.coalesce(_number(F.col(c)), F.lit(0.0)).alias(c) for c in ("volume", "amount")]
    return df.select("symbol", without_dashes("date").alias("date"), *prices, *counts)


def text_adjustments(df: DataFrame) -> DataFrame:
    """All-text adjustment factors; an empty one is 1."""
    factor = F.coalesce(_number(F.col("adj_factor")), F.lit(1.0))
    return df.select("symbol", without_dashes("date").alias("date"), factor.alias("adj_factor"))


def localized_bars(df: DataFrame) -> DataFrame:
    """Bars under localized headers, in the stored column order. The code delivered is a
    bare one and gives way to the full symbol of the request."""
    named = df.withColumnsRenamed(LOCALIZED_HEADER)
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")]
    return named.select(
        F.col("symbol").alias("code"), F.col("kline_time").cast("timestamp_ntz").alias("kline_time"),
        *numbers, F.col("volume").try_cast("bigint").alias("volume"),
        F.col("amount").try_cast("double").alias("amount"),
    )


def to_pipeline_bars(df: DataFrame) -> DataFrame:
    """Stored bars (code, kline_time) under the pipeline's names, the date as ``YYYYMMDD``."""
    named = df.withColumnsRenamed({"code": "symbol", "kline_time": "date"})
    return named.withColumn("date", F.date_format("date", "yyyyMMdd"))


def delivered_table(data_type: str) -> str:
    if data_type not in DELIVERED:
        raise ValueError(f"unknown data type {data_type!r}")
    return DELIVERED[data_type]


def read_landed(
    spark: SparkSession, root: str, data_type: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """A landed vendor table by data type; requested fields that exist, codes split."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{delivered_table(data_type)}")
    return split_code(select_existing(df, fields))


def read_landed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Landed text rows with a header, all columns as text, bound by the header's names."""
    df = spark.read.option("header", True).csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*columns)


def read_landed_per_key(spark: SparkSession, root: str, tag: str = "symbol") -> DataFrame:
    """Folders named ``<tag>=<key>`` as one table with the key as a column."""
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{tag}=*")

