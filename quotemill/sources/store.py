"""Reading stored tables: series partitioned by year or year and month, and single tables.

Filters on time are turned into filters on the partition columns as well, because Spark
does not derive ``year = 2024`` from ``kline_time >= '2024-01-01'`` on plain Parquet.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.scalars import complete_symbol
from ..operators.columns import first_date_named, in_symbols, select_existing
from ..operators.keyed import last_versions, top_n_per_key
from ..operators.series import between_dates, close_matrix_long, last_n_bars
from ..operators.sized import settled
from ..schemas import CODE_INFO, FUND_LIST, SERIES, TABLE_OF_PERIOD, UNIVERSE, UNIVERSE_OF_TYPE, empty
from .commits import APPENDED, SCHEMA, SPANS, TABLE, finish, hadoop, live_files, names_in, read_note

PARTITIONS = ("year", "month")
LAYOUT_PARTITIONS = {"year": ("year",), "month": ("year", "month")}
SINGLE = "part"  # the one partition of a single table; readers do not see it
BUCKET = "key_bucket"  # the partition a key hashes to; readers do not see it either


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    """A stored table exists if its folder has any data file or partition, or appended versions."""
    path = table_path(root, table)
    finish(spark, path)
    return bool(names_in(spark, path) or names_in(spark, f"{path}/{APPENDED}"))


def stored_layout(spark: SparkSession, root: str, table: str) -> str | None:
    """single, year, month or bucket, as the table's folders say; None if nothing is stored."""
    path = table_path(root, table)
    finish(spark, path)
    names = names_in(spark, path)
    years = [n for n in names if n.startswith("year=")]
    if years:
        return "month" if any(n.startswith("month=") for n in names_in(spark, f"{path}/{years[0]}")) else "year"
    if any(n.startswith(f"{BUCKET}=") for n in names):
        return "bucket"
    if names:
        return "single"
    return table_note(spark, path).get("layout") if names_in(spark, f"{path}/{APPENDED}") else None


def table_note(spark: SparkSession, path: str) -> dict:
    """What the table says of itself: layout, buckets, and key and order of its versions."""
    return read_note(spark, f"{path}/{TABLE}") or {}


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema kept beside the table's data, or None for a table written by others."""
    note = read_note(spark, f"{path}/{SCHEMA}")
    return StructType.fromJson(note) if note else None


def stored_base(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All columns that any partition has; null where a partition lacks one. Without appended versions."""
    schema = schema or stored_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def appended_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of appended versions, oldest first."""
    return [f"{path}/{APPENDED}/{name}" for name in sorted(names_in(spark, f"{path}/{APPENDED}"))]


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table: of those that were appended as versions, the last of each key."""
    finish(spark, path)
    base, versions = stored_base(spark, path), appended_versions(spark, path)
    if not versions:
        return base
    note = table_note(spark, path)
    # The key says the partition; naming it lets filters on the partition reach the scan.
    keys = [*note["keys"], *(c for c in (*PARTITIONS, BUCKET, SINGLE) if c in base.columns)]
    return last_versions(base, spark.read.schema(base.schema).parquet(*versions), keys, note["order"])


def list_tables(spark: SparkSession, root: str) -> list[str]:
    fs, path = hadoop(spark, root)
    if not fs.exists(path):
        return []
    found = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    return sorted(n for n in found if not n.startswith((".", "_")))


def read_or_empty(spark: SparkSession, path: str, like: StructType) -> DataFrame:
    """A missing table is an empty one with its columns, never an error."""
    try:
        return stored_rows(spark, path).drop(SINGLE, BUCKET)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty(spark, like)
        raise


def read_table(spark: SparkSession, root: str, table: str, like: StructType = SERIES) -> DataFrame:
    return read_or_empty(spark, table_path(root, table), like)


def read(
    spark: SparkSession,
    root: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Columns that exist, rows that match; all three reach the scan."""
    df = read_table(spark, root, table)
    df = df.where(where) if where is not None else df
    df = select_existing(df, columns) if columns else without_partitions(df)
    return df.limit(limit) if limit else df


def in_months(df: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Keep the partitions that can hold days of [start, end]."""
    first, last = (dt.date.fromisoformat(str(d)[:10]) for d in (start, end))
    if "year" in df.columns:
        df = df.where(F.col("year").between(first.year, last.year))
    if "month" in df.columns:
        slot = F.col("year") * 12 + F.col("month")
        df = df.where(slot.between(first.year * 12 + first.month, last.year * 12 + last.month))
        if first.year == last.year:
            df = df.where(F.col("month").between(first.month, last.month))
    return df


def without_partitions(df: DataFrame) -> DataFrame:
    return df.drop(*PARTITIONS)


def time_column(df: DataFrame) -> str:
    """DATE column of daily tables, timestamp of minute tables."""
    return "kline_time" if "kline_time" in df.columns else "date"


def read_series(
    spark: SparkSession,
    root: str,
    table: str,
    symbols: str | Sequence[str] | DataFrame | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Bars of one, some or all symbols, in an inclusive range of years if one is given.

    One symbol comes back in time order. For many the order by time within each symbol is
    a total sort, which is made only if ``ordered`` asks for it.
    """
    df = read_table(spark, root, table)
    if "year" in df.columns:
        df = df.where(F.col("year") >= start_year) if start_year is not None else df
        df = df.where(F.col("year") <= end_year) if end_year is not None else df
    one = isinstance(symbols, str)
    ordered = one if ordered is None else ordered
    df = without_partitions(in_symbols(df, [symbols] if one else symbols))
    if not ordered:
        return df
    time = time_column(df)
    return df.orderBy(time) if one else df.orderBy("symbol", time)


def read_range(
    spark: SparkSession,
    root: str,
    table: str,
    symbols: Sequence[str] | DataFrame | None,
    start: str | dt.date,
    end: str | dt.date,
) -> DataFrame:
    """Bars of the symbols on the days of [start, end]; symbols without rows are left out."""
    df = in_months(read_table(spark, root, table), start, end)
    df = between_dates(df, start, end, time_column(df))
    return without_partitions(in_symbols(df, symbols))


def read_minutes(
    spark: SparkSession, root: str, day: str | dt.date, symbol: str | None = None, period: str = "1min"
) -> DataFrame:
    """Minute bars of one day. An unknown period means one minute."""
    table = TABLE_OF_PERIOD[period if period in ("1min", "5min") else "1min"]
    return read_range(spark, root, table, [symbol] if symbol else None, day, day)


def read_period(
    spark: SparkSession, root: str, symbols: Sequence[str] | DataFrame | None, period: str = "day"
) -> DataFrame:
    """All stored bars of the symbols at a period; an unknown period has none."""
    if period not in TABLE_OF_PERIOD:
        return empty(spark, SERIES)
    df = read_table(spark, root, TABLE_OF_PERIOD[period])
    return without_partitions(in_symbols(df, symbols))


def stored_periods(spark: SparkSession, root: str, table: str) -> list[tuple[int, ...]]:
    """(year,) or (year, month) of every partition, newest first, from the folder names."""
    path = table_path(root, table)
    finish(spark, path)

    def below(place: str, name: str) -> list[tuple[int, str]]:
        values = [(n.split("=", 1)[1], f"{place}/{n}") for n in names_in(spark, place) if n.startswith(f"{name}=")]
        return [(int(v), p) for v, p in values if v.isdigit()]

    periods = []
    for year, place in below(path, "year"):
        months = below(place, "month")
        periods += [(year, month) for month, _ in months] if months else [(year,)]
    versions = appended_versions(spark, path)
    if versions:
        names = [c for c in PARTITIONS if c in LAYOUT_PARTITIONS.get(table_note(spark, path)["layout"], ())]
        rows = spark.read.schema(stored_schema(spark, path)).parquet(*versions) if names else None
        if rows is not None:  # a row a period
            periods += [tuple(r) for r in rows.select(*names).distinct().collect() if None not in r]
    return sorted(set(periods), reverse=True)


def in_periods(df: DataFrame, periods: Sequence[tuple[int, ...]]) -> DataFrame:
    """The rows of the listed partitions; only these are read."""
    years: dict[int, list[int]] = {}
    for year, *month in periods:
        years.setdefault(year, []).extend(month)
    tests = [(F.col("year") == y) & (F.col("month").isin(m) if m else F.lit(True)) for y, m in years.items()]
    return df.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


def _relative(uri: Column, depth: int) -> Column:
    """The last parts of a file's URI: its partition folders and its name."""
    return F.concat_ws("/", F.slice(F.split(uri, "/"), -depth, depth))


def span_columns(symbol: str, time: str, depth: int) -> tuple[list[Column], list[Column]]:
    """(keys, aggregates) of a table's spans: every symbol of every file with its first and last time and its rows."""
    keys = [_relative(F.col("_metadata.file_path"), depth).alias("file"), F.col(symbol).alias("symbol")]
    return keys, [F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("rows")]


def symbol_spans(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """(symbol, first, last, rows) of a series from the spans that its writes have kept, without reading a bar.

    None for a table that has files without spans, such as one written by others.
    """
    path = table_path(root, table)
    finish(spark, path)
    kept, files, schema = names_in(spark, f"{path}/{SPANS}"), live_files(spark, path), stored_schema(spark, path)
    layout = stored_layout(spark, root, table)
    if not kept or not files or schema is None or layout not in ("year", "month"):
        return None
    time = "kline_time" if "kline_time" in schema.names else "date"
    note = table_note(spark, path)
    symbol, time = note.get("symbol") or "symbol", note.get("time") or time
    if symbol not in schema.names or time not in schema.names:
        return None
    kind = schema[time].dataType
    spans = spark.read.schema(StructType([
        StructField("file", StringType()), StructField("symbol", schema[symbol].dataType), StructField("first", kind),
        StructField("last", kind), StructField("rows", LongType())])).parquet(*[f"{path}/{SPANS}/{n}" for n in kept])
    depth = 2 if layout == "year" else 3
    live = spark.createDataFrame([("/".join(f.split("/")[-depth:]),) for f in files], "file string")
    spans = spans.join(live, "file", "left_semi")
    if spans.select("file").distinct().count() != len(files):
        return None
    parts = [spans.select("symbol", "first", "last", "rows")]
    versions = appended_versions(spark, path)
    if versions:
        rows = spark.read.schema(schema).parquet(*versions)
        parts.append(rows.groupBy(F.col(symbol).alias("symbol")).agg(
            F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, parts).groupBy("symbol").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))


def _reading_footers(spark: SparkSession) -> SparkSession:
    """A session whose Parquet scans answer counts, least and greatest from the footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def profile_scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(rows, min_date, max_date) of a stored table as one row. Without appended versions the scan is Spark's
    version 2 Parquet source, to which Catalyst pushes the aggregates."""
    path = table_path(root, table)
    finish(spark, path)
    schema = stored_schema(spark, path)
    if schema is None or appended_versions(spark, path):
        df = read_table(spark, root, table)
    else:
        df = _reading_footers(spark).read.schema(schema).parquet(path).drop(SINGLE, BUCKET)
    date = first_date_named(df)
    ends = [F.min(date).alias("min_date"), F.max(date).alias("max_date")] if date else []
    return df.agg(F.count(F.lit(1)).alias("rows"), *ends)


def stored_profile(spark: SparkSession, root: str, table: str) -> tuple[int, dt.date | None, dt.date | None]:
    """Rows, and first and last day of the first column whose name contains "date"."""
    found = profile_scan(spark, root, table).first()
    days = [_as_day(found[c]) if c in found else None for c in ("min_date", "max_date")]
    return found["rows"], *days


def _as_day(value) -> dt.date | None:
    """A day from a date, a timestamp, or text or a number as ``to_day`` reads them."""
    if value is None or type(value) is dt.date:
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    text = str(value).strip()
    for part, form in ((text[:10], "%Y-%m-%d"), (text, "%Y%m%d")):
        try:
            return dt.datetime.strptime(part, form).date()
        except ValueError:
            continue
    return None


def _newest_first(periods: list[tuple[int, ...]]):
    """Runs of partitions, newest first, each twice as long as the one before."""
    begin, length = 0, 1
    while begin < len(periods):
        yield periods[begin:begin + length]
        begin, length = begin + length, 2 * length


def newest_bars(
    spark: SparkSession, root: str, table: str, n: int = 250, symbols: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """The newest ``n`` bars of every symbol (or the listed ones, bare codes completed), with percent change.

    Which symbols there are the spans of the table's files tell. The newest partitions are read first; older ones are
    read only for symbols that have fewer than ``n`` bars so far, until all have them or nothing is left.
    """
    df = read_table(spark, root, table)
    time = time_column(df)
    if symbols is None:
        spans = symbol_spans(spark, root, table)
        lacking = (df if spans is None else spans).select("symbol").distinct()
    elif isinstance(symbols, DataFrame):
        lacking = symbols.select(complete_symbol("symbol").alias("symbol")).distinct()
    else:
        lacking = spark.createDataFrame([(s,) for s in symbols], "symbol string").select(
            complete_symbol("symbol").alias("symbol")).distinct()
    lacking = settled(lacking)
    periods = stored_periods(spark, root, table)
    parts = []
    for run in _newest_first(periods):
        rows = in_periods(df, run).join(lacking, "symbol", "left_semi")
        parts.append(settled(top_n_per_key(rows, ["symbol"], [F.col(time).desc()], n)))
        found = reduce(DataFrame.unionByName, parts)
        counts = found.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n)
        lacking = settled(lacking.join(counts, "symbol", "left_anti"))
        if lacking.isEmpty():
            break
    found = reduce(DataFrame.unionByName, parts) if parts else df
    return without_partitions(last_n_bars(found, n, time=time))


def newest_closes(
    spark: SparkSession, root: str, table: str, days: int = 60, symbols: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """(date, symbol, close) of the newest ``days`` days the table has, from the partitions that hold them;
    a table without partitions by year is read as a whole."""
    df = read_table(spark, root, table)
    time = time_column(df)
    day = F.to_date(time).alias("date")
    read: list[tuple[int, ...]] = []
    for run in _newest_first(stored_periods(spark, root, table)):
        read += run
        if in_periods(df, read).select(day).distinct().limit(days).count() >= days:
            break
    rows = (in_periods(df, read) if read else df).select(day, "symbol", "close")
    return close_matrix_long(in_symbols(rows, symbols), days)


def code_list(spark: SparkSession, root: str, security_type: str = "EXTRA_ETF") -> DataFrame:
    """The codes of a security type, as a frame to semi-join with."""
    if security_type not in UNIVERSE_OF_TYPE:
        return empty(spark, UNIVERSE).select("code")
    return read_table(spark, root, UNIVERSE_OF_TYPE[security_type], UNIVERSE).select("code")


def code_info(
    spark: SparkSession, root: str, symbols: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    return in_symbols(read_table(spark, root, "code_info", CODE_INFO), symbols, "code")


def fund_list(spark: SparkSession, root: str) -> DataFrame:
    df = read_table(spark, root, "etf_universe", FUND_LIST)
    return df if "symbol" in df.columns else df.withColumnRenamed("code", "symbol")
