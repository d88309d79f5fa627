"""Table profiles, freshness, row floor, duplicates, inventory, and the update log.

One row per table. The tables of a report are unioned after their own aggregation, so
the report itself never has more rows than there are tables.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import to_day
from ..schemas import QUALITY_LIMITS
from .columns import first_date_named


def _stack(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _day(as_of: str | dt.date) -> Column:
    return F.to_date(F.lit(str(as_of)))


def _dates(df: DataFrame) -> list[Column]:
    name = first_date_named(df)
    if name is None:
        none = F.lit(None).cast("date")
        return [none.alias("min_date"), none.alias("max_date")]
    return [to_day(F.min(name)).alias("min_date"), to_day(F.max(name)).alias("max_date")]


def profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, and first and last day of the first column whose name contains "date"."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *_dates(df))
    return counted.select(F.lit(name).alias("table"), "rows", "min_date", "max_date")


def profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([profile(name, df) for name, df in tables.items()])


def duplicate_count(date: str = "date", symbol: str = "symbol") -> Column:
    """Rows less distinct (date, symbol); as text, so that null counts as empty."""
    return F.count(F.lit(1)) - F.count_distinct(
        F.concat_ws("", F.col(date).cast("string"), F.col(symbol).cast("string"))
    )


def freshness(profiled: DataFrame, as_of: str | dt.date, days: int | Column) -> DataFrame:
    """How old the newest day is, and whether that is more than allowed."""
    age = F.datediff(_day(as_of), "max_date")
    return profiled.withColumns({"stale_days": age, "stale": F.coalesce(age > days, F.lit(False))})


def row_floor(profiled: DataFrame, least: int | Column) -> DataFrame:
    return profiled.withColumn("low_rows", F.col("rows") < least)


def check_table(
    name: str, df: DataFrame, least: int, fresh_days: int, as_of: str | dt.date
) -> DataFrame:
    """One row: rows, first and last day, issues, status ok or warn.

    Duplicates are looked for only where columns named date and symbol exist.
    """
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *_dates(df), _duplicates_of(df).alias("dupes"))
    return _judged(counted.withColumn("table", F.lit(name)), F.lit(least), F.lit(fresh_days), as_of)


def _duplicates_of(df: DataFrame) -> Column:
    lower = {c.lower(): c for c in df.columns}
    if "date" in lower and "symbol" in lower:
        return duplicate_count(lower["date"], lower["symbol"])
    return F.lit(0).cast("bigint")


def duplicates(df: DataFrame) -> int:
    """Rows that repeat a (date, symbol); 0 without columns of these names, of which no row is read then."""
    return df.agg(_duplicates_of(df)).first()[0] if {"date", "symbol"} <= {c.lower() for c in df.columns} else 0


def _judged(counted: DataFrame, least: Column, fresh_days: Column, as_of: str | dt.date) -> DataFrame:
    """Issues and status of rows (table, rows, min_date, max_date, dupes)."""
    age = F.datediff(_day(as_of), "max_date")
    text = F.col
    issues = F.array_compact(F.array(
        F.when(age > fresh_days, F.concat(
            F.lit("STALE: "), age.cast("string"), F.lit(" days since "),
            text("max_date").cast("string"), F.lit(", allowed "), fresh_days.cast("string"))),
        F.when(text("rows") < least, F.concat(
            F.lit("LOW_ROWS: "), text("rows").cast("string"), F.lit(" < "), least.cast("string"))),
        F.when(text("dupes") > 0, F.concat(F.lit("DUPLICATES: "), text("dupes").cast("string"))),
    ))
    return counted.select(
        "table", "rows", "min_date", "max_date", issues.alias("issues"),
        F.when(F.size(issues) > 0, "warn").otherwise("ok").alias("status"),
    )


def report_of_counts(
    spark: SparkSession, tables: dict[str, tuple], as_of: str | dt.date, limits: dict[str, tuple[int, int]], errors: dict[str, str],
) -> DataFrame:
    """The quality report from (rows, first day, last day, duplicates) of every table, and the errors of others."""
    counts = spark.createDataFrame(
        [(name, *row, *limits[name]) for name, row in tables.items()],
        "`table` string, rows bigint, min_date date, max_date date, dupes bigint, _least bigint, _days int")
    found = _judged(counts, F.col("_least"), F.col("_days"), as_of)
    return _stack([found, *(unreadable(found, name, error) for name, error in errors.items())])


def unreadable(df_like: DataFrame, name: str, error: str) -> DataFrame:
    """The row of a table that could not be read."""
    row = df_like.sparkSession.range(1)
    none = F.lit(None).cast("date")
    return row.select(
        F.lit(name).alias("table"), F.lit(0).cast("bigint").alias("rows"),
        none.alias("min_date"), none.alias("max_date"),
        F.array(F.lit(f"ERROR: {error}")).alias("issues"), F.lit("error").alias("status"),
    )


def quality_report(
    tables: dict[str, DataFrame],
    as_of: str | dt.date,
    limits: dict[str, tuple[int, int]] | None = None,
    errors: dict[str, str] | None = None,
) -> DataFrame:
    """``check_table`` for every table with limits; ``errors`` are tables that failed to read."""
    limits = QUALITY_LIMITS if limits is None else limits
    rows = [
        check_table(name, df, *limits[name], as_of) for name, df in tables.items() if name in limits
    ]
    if not rows:
        raise ValueError("no table has limits")
    rows += [unreadable(rows[0], name, error) for name, error in (errors or {}).items()]
    return _stack(rows)


def quality_headline(report: DataFrame) -> DataFrame:
    return report.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "warn", "error")])


def alerts(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") != "ok")


def inventory(profiled: DataFrame) -> DataFrame:
    """Every table with its size bar: rows over the mean of all tables, 100 at most.

    The window spans the report, one row a table; a second aggregate would scan the tables
    again.
    """
    mean = F.sum("rows").over(Window.partitionBy()) / F.count(F.lit(1)).over(Window.partitionBy())
    bar = F.least(F.col("rows") / F.greatest(mean, F.lit(1.0)) * 100, F.lit(100.0))
    return profiled.select("table", "rows", "max_date", bar.alias("bar"))


def inventory_headline(profiled: DataFrame) -> DataFrame:
    return profiled.agg(
        F.sum("rows").alias("total_rows"),
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("rows") > 0).alias("nonempty_tables"),
    )


def fetch_metadata(df: DataFrame, date: str = "trade_date") -> DataFrame:
    """What a fetch delivered: rows, column names, first and last date if it has them."""
    spans = [F.min(date).alias("min_date"), F.max(date).alias("max_date")] if date in df.columns else []
    columns = F.lit(",".join(df.columns))
    return df.agg(F.count(F.lit(1)).alias("row_count"), *spans).withColumn("columns", columns)


# -- update log -----------------------------------------------------------------

def last_update(log: DataFrame) -> DataFrame:
    """Newest data date of a successful update, per table."""
    good = log.where(F.col("status") == "ok")
    return good.groupBy("table_name").agg(F.max("data_date").alias("last_update"))


def updated_days(log: DataFrame, as_of: str | dt.date, days: int) -> DataFrame:
    """Distinct data dates with a successful update in the last ``days`` days, per table."""
    first = F.date_sub(_day(as_of), days)
    recent = log.where((F.col("status") == "ok") & (F.col("data_date") >= first))
    return recent.select("table_name", "data_date").distinct()


def run_summary(log: DataFrame, by: str = "data_date", duration: str | None = None) -> DataFrame:
    """Per run: successful and failed updates, rows written, time spent if it was logged."""
    good = F.col("status") == "ok"
    aggs = [
        F.count_if(good).alias("ok"),
        F.count_if(~good).alias("failed"),
        F.coalesce(F.sum(F.when(good, F.col("rows_count"))), F.lit(0)).alias("rows_written"),
    ]
    if duration:
        aggs.append((F.sum(duration) / 1000).alias("seconds"))
    return log.groupBy(by).agg(*aggs)


def rows_by_symbol(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    return df.groupBy(symbol).agg(F.count(F.lit(1)).alias("rows_count"))
