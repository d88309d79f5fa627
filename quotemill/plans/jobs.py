"""Compound jobs: a task, a full backfill, the daily update, filling missing days."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import completeness_message, is_trading_day, missing_days, open_days_through, rows_of_missing
from ..operators.columns import (
    apply_transforms, date_column, in_symbols, normalize_names, select_existing, symbol_column, times_as_such, unreadable_times,
)
from ..operators.fallback import Source, fallback_by_key, first_with_rows
from ..operators.quality import duplicates, inventory, last_update, report_of_counts
from ..operators.series import between_dates, in_task_range
from ..operators.sized import cleared_after, settled
from ..operators.validate import clean, is_ok, report, summary_line, with_order
from ..schemas import DATASETS, QUALITY_LIMITS, UPDATE_LOG, Dataset
from ..session import delete_path, scratch_path
from ..sinks.store import log_rows, read_log, upsert, write_series, write_table, write_to_targets
from ..sources.store import (
    in_months, list_tables, read_table, stored_layout, stored_profile, symbol_spans, table_exists, table_path, without_partitions,
)


EXAMINED = ("record", "reason")  # the columns of an examined source, see ``sources.payloads``


def named(df: DataFrame, task: dict) -> DataFrame:
    """Fields, transforms, standard names and symbols of a task, in this order."""
    fields = task.get("fields")
    if fields and set(EXAMINED) <= set(df.columns):
        fields = [*fields, *EXAMINED]
    df = normalize_names(apply_transforms(select_existing(df, fields), task.get("transform")))
    symbol = symbol_column(df)
    return in_symbols(df, task.get("symbols"), symbol) if symbol else df


UNREADABLE = "_unreadable"


def _prepared(df: DataFrame, task: dict, as_of: str | dt.date | None) -> DataFrame:
    """Named rows with times as such, in the date range of the task. Rows of which the record or the time cannot be read are
    flagged, and kept whatever the range."""
    df = named(df, task)
    date = date_column(df)
    flag = F.col("reason").isNotNull() if set(EXAMINED) <= set(df.columns) else F.lit(False)
    if date is None:
        return df.withColumn(UNREADABLE, flag)
    timed = times_as_such(df.withColumn(UNREADABLE, flag | unreadable_times(df)), refuse=False)
    within = in_task_range(
        incremental=task.get("incremental", False), as_of=as_of, lookback_days=task.get("lookback_days", 5),
        start=task.get("start_date"), end=task.get("end_date"), date=date)
    return timed.where(within | F.col(UNREADABLE))


def prepare(df: DataFrame, task: dict, as_of: str | dt.date | None = None) -> DataFrame:
    """Fields, transforms, standard names, symbols, times as such and date range of a task, in this order. Rows whose
    time cannot be read are left out (``run_task`` counts them)."""
    return _readable(_prepared(df, task, as_of))


def _readable(rows: DataFrame) -> DataFrame:
    examined = EXAMINED if set(EXAMINED) <= set(rows.columns) else ()
    return rows.where(~F.col(UNREADABLE)).drop(UNREADABLE, *examined)


def _set_aside(rows: DataFrame, task: dict) -> int:
    """How many rows cannot be read; with a ``rejected`` target of the task they are appended there: symbol, record, reason."""
    bad = rows.where(UNREADABLE)
    target = task.get("rejected")
    if target and not bad.isEmpty():
        symbol = symbol_column(rows)
        reason = F.coalesce("reason", F.lit("time cannot be read")) if "reason" in rows.columns else F.lit("time cannot be read")
        record = F.col("record") if "record" in rows.columns else F.to_json(F.struct(*[c for c in rows.columns if c != UNREADABLE]))
        kept = bad.select(
            (F.col(symbol).cast("string") if symbol else F.lit(None).cast("string")).alias("symbol"), record.alias("record"), reason.alias("reason"))
        write_table(kept, target["root"], target["table"], "append")
    return bad.count()


def run_task(
    task: dict,
    sources: Sequence[tuple[str, Source]],
    as_of: str | dt.date | None = None,
    dry_run: bool = False,
    log_root: str | None = None,
    run_time: str | None = None,
    spark: SparkSession | None = None,
) -> dict:
    """One task: source chain, prepare, validate, completeness, write to every target.

    ``task``: name, fields, transform, symbols (a list, or a frame with them), incremental, lookback_days, start_date,
    end_date, validate, order, completeness, target (a dict or a list: root, table, if_exists, keys,
    order, layout), rejected (root, table). Findings are reported and never hold back the write. Rows whose time cannot be read,
    and of an examined source (``sources.payloads``) records that cannot, are set aside: counted (``unreadable``), and appended to
    ``rejected`` if there is one. A source is run once: its prepared rows go into the shared folder, and are looked at,
    reported, cleaned and written from there; the copies are deleted at the end. With ``log_root`` the run, failed or not, is a record
    of the update log there.
    """
    begun = time.monotonic()
    result = {"task": task["name"], "dry_run": dry_run}
    spark = spark or SparkSession.active()
    copies: list[str] = []

    def copied(rows: DataFrame) -> DataFrame:
        copies.append(scratch_path(spark, "task"))
        rows.write.parquet(copies[-1])
        return spark.read.schema(rows.schema).parquet(copies[-1])

    try:
        unreadable_rows: dict[str, int] = {}

        def loaded(name: str, source: Source) -> Source:
            def load() -> DataFrame:
                rows = copied(_prepared(source() if callable(source) else source, task, as_of))
                unreadable_rows[name] = _set_aside(rows, task)
                return _readable(rows)

            return load

        used, rows = first_with_rows([(name, loaded(name, source)) for name, source in sources])
        findings: list[dict] = []
        if task.get("validate"):
            rules = with_order(task["validate"], task.get("order", ()))
            findings = [r.asDict() for r in report(rows, rules).collect()]  # a row per rule
            rows = copied(clean(rows, rules))
        fetched = rows.count()
        if not fetched:
            raise ValueError(f"{used} has no valid rows")
        message = None
        if task.get("completeness") and date_column(rows):
            found = completeness_message(rows, task["completeness"], date_column(rows))
            message = found.first()["message"]
        targets = task.get("target") or []
        targets = targets if isinstance(targets, list) else [targets]
        written = 0 if dry_run else write_to_targets(rows, targets, fetched, copied=True)
        result |= {
            "status": "ok", "rows_fetched": fetched, "rows_written": written, "source_used": used,
            "validation": summary_line(findings), "valid": is_ok(findings), "issues": findings,
            "completeness": message, "unreadable": unreadable_rows.get(used, 0),
        }
    except Exception as error:  # a failed task is a result like any other
        result |= {"status": "error", "error": f"{type(error).__name__}: {error}", "rows_written": 0}
    result["elapsed"] = round(time.monotonic() - begun, 2)
    if log_root and not dry_run:
        record = task_record(spark, result, run_time or dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S"))
        write_table(record, log_root, "update_log", "append")
    for copy in copies:
        delete_path(spark, copy)
    return result


def task_record(spark: SparkSession, result: dict, run_time: str) -> DataFrame:
    """A run of a task as one record of the update log."""
    fields = {
        "table_name": result["task"], "run_type": "task", "run_date": run_time[:10], "data_date": run_time[:10],
        "source": result.get("source_used"), "status": result["status"], "error_msg": result.get("error"),
        "rows_count": result["rows_written"], "start_time": run_time, "duration_ms": int(result["elapsed"] * 1000),
    }
    return spark.createDataFrame([tuple(fields.get(f.name) for f in UPDATE_LOG.fields)], UPDATE_LOG)


def _landed(spark: SparkSession, landed: str, dataset: Dataset) -> DataFrame:
    df = spark.read.parquet(table_path(landed, dataset.name))
    if dataset.layout != "single" and "symbol" not in df.columns:
        df = df.withColumnRenamed("code", "symbol")
    return df


def backfill(
    spark: SparkSession,
    landed: str,
    root: str,
    run_time: str,
    datasets: dict[str, Dataset] | None = None,
    source: str = "landed",
) -> list[dict]:
    """Write every landed dataset to the store, in order of priority, and log the rows.

    A dataset is a landed folder; per-key deliveries are ``<tag>=<key>`` folders below it,
    which become the tag column. One that fails is logged and the others go on. The log has the rows of this
    delivery, whatever the store had before.
    """
    known = DATASETS if datasets is None else datasets
    present = [d for d in known.values() if table_exists(spark, landed, d.name)]
    results = []
    for dataset in sorted(present, key=lambda d: d.priority):
        try:
            df = _landed(spark, landed, dataset)
            if dataset.layout == "single":
                write_table(df, root, dataset.name)
            else:
                when = "kline_time" if "kline_time" in df.columns else "date"
                write_series(df, root, dataset.name, dataset.layout, time=when)
            records = log_rows(df, dataset.name, "backfill", source, run_time, by_symbol=dataset.layout != "single")
            write_table(records, root, "update_log", "append")
            results.append({"table": dataset.name, "status": "ok"})
        except Exception as error:
            results.append({"table": dataset.name, "status": "error", "error": str(error)})
            row = spark.range(1)
            failed = log_rows(
                row, dataset.name, "backfill", source, run_time, "error", by_symbol=False, error=str(error)
            ).withColumn("rows_count", F.lit(0).cast("bigint"))
            write_table(failed, root, "update_log", "append")
    return results


def update_day(
    spark: SparkSession,
    root: str,
    table: str,
    day: str,
    calendar: DataFrame,
    sources: Sequence[tuple[str, DataFrame]],
    run_time: str,
    order: Sequence[str] = (),
    time: str = "date",
) -> str:
    """Take in one trading day: nothing on a closed day or if the log has the day already.

    For every symbol the first source with rows of that day delivers. Only the partition of
    the day (its year, or its month in a table stored by month) is rewritten. Of rows that
    repeat a key the last by ``order`` stays, then by the other columns. Returns closed,
    current, empty or updated.
    """
    if not is_trading_day(calendar, day):
        return "closed"
    last = last_update(read_log(spark, root).where(F.col("table_name") == table)).first()
    if last is not None and str(last["last_update"])[:10] >= str(day):
        return "current"
    of_day = [(name, between_dates(df, day, day, time)) for name, df in sources]
    with cleared_after(spark):
        rows = fallback_by_key(of_day).drop("source")
        return _take_in(spark, rows, root, table, order, time, "incremental", run_time, day)


def backfill_missing(
    spark: SparkSession,
    root: str,
    table: str,
    calendar: DataFrame,
    sources: Sequence[tuple[str, DataFrame]],
    run_time: str,
    days: int | None = 30,
    as_of: str | None = None,
    order: Sequence[str] = (),
    time: str = "date",
    universe: DataFrame | None = None,
) -> str:
    """Find the open days through ``as_of`` that symbols lack and take them from the first
    source that has them, day by day and symbol by symbol.

    Symbols are those stored, each from its first day on, or those of ``universe``, stored
    or not. With ``days`` only the newest open days are looked at: the store's partitions and the sources' rows
    outside of them are not read. Which symbols there are and since when the store's spans tell, not its bars.
    """
    listed = open_days_through(calendar, days, as_of)
    if not listed:
        return "empty"
    begin, final = listed[0], listed[-1]
    stored = read_table(spark, root, table)
    spans = None if universe is not None else symbol_spans(spark, root, table)
    if spans is None and universe is None:
        spans = stored.groupBy("symbol").agg(F.to_date(F.min(time)).alias("first"), F.to_date(F.max(time)).alias("last"))
    near = without_partitions(between_dates(in_months(stored, begin, final), begin, final, time))
    with cleared_after(spark):
        missing = settled(missing_days(
            near, calendar, date=time, last=days, as_of=as_of, through="table", universe=universe, spans=spans))
        offers = [
            (name, rows_of_missing(missing, between_dates(df, begin, final, time), date=time).withColumn("_day", F.to_date(time)))
            for name, df in sources]
        rows = fallback_by_key(offers, ("symbol", "_day")).drop("source", "_day")
        return _take_in(spark, rows, root, table, order, time, "backfill-missing", run_time, as_of)


def _take_in(
    spark: SparkSession, rows: DataFrame, root: str, table: str, order: Sequence[str], time: str,
    run_type: str, run_time: str, data_date: str | None,
) -> str:
    copy = scratch_path(spark, "rows")
    try:
        rows.write.parquet(copy)
        rows = spark.read.schema(rows.schema).parquet(copy)
        if rows.isEmpty():
            return "empty"
        known = DATASETS.get(table)
        layout = stored_layout(spark, root, table) or (known.layout if known else "year")
        total = [*order, *sorted(c for c in rows.columns if c not in (*order, "symbol", time))]
        upsert(rows, root, table, ("symbol", time), total, layout, time, copied=True)
        records = log_rows(rows, table, run_type, "chain", run_time, data_date=data_date)
        write_table(records, root, "update_log", "append")
    finally:
        delete_path(spark, copy)
    return "updated"


def _each_table(spark: SparkSession, root: str, names: Sequence[str], found: Callable[[str], tuple]) -> tuple[dict, dict]:
    """(what was found, errors) of tables looked at one by one, so that the error of one stays its own."""
    rows, errors = {}, {}
    for name in names:
        try:
            if not table_exists(spark, root, name):
                raise FileNotFoundError("no such table")
            rows[name] = found(name)
        except Exception as error:  # whatever is wrong with a table is a row of the report
            errors[name] = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
    return rows, errors


def quality_of_store(
    spark: SparkSession, root: str, as_of: str | dt.date, limits: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """The quality report of a store: every table that has limits, an error row for one that is absent or cannot be
    read. Rows and days come from the files' footers, duplicates from two columns."""
    limits = QUALITY_LIMITS if limits is None else limits

    def found(name: str) -> tuple:
        rows, first, last = stored_profile(spark, root, name)
        return rows, first, last, duplicates(without_partitions(read_table(spark, root, name)))

    tables, errors = _each_table(spark, root, list(limits), found)
    return report_of_counts(spark, tables, as_of, limits, errors)


def inventory_of_store(spark: SparkSession, root: str) -> DataFrame:
    """Every table of a store with its rows, newest day and size bar, from the files' footers. A table that cannot be read
    has null rows."""
    tables, errors = _each_table(spark, root, list_tables(spark, root), lambda name: stored_profile(spark, root, name))
    found = [(name, *row) for name, row in tables.items()] + [(name, None, None, None) for name in errors]
    return inventory(spark.createDataFrame(found, '`table` string, rows bigint, min_date date, max_date date'))
