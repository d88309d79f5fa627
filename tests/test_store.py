"""Sinks, reading back, jobs and the stream."""

import datetime as dt
import json
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotemill.plans import jobs
from quotemill.session import scratch_root
from quotemill.sinks import database, store as sink
from quotemill.sources import store
from quotemill.streaming.incremental import upsert_stream

BAR = "symbol string, date date, close double, seq int"
DAY = dt.date(2023, 12, 30)


def day(n):
    return DAY + dt.timedelta(days=n)


def bars(spark, *values):
    return spark.createDataFrame([(s, day(n), float(v), i) for i, (s, n, v) in enumerate(values)], BAR)


def stored(spark, root, table="t"):
    df = store.without_partitions(store.read_table(spark, root, table))
    return sorted((r["symbol"], (r["date"] - DAY).days, r["close"]) for r in df.collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def files(root, table, part):
    return {p.name for p in Path(root, table, part).glob("*.parquet")}


def test_year_is_taken_from_each_row_and_other_years_stay(spark, root):
    sink.write_series(bars(spark, ("a", 0, 1), ("a", 5, 2), ("b", 0, 3)), root, "t", time="date")
    assert {p.name for p in Path(root, "t").glob("year=*")} == {"year=2023", "year=2024"}
    before = files(root, "t", "year=2023")
    sink.write_series(bars(spark, ("c", 6, 9)), root, "t", time="date")
    assert stored(spark, root) == [("a", 0, 1.0), ("a", 5, 2.0), ("b", 0, 3.0), ("c", 6, 9.0)]
    assert files(root, "t", "year=2023") == before
    assert all("zstd" in f for f in before)


def test_copies_of_one_row_are_written_by_several_tasks(spark, root):
    copies = spark.range(0, 40000, 1, 8).select(
        F.lit("hot").alias("symbol"), F.lit(day(0)).alias("date"), F.lit(1.0).alias("close")
    )
    sink.write_series(copies, root, "t", time="date", partitions=8)
    sizes = [spark.read.parquet(f"{root}/t/year=2023/{f}").count() for f in files(root, "t", "year=2023")]
    assert sum(sizes) == 40000 and len(sizes) >= 4 and max(sizes) < 20000


def test_upsert_rewrites_touched_partitions_only_and_is_idempotent(spark, root):
    keys, order = ["symbol", "date"], ["seq"]
    sink.upsert(bars(spark, ("a", 0, 1), ("a", 5, 2), ("a", 5, 3)), root, "t", keys, order, "year")
    assert stored(spark, root) == [("a", 0, 1.0), ("a", 5, 3.0)]
    untouched = files(root, "t", "year=2023")
    batch = bars(spark, ("a", 5, 7), ("a", 6, 8), ("a", 5, 9))
    for _ in range(2):
        sink.upsert(batch, root, "t", keys, order, "year")
        assert stored(spark, root) == [("a", 0, 1.0), ("a", 5, 9.0), ("a", 6, 8.0)]
    assert files(root, "t", "year=2023") == untouched
    with pytest.raises(ValueError):
        sink.upsert(batch, root, "t", ["symbol"], order, "year")


def test_write_modes_of_a_partitioned_table(spark, root):
    sink.write(bars(spark, ("a", 3, 1), ("b", 3, 2)), root, "t", layout="year")
    sink.write(bars(spark, ("a", 3, 5)), root, "t", layout="year")
    assert stored(spark, root) == [("a", 3, 1.0), ("a", 3, 5.0), ("b", 3, 2.0)]
    # the other symbol of the year stays
    sink.write(bars(spark, ("a", 4, 6)), root, "t", "replace", layout="year")
    assert stored(spark, root) == [("a", 4, 6.0), ("b", 3, 2.0)]
    with pytest.raises(FileExistsError):
        sink.write(bars(spark, ("b", 9, 1)), root, "t", "fail", layout="year")
    sink.write(bars(spark, ("b", 0, 1), ("c", 9, 1)), root, "t", "fail", layout="year")
    assert len(stored(spark, root)) == 4
    sink.write(bars(spark, ("c", 9, 4)), root, "t", keys=["symbol", "date"], order=["seq"], layout="year")
    assert ("c", 9, 4.0) in stored(spark, root) and len(stored(spark, root)) == 4
    with pytest.raises(ValueError):
        sink.write(bars(spark, ("c", 9, 4)), root, "t", keys=["symbol"], layout="year")
    with pytest.raises(ValueError):
        sink.write(bars(spark, ("c", 9, 4)), root, "t", "merge")


def test_write_modes_of_a_single_table(spark, root):
    one = spark.createDataFrame([("a", 1)], "symbol string, v int")
    sink.write(one, root, "t", "fail")
    with pytest.raises(FileExistsError):
        sink.write(one, root, "t", "fail")
    sink.write(one, root, "t")
    assert store.read_table(spark, root, "t").count() == 2
    sink.write(one, root, "t", "replace")
    assert store.read_table(spark, root, "t").count() == 1
    sink.write(one.withColumn("v", F.lit(7)), root, "t", keys=["symbol"], order=["v"])
    assert [tuple(r) for r in store.read_table(spark, root, "t").collect()] == [("a", 7)]


def test_several_targets_get_the_same_rows(spark, root):
    df = bars(spark, ("a", 0, 1), ("b", 3, 2)).withColumn("noise", F.rand())
    targets = [{"root": root, "table": "x", "layout": "year"}, {"root": root, "table": "y"}]
    assert sink.write_to_targets(df, targets) == 4
    noise = [sorted(r["noise"] for r in store.read_table(spark, root, t).collect()) for t in "xy"]
    assert noise[0] == noise[1]


def test_missing_tables_are_empty_with_their_columns(spark, root):
    assert store.read_series(spark, root, "t", "a").columns[:2] == ["symbol", "kline_time"]
    assert store.fund_list(spark, root).columns == ["symbol", "name", "type"]
    assert store.code_info(spark, root, ["a"]).isEmpty()
    assert store.code_list(spark, root, "weather").columns == ["code"]
    assert store.read_period(spark, root, None, "hour").isEmpty()
    assert store.read_minutes(spark, root, "2024-01-01").isEmpty()
    assert not store.table_exists(spark, root, "t") and store.list_tables(spark, root) == []
    sink.write_table(bars(spark, ("a", 0, 1)), root, "t")
    assert store.table_exists(spark, root, "t") and store.list_tables(spark, root) == ["t"]


def test_months_across_a_year_end(spark, root):
    at = "CAST(date AS TIMESTAMP_NTZ) AS kline_time"
    df = bars(spark, *[("a", n, n) for n in range(-40, 80)]).selectExpr("symbol", at, "close")
    sink.write_series(df, root, "etf_min1", "month")
    got = store.read_range(spark, root, "etf_min1", ["a"], "2023-12-30", "2024-02-02")
    assert got.columns == ["symbol", "kline_time", "close"]
    assert sorted(r["close"] for r in got.collect()) == [float(n) for n in range(35)]
    assert [r["close"] for r in store.read_minutes(spark, root, "2024-01-01").collect()] == [2.0]


def test_one_symbol_comes_in_time_order(spark, root):
    sink.write_series(bars(spark, ("a", 5, 2), ("a", 0, 1), ("b", 0, 3), ("a", 400, 4)), root, "t", time="date")
    assert [r["close"] for r in store.read_series(spark, root, "t", "a", 2023, 2024).collect()] == [1.0, 2.0]


def test_update_log(spark, root):
    sink.log_update(bars(spark, ("a", 0, 1), ("a", 1, 1), ("b", 0, 1)), root, "t", "backfill", "x", "2024-01-05 10:00:00")
    sink.log_update(bars(spark, ("a", 0, 1)), root, "t", "daily", "x", "2024-01-06 10:00:00", status="error",
                    data_date="2024-01-04", by_symbol=False, error="late")
    got = sorted((r["symbol"] or "", r["rows_count"], r["data_date"], r["status"]) for r in sink.read_log(spark, root).collect())
    assert got == [("", 1, "2024-01-04", "error"), ("a", 2, "2024-01-05", "ok"), ("b", 1, "2024-01-05", "ok")]
    assert sink.read_log(spark, root + "-none").isEmpty()


def test_json_records_keep_nulls_and_iso_dates(spark, tmp_path):
    df = spark.sql("SELECT date'2024-01-05' d, timestamp_ntz'2024-01-05 10:00:00' t, CAST(null AS INT) n, 1.5d x")
    want = {"d": "2024-01-05", "t": "2024-01-05T10:00:00", "n": None, "x": 1.5}
    assert json.loads(sink.json_records(df).first()[0]) == want
    sink.write_json(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in Path(tmp_path, "out").glob("part-*"))
    assert json.loads(text) == want
    assert sink.json_records(df.limit(0)).isEmpty()


def test_database_types_and_statement(spark):
    df = spark.createDataFrame(
        [("20240105", "abc", "2024x", 1, 1.5, None), (None, "abcde", "20240105", 2, float("nan"), None)],
        "trade_date string, name string, end_date string, n bigint, x double, nothing string",
    )
    types = {r["column"]: r["type"] for r in database.database_types(df).collect()}
    assert types == {
        "trade_date": "DATETIME2", "name": "NVARCHAR(10)", "end_date": "NVARCHAR(16)", "n": "BIGINT",
        "x": "FLOAT", "nothing": "NVARCHAR(255)",
    }
    text = database.create_statement(df.select("n", "name"), "t", ["n"])
    assert text == "CREATE TABLE t (\n  n BIGINT NOT NULL,\n  name NVARCHAR(10) NULL,\n  CONSTRAINT PK_t PRIMARY KEY (n)\n)"
    assert [r["x"] for r in database.nan_to_null(df).orderBy("n").collect()] == [1.5, None]
    assert database.text_profile(df.select("n")).isEmpty()


def test_plain_parquet_refuses_merge(spark):
    with pytest.raises(Exception):
        database.merge_into(bars(spark, ("a", 0, 1)), "no_such_table", ["symbol"], ["seq"])


# -- jobs ------------------------------------------------------------------------

def task(root, **more):
    return {
        "name": "daily", "validate": {"required": ["symbol"], "dedup_keys": ["symbol", "date"]}, "order": ["seq"],
        "target": {"root": root, "table": "t", "layout": "year"}, **more,
    }


def test_task_takes_the_first_usable_source(spark, root):
    good = bars(spark, ("a", 0, 1), ("a", 0, 2), ("b", 5, 3)).withColumnRenamed("symbol", "ts_code")

    def broken():
        raise OSError("gone")

    result = jobs.run_task(task(root, completeness={"check_gaps": True}), [("x", broken), ("y", good.limit(0)), ("z", good)])
    assert result["status"] == "ok" and result["source_used"] == "z" and result["valid"]
    assert (result["rows_fetched"], result["rows_written"]) == (2, 2)
    assert "dedup" in result["validation"] and result["completeness"] == "missing 2 trading days"
    assert stored(spark, root) == [("a", 0, 2.0), ("b", 5, 3.0)]


def test_task_dry_run_range_and_failure(spark, root):
    df = bars(spark, *[("a", n, n) for n in range(10)])
    dry = jobs.run_task(task(root), [("x", df)], dry_run=True)
    assert (dry["rows_fetched"], dry["rows_written"]) == (10, 0) and not store.table_exists(spark, root, "t")
    recent = task(root, incremental=True, lookback_days=2, target=[
        {"root": root, "table": "t", "layout": "year"}, {"root": root, "table": "u"}])
    assert jobs.run_task(recent, [("x", df)], as_of=day(8))["rows_written"] == 6
    assert stored(spark, root) == [("a", n, float(n)) for n in (6, 7, 8)]
    none = jobs.run_task(task(root, start_date="2030-01-01"), [("x", df)])
    assert none["status"] == "error" and "empty" in none["error"] and none["rows_written"] == 0
    unchecked = jobs.run_task({"name": "u", "fields": ["symbol", "nothing"]}, [("x", df)])
    assert unchecked["status"] == "ok" and unchecked["rows_written"] == 0


def calendar_of(spark):
    return spark.createDataFrame(
        [(day(n).strftime("%Y%m%d"), "1" if day(n).weekday() < 5 else "0") for n in range(20)],
        "date string, is_open string",
    )


def test_daily_update_runs_once_a_trading_day(spark, root):
    sink.write_series(bars(spark, ("a", 2, 1), ("b", 2, 1)), root, "t", time="date")
    chain = [("x", bars(spark, ("a", 3, 5), ("a", 4, 9))), ("y", bars(spark, ("a", 3, 6), ("b", 3, 7)))]

    def run(n):
        return jobs.update_day(spark, root, "t", str(day(n)), calendar_of(spark), chain, f"{day(n)} 18:00:00")

    assert [run(1), run(3), run(3), run(5)] == ["closed", "updated", "current", "empty"]
    assert stored(spark, root) == [("a", 2, 1.0), ("a", 3, 5.0), ("b", 2, 1.0), ("b", 3, 7.0)]
    assert sink.read_log(spark, root).count() == 2


def test_missing_days_are_filled_from_the_chain(spark, root):
    sink.write_series(bars(spark, ("a", 2, 1), ("a", 6, 1), ("b", 2, 1)), root, "t", time="date")
    chain = [("x", bars(spark, ("a", 3, 5), ("b", 3, 5))), ("y", bars(spark, ("a", 3, 6), ("a", 4, 7), ("a", 10, 7)))]
    args = (spark, root, "t", calendar_of(spark), chain, "2024-01-20 18:00:00")
    assert jobs.backfill_missing(*args, days=None) == "updated"
    assert stored(spark, root) == [("a", 2, 1.0), ("a", 3, 5.0), ("a", 4, 7.0), ("a", 6, 1.0), ("b", 2, 1.0), ("b", 3, 5.0)]
    assert jobs.backfill_missing(*args, days=None) == "empty"
    newest = jobs.backfill_missing(*args, days=None, as_of=str(day(10)))  # days after the last row are missing as well
    assert newest == "updated" and ("a", 10, 7.0) in stored(spark, root)
    universe = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    late = [("x", bars(spark, ("c", 4, 2)))]
    assert jobs.backfill_missing(spark, root, "t", calendar_of(spark), late, "2024-01-20 18:00:00", as_of=str(day(10)), universe=universe) == "updated"
    assert ("c", 4, 2.0) in stored(spark, root)


def test_backfill_goes_on_after_a_failure(spark, root, tmp_path):
    landed = str(tmp_path / "landed")
    spark.createDataFrame([("a",)], "code string").write.parquet(f"{landed}/etf_universe")
    spark.createDataFrame([("a",)], "symbol string").write.parquet(f"{landed}/etf_daily")  # no time column
    spark.createDataFrame([("a", 1.0), ("b", 2.0)], "code string, nav double").write.partitionBy("code").parquet(f"{landed}/etf_nav")
    got = {r["table"]: r["status"] for r in jobs.backfill(spark, landed, root, "2024-01-05 18:00:00")}
    assert got == {"etf_universe": "ok", "etf_daily": "error", "etf_nav": "ok"}
    log = {r["table_name"]: (r["status"], r["rows_count"]) for r in sink.read_log(spark, root).collect()}
    assert log == {"etf_universe": ("ok", 1), "etf_daily": ("error", 0), "etf_nav": ("ok", 2)}
    assert store.read_table(spark, root, "etf_nav").where("code = 'b'").count() == 1


# -- stream ----------------------------------------------------------------------

def test_stream_ignores_redelivery_and_late_old_files(spark, root, tmp_path):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    schema = bars(spark, ("a", 0, 0)).schema

    def arrive(seq, *values):
        bars(spark, *values).withColumn("seq", F.lit(seq)).write.mode("append").parquet(landing)
        upsert_stream(
            spark, landing, schema, root, "t", ["symbol", "date"], ["seq"], progress, "year",
            validate={"ranges": {"close": (0, None)}}, files_per_batch=1,
        ).awaitTermination()
        return stored(spark, root)

    assert arrive(5, ("a", 0, 1), ("b", 3, 2)) == [("a", 0, 1.0), ("b", 3, 2.0)]
    assert arrive(5, ("a", 0, 1)) == [("a", 0, 1.0), ("b", 3, 2.0)]
    assert arrive(4, ("a", 0, 9), ("c", 0, 9)) == [("a", 0, 1.0), ("b", 3, 2.0), ("c", 0, 9.0)]
    assert arrive(6, ("a", 0, 7)) == [("a", 0, 7.0), ("b", 3, 2.0), ("c", 0, 9.0)]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


# -- losing nothing ----------------------------------------------------------------

def test_a_table_keeps_its_layout(spark, root):
    sink.write_series(bars(spark, ("a", 2, 1)), root, "t", "month", time="date")
    assert store.stored_layout(spark, root, "t") == "month"
    for write in (lambda: sink.write_series(bars(spark, ("a", 3, 1)), root, "t", "year", time="date"),
                  lambda: sink.write_table(bars(spark, ("a", 3, 1)), root, "t"),
                  lambda: sink.upsert(bars(spark, ("a", 3, 1)), root, "t", ["symbol", "date"], ["close"], "year")):
        with pytest.raises(ValueError, match="stored by month"):
            write()
    assert stored(spark, root) == [("a", 2, 1.0)]


def test_daily_update_takes_the_layout_of_the_table(spark, root):
    sink.write_series(bars(spark, ("a", 2, 1)), root, "t", "month", time="date")
    done = jobs.update_day(spark, root, "t", str(day(3)), calendar_of(spark), [("x", bars(spark, ("a", 3, 5), ("a", 3, 4)))], "2024-01-04 18:00:00")
    assert done == "updated" and stored(spark, root) == [("a", 2, 1.0), ("a", 3, 5.0)]


def test_scratch_is_empty_after_writes(spark, root, tmp_path):
    from quotemill.session import scratch_root
    from pathlib import Path

    folder = Path(scratch_root(spark).removeprefix("file:"))

    def copies():
        return {p.name for p in folder.iterdir() if p.name.split("-")[0] in ("batch", "targets", "task", "rows", "settled")}

    before = copies()
    sink.write_series(bars(spark, ("a", 2, 1)), root, "d", time="date")
    jobs.update_day(spark, root, "d", str(day(3)), calendar_of(spark), [("x", bars(spark, ("a", 3, 5)))], f"{day(3)} 18:00:00")
    jobs.backfill_missing(spark, root, "d", calendar_of(spark), [("x", bars(spark, ("a", 4, 5)))], "2024-01-20 18:00:00", as_of=str(day(5)))
    assert copies() == before
    sink.upsert(bars(spark, ("a", 2, 1)), root, "t", ["symbol", "date"], ["close"], "year")
    sink.upsert(bars(spark, ("a", 3, 1)), root, "t", ["symbol", "date"], ["close"], "year")
    targets = [{"root": root, "table": n, "layout": "year"} for n in ("u", "v")]
    assert jobs.run_task({"name": "x", "target": targets}, [("s", bars(spark, ("a", 2, 1)))])["rows_written"] == 2
    assert copies() == before


def test_text_days_become_dates(spark, root):
    text = spark.createDataFrame([("a", "20240103", 1.0), ("a", "2024-01-04", 2.0)], "symbol string, date string, close double")
    task = {"name": "t", "start_date": "2024-01-04", "target": {"root": root, "table": "t", "layout": "year"}}
    assert jobs.run_task(task, [("s", text)])["status"] == "ok"
    sink.write(text, root, "u", layout="year")
    read = lambda t: sorted((r.date.isoformat(), r.close) for r in store.read_series(spark, root, t).collect())
    assert read("t") == [("2024-01-04", 2.0)] and read("u") == [("2024-01-03", 1.0), ("2024-01-04", 2.0)]


def test_unbounded_reads_return_every_year(spark, root):
    old = bars(spark, ("a", 2, 1)).withColumn("date", F.add_months("date", -12 * 40))
    sink.write_series(old.unionByName(bars(spark, ("a", 2, 1))), root, "t", time="date")
    assert store.read_series(spark, root, "t").count() == 2


def test_store_reads_list_the_newest_partitions_only(spark, root):
    years = [bars(spark, *[("a", d, d) for d in range(6)]).withColumn("date", F.add_months("date", -12 * y)) for y in range(6)]
    sink.write_series(reduce(lambda x, y: x.unionByName(y), years), root, "t", time="date")
    rows = store.in_periods(store.read_table(spark, root, "t"), store.stored_periods(spark, root, "t")[:1])
    assert "year#" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    assert store.newest_bars(spark, root, "t", 3).count() == 3
    assert store.newest_bars(spark, root, "t", 20, ["a", "zz"]).count() == 0  # bare codes are completed
    assert store.newest_closes(spark, root, "t", 8).count() == 8


@pytest.mark.parametrize("layout", ["single", "bucket"])
def test_newest_closes_of_a_table_without_years(spark, root, layout):
    rows = bars(spark, *[(s, d, d) for s in "ab" for d in range(6)])
    sink.upsert(rows, root, "t", ["symbol", "date"], ["date"], layout)
    got = store.newest_closes(spark, root, "t", 4)
    assert got.count() == 8 and got.select("date").distinct().count() == 4
    assert store.newest_closes(spark, root, "t", 4, ["zz"]).count() == 0


def test_an_upsert_rewrites_the_buckets_of_its_keys_only(spark, root):
    rows = spark.range(500).select(F.concat(F.lit("s"), "id").alias("symbol"), F.col("id").alias("seq"), F.lit(1.0).alias("close"))
    sink.upsert(rows, root, "t", ["symbol"], ["seq"], "bucket", buckets=40)
    before = {p.name for p in Path(root, "t").rglob("*.parquet")}
    assert len(list(Path(root, "t").glob("key_bucket=*"))) == 40
    batch = spark.createDataFrame([("s7", 900, 2.0), (None, 901, 3.0), (None, 902, 4.0)], "symbol string, seq long, close double")
    sink.upsert(batch, root, "t", ["symbol"], ["seq"], "bucket")
    after = {p.name for p in Path(root, "t").rglob("*.parquet")}
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    got = {r.symbol: r.close for r in store.read_table(spark, root, "t").collect()}
    assert len(got) == 501 and (got["s7"], got[None], got["s8"]) == (2.0, 4.0, 1.0)
    assert store.read_table(spark, root, "t").columns == ["symbol", "seq", "close"]
    with pytest.raises(TypeError, match="stored as"):  # another type would hash to another bucket
        sink.upsert(batch.withColumn("symbol", F.lit(7)), root, "t", ["symbol"], ["seq"], "bucket")
