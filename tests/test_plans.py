"""The shape of plans: what reaches the scan, what happens before a shuffle, how many shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from quotemill.operators import calendar, compare, fallback, holdings, keyed, series, validate
from quotemill.plans.fixtures import Tables
from quotemill.plans.queries import CATALOGUE
from quotemill.sinks import store as sink
from quotemill.sources import store


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan_of(df)))


@pytest.fixture(scope="module")
def bars(spark):
    """Bars with nothing in front of them, so that counts are those of the operator."""
    path = sink.scratch_path(spark, "bars")
    rows = spark.range(1000).select(
        F.concat(F.lit("S"), (F.col("id") % 10).cast("string")).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 10).cast("int")).alias("date"),
        *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close", "amount")],
        F.col("id").alias("volume"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_ranked_keys_are_cut_before_the_shuffle(bars):
    for df in (
        keyed.keep_last(bars, ["symbol", "date"], ["volume"]),
        keyed.keep_one(bars, ["symbol"], ["date"], "first"),
        series.last_n_bars(bars, 250),
        keyed.merge_by_version(bars, bars, ["symbol", "date"], ["volume"]),
        holdings.top_holdings(bars.selectExpr("symbol fund_code", "string(date) symbol", "close stk_mkv_ratio")),
        fallback.fallback_by_key([("a", bars), ("b", bars)], ("symbol", "date"), unique=True),
    ):
        plan = plan_of(df)
        partial = plan.rindex("Partial")
        assert "WindowGroupLimit" in plan
        assert "Exchange hashpartitioning" in plan[:partial], plan
        assert shuffles(df) == 1


def test_large_n_ranks_within_slices_of_the_input_first(bars):
    plan = keyed.top_n_per_key(bars, ["symbol"], [F.col("date").desc()], 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") == 2 and "hashpartitioning(symbol" in plan and "_slice" in plan


def test_sliced_top_n_ranks_within_slices_first(bars):
    sliced = keyed.top_n_per_key(bars, ["symbol"], [F.col("date").desc()], 3, slices=4)
    plain = keyed.top_n_per_key(bars, ["symbol"], [F.col("date").desc()], 3)
    assert sliced.columns == bars.columns
    assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()
    assert "_slice" in plan_of(sliced)


def test_percent_change_never_groups_a_whole_series(bars):
    plan = plan_of(series.pct_change(bars, span="month"))
    over_bars = [line for line in plan.splitlines() if "Window [" in line and "close" in line]
    assert over_bars and all(re.search(r"\], \[symbol#\d+, _span#\d+\]", line) for line in over_bars)
    # by (symbol, span): the bars once, and twice the table of one row a span
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _span#\d+, \d+\)", plan)) == 3


def test_comparison_of_three_sources_moves_the_bars_once(bars):
    df = compare.source_differences([("a", bars), ("b", bars), ("c", bars)])
    plan = plan_of(df)
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, date#\d+, \d+\)", plan)) == 1
    assert "Join" in plan


def test_aggregates_have_map_side_partials(bars):
    spec = validate.Rules(unique=("symbol", "date"), order=("volume",), ranges={"close": (0, None)})
    for df in (
        validate.report(bars, spec), calendar.completeness(bars), series.close_matrix(bars, ["S0", "S1"]),
    ):
        assert "partial_" in plan_of(df)


def test_newest_days_are_a_filter_not_a_join(bars):
    plan = full_plan(series.close_matrix_long(bars, 5))
    assert "Join" not in plan
    assert "Subquery" in plan
    assert "ReadSchema: struct<symbol:string,date:date,close:double>" in plan


def test_calendar_is_broadcast_and_bars_stay_put(bars):
    days = bars.select("date", F.lit("1").alias("is_open"))
    plan = plan_of(calendar.on_trading_days(bars, days))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning(symbol" not in plan


def test_partitions_columns_and_filters_reach_the_scan(spark, bars):
    root = sink.scratch_path(spark, "pruned")
    sink.write_series(bars, root, "etf_daily", "year", time="date")
    one = store.read_series(spark, root, "etf_daily", "S1", 2024, 2024)
    plan = full_plan(one)
    assert re.search(r"PartitionFilters: \[.*year#\d+ >= 2024", plan)
    assert "EqualTo(symbol,S1)" in plan
    some = store.read(spark, root, "etf_daily", ["close", "nothing"], where="volume > 10", limit=3)
    plan = full_plan(some)
    assert "GreaterThan(volume,10)" in plan
    assert "ReadSchema: struct<close:double,volume:bigint>" in plan

    root = sink.scratch_path(spark, "pruned-minutes")
    minutes = bars.withColumn("kline_time", F.col("date").cast("timestamp_ntz")).drop("date")
    sink.write_series(minutes, root, "etf_min1", "month")
    plan = full_plan(store.read_minutes(spark, root, "2024-02-03"))
    assert re.search(r"PartitionFilters: \[.*month#\d+ >= 2.*month#\d+ <= 2", plan)


# these write and run jobs, which the tests of the sinks look at
WRITING = {"c2", "c8", "c9", "c10", "t1", "k1", "k2", "k3", "k4", "k8", "k10", "s16", "s21"}
LAZY = [name for name in CATALOGUE if name.split("_")[0] not in WRITING]


def test_no_query_compares_all_pairs_or_gathers_all_rows(spark, given):
    for name in LAZY:
        df = CATALOGUE[name](spark, given)
        plan = plan_of(df)
        assert "CartesianProduct" not in plan, name
        assert "NestedLoopJoin" not in plan, name
        # Python never runs on rows
        assert "Python" not in plan and "InPandas" not in plan, name
        # a window without keys is one task: only over a row a table or a row a label
        if name in {"a7_inventory", "c7_inventory", "a18_by_field", "a19_by_pair"}:
            assert len(re.findall("FileScan", plan)) <= (14 if name[1] == "7" else 4), name
            continue
        for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
            if re.match(r"[\s:+-]*Window ", line):
                assert len(re.findall(r"\], \[", line)) >= 2, (name, line)


def test_fixture_bars_read_only_what_they_need(spark, given):
    plan = full_plan(Tables(spark, given).bars_daily().select("symbol", "close"))
    assert "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
