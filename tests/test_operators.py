"""Small hand-made frames: what the given tables cannot show."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given as for_all, settings, strategies as st
from pyspark.sql import functions as F

from quotemill.functions import scalars as fx
from quotemill.operators import (
    calendar, columns, compare, fallback, holdings, keyed, quality, series, validate,
)

DAY = dt.date(2024, 1, 1)
BAR = "symbol string, date date, close double"


def day(n):
    return DAY + dt.timedelta(days=n)


# -- keyed -----------------------------------------------------------------------

def test_keep_last_and_first_with_null_keys_and_null_order(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 20), (None, 1, 30), (None, 5, 40), ("b", None, 50), ("b", 1, 60)],
        "k string, seq int, v int",
    )
    assert rows(keyed.keep_last(df, ["k"], ["seq"]), "k", "v") == [("a", 20), ("b", 60), (None, 40)]
    assert rows(keyed.keep_one(df, ["k"], ["seq"], "first"), "k", "v") == [("a", 10), ("b", 60), (None, 30)]
    with pytest.raises(ValueError):
        keyed.keep_one(df, ["k"], ["seq"], "any")


def test_merge_batch_wins_and_last_of_batch_wins(spark, rows):
    old = spark.createDataFrame([("a", 9, 1), ("b", 9, 2), (None, 9, 3)], "k string, seq int, v int")
    new = spark.createDataFrame([("b", 1, 4), ("b", 2, 5), (None, 1, 6), (None, 2, 7), ("c", 1, 8)], old.schema)
    merged = keyed.merge_by_key(old, new, ["k"], ["seq"])
    assert rows(merged, "k", "v") == [("a", 1), ("b", 5), ("c", 8), (None, 7)]
    # as in a database a null key matches nothing
    merged = keyed.merge_by_key(old, new, ["k"], ["seq"], null_safe=False)
    assert rows(merged, "k", "v") == [("a", 1), ("b", 5), ("c", 8), (None, 3), (None, 6), (None, 7)]
    # by version the greater seq stays
    merged = keyed.merge_by_version(old, new, ["k"], ["seq"])
    assert rows(merged, "k", "v") == [("a", 1), ("b", 2), ("c", 8), (None, 3)]


PAIRS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50)), min_size=1, max_size=30,
    unique_by=lambda p: p[1],
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@for_all(PAIRS)
def test_keep_last_is_unique_complete_and_idempotent(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, seq int")
    kept = keyed.keep_last(df, ["k"], ["seq"])
    got = {r["k"]: r["seq"] for r in kept.collect()}
    want = {}
    for k, seq in pairs:
        want[k] = max(seq, want.get(k, -1))
    assert got == want
    assert kept.count() == len(want)
    again = keyed.merge_by_key(kept, df, ["k"], ["seq"])
    assert {r["k"]: r["seq"] for r in again.collect()} == want


# -- series ----------------------------------------------------------------------

def test_percent_change_crosses_spans_and_keeps_nulls(spark):
    values = [(0, 10.0), (5, 20.0), (40, None), (41, 5.0), (75, 0.0), (76, 4.0), (110, 0.0), (140, 0.0)]
    df = spark.createDataFrame([("a", day(n), v) for n, v in values], BAR)
    for span in ("day", "month", "year"):
        got = [r["pct_chg"] for r in series.pct_change(df, span=span).orderBy("date").collect()]
        assert got[:2] == [None, 100.0] and got[2] is None and got[3] is None
        assert got[4] == -100.0 and math.isinf(got[5]) and got[6] == -100.0 and got[7] is None


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@for_all(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 900), st.floats(1, 9)), min_size=1,
                  max_size=40, unique_by=lambda r: r[:2]))
def test_percent_change_equals_brute_force(spark, bars):
    df = spark.createDataFrame([(s, day(n), v) for s, n, v in bars], BAR)
    got = {(r["symbol"], r["date"]): r["pct_chg"] for r in series.pct_change(df, span="month").collect()}
    for s in "ab":
        before = None
        for _, n, v in sorted(b for b in bars if b[0] == s):
            want = None if before is None else (v / before - 1) * 100
            assert got[s, day(n)] == want
            before = v
    assert len(got) == len(bars)


def test_last_n_bars_keeps_the_newest_and_starts_without_change(spark):
    df = spark.createDataFrame([("a", day(n), float(n + 1)) for n in range(9)] + [("b", day(0), 1.0)], BAR)
    got = series.last_n_bars(df, 3).orderBy("symbol", "date").collect()
    assert [(r["symbol"], r["date"]) for r in got] == [("a", day(6)), ("a", day(7)), ("a", day(8)), ("b", day(0))]
    assert got[0]["pct_chg"] is None and got[1]["pct_chg"] == (8 / 7 - 1) * 100 and got[3]["pct_chg"] is None


def test_close_matrix_has_a_column_a_symbol_and_exactly_n_days(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 2.0), ("b", day(1), 3.0), ("c", day(2), 4.0)], BAR)
    got = series.close_matrix(df, ["a", "b"], days=2).orderBy("date").collect()
    assert [tuple(r) for r in got] == [(day(1), 2.0, 3.0), (day(2), None, None)]


def test_ranges_include_the_whole_last_day(spark):
    df = spark.sql("""SELECT explode(array(timestamp_ntz'2024-01-01 23:59:59', timestamp_ntz'2024-01-02 00:00:00',
                                           timestamp_ntz'2024-01-02 23:59:59.5', timestamp_ntz'2024-01-03')) kline_time""")
    assert series.between_dates(df, "2024-01-02", "2024-01-02").count() == 2
    assert series.on_day(df, "2024-01-03").count() == 1


def test_task_range(spark):
    df = spark.createDataFrame([("a", day(n), 1.0) for n in range(10)], BAR)
    assert series.task_range(df, incremental=True, as_of=day(8), lookback_days=2).count() == 3
    assert series.task_range(df, start="2024-01-03", end="2024-01-04").count() == 2
    with pytest.raises(ValueError):
        series.task_range(df, incremental=True)


# -- columns ---------------------------------------------------------------------

def test_normalize_names_first_vendor_column_wins(spark):
    def names(*given):
        return columns.normalize_names(spark.createDataFrame([], ", ".join(f"{c} int" for c in given))).columns

    assert names("ts_code", "trade_date", "vol") == ["symbol", "date", "volume"]
    assert names("nav_date", "ann_date", "code") == ["date", "symbol"]
    assert names("ann_date", "end_date") == ["date"]
    assert names("code", "symbol", "amount", "money_amount") == ["symbol", "amount"]


def test_column_discovery(spark):
    def frame(*given):
        return spark.createDataFrame([], ", ".join(f"{c} int" for c in given))

    assert columns.date_column(frame("list_date", "kline_time")) == "kline_time"
    assert columns.date_column(frame("a", "List_Date")) == "List_Date"
    assert columns.date_column(frame("a")) is None
    assert columns.symbol_column(frame("code", "etf_code")) == "etf_code"
    assert columns.symbol_column(frame("a")) is None
    assert columns.select_existing(frame("a", "b"), ["b", "x"]).columns == ["b"]


def test_transforms_reject_bad_values_and_unknown_actions(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.apply_transforms(df, [{"action": "astype", "mapping": {"a": "int"}}]).collect()
    with pytest.raises(ValueError):
        columns.apply_transforms(df, [{"action": "explode"}])
    assert columns.apply_transforms(df, None) is df


def test_empty_symbol_list_is_no_filter(spark):
    df = spark.createDataFrame([("a",), ("b",)], "symbol string")
    assert columns.in_symbols(df, []).count() == 2
    assert columns.in_symbols(df, None).count() == 2
    assert columns.in_symbols(df, ["a", "z"]).count() == 1


# -- scalars ---------------------------------------------------------------------

def test_symbol_dialects(spark):
    df = spark.createDataFrame([("510050.SH",), ("159919.SZ",), ("430001.BJ",), ("510050",)], "s string")
    got = df.select(
        fx.complete_symbol("s"), fx.dotted_code("s"), fx.prefixed_code("s"), fx.numbered_code("s"),
        fx.bare_code("s"), fx.stripped_market("s"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("510050.SH", "sh.510050", "sh510050", "1.510050", "510050", "510050"),
        ("159919.SZ", "sz.159919", "sz159919", "0.159919", "159919", "159919"),
        ("430001.BJ", "sh.430001", "sz430001", "0.430001", "430001", "430001"),
        ("510050.SH", "sh.510050", "sz510050", "0.510050", "510050", "510050"),
    ]


def test_any_date_form_becomes_a_day(spark):
    texts = ["2024-01-05", "20240105", "2024-01-05 15:00:00", "5/1/2024", "20241399", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    assert [r[0] for r in df.select(fx.to_day("d")).collect()] == [day(4)] * 3 + [None] * 4
    assert spark.range(1).select(fx.to_day(F.lit(20240105)), fx.int_date(F.lit("2024-01-05"))).first()[0:2] == (day(4), 20240105)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@for_all(st.dates(dt.date(1890, 1, 1), dt.date(2090, 1, 1)), st.integers(0, 900))
def test_weekdays_between_equals_counting(spark, first, span):
    last = first + dt.timedelta(days=span)
    want = sum((first + dt.timedelta(days=i)).weekday() < 5 for i in range(span + 1))
    assert spark.range(1).select(fx.weekdays_between(F.lit(first), F.lit(last))).first()[0] == want


def test_price_limits_are_on_whole_ticks(spark):
    df = spark.createDataFrame([(2.987, 0.001), (10.0, 0.01)], "p double, t double")
    high, low = fx.price_limits("p", "t")
    assert [tuple(r) for r in df.select(high, low).collect()] == [(3.286, 2.688), (11.0, 9.0)]


# -- validation ------------------------------------------------------------------

def test_report_counts_what_clean_drops(spark):
    df = spark.createDataFrame(
        [("a", day(0), " 1 ", 5.0, 1), ("a", day(0), "2", -1.0, 2), (None, day(0), "3", 1.0, 3),
         ("b", day(0), "x", float("nan"), 4), ("b", day(1), None, None, 5)],
        "symbol string, date date, volume string, close double, seq int",
    )
    rules = validate.Rules(
        required=("symbol", "name"), not_null=("symbol", "date"), unique=("symbol", "date"), order=("seq",),
        strip=True, ranges={"close": (0.0, None), "volume": (0, None), "amount": (0, None)},
    )
    found = {(r["level"], r["rule"], r["detail"]): r["count"] for r in validate.report(df, rules).collect()}
    assert found == {
        ("error", "missing_columns", "name"): 1,
        ("warn", "null_keys", "symbol, date"): 1,
        ("warn", "dedup", "symbol, date"): 1,
        ("warn", "range", "close [0, -]"): 3,
        ("warn", "range", "volume [0, -]"): 2,
        ("warn", "total_dropped", "rows"): 2,
    }
    cleaned = validate.clean(df, rules)
    assert cleaned.count() == 3
    assert {r["volume"] for r in cleaned.collect()} == {"2", "x", None}
    findings = [r.asDict() for r in validate.report(df, rules).collect()]
    assert not validate.is_ok(findings)
    assert "warn dedup: symbol, date (n=1)" in validate.summary_line(findings)


def test_report_of_a_clean_or_empty_table_is_empty(spark):
    df = spark.createDataFrame([("a", day(0), 1.0)], BAR)
    for frame in (df, df.limit(0)):
        assert validate.report(frame, "daily").isEmpty()
    assert validate.summary_line([]) == "clean"


def test_a_column_without_any_number_is_not_reported(spark):
    df = spark.createDataFrame([("a", day(0), None), ("b", day(0), None)], BAR)
    assert validate.report(df, {"ranges": {"close": (0, 1)}}).isEmpty()
    some = df.unionByName(spark.createDataFrame([("c", day(0), 0.5)], BAR))
    assert validate.report(some, {"ranges": {"close": (0, 1)}}).first()["count"] == 2


def test_report_and_clean_agree_for_keep_first_with_null_order(spark):
    df = spark.createDataFrame([("a", None, -1.0), ("a", 3, 2.0), ("a", 5, -3.0)], "symbol string, seq int, close double")
    rules = validate.Rules(unique=("symbol",), order=("seq",), keep="first", ranges={"close": (0, None)})
    assert validate.clean(df, rules).first()["close"] == 2.0
    assert [r["rule"] for r in validate.report(df, rules).orderBy("rule").collect()] == ["dedup", "total_dropped"]


def test_rule_lists_run_in_turn_and_unknown_presets_are_refused(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 3)], "symbol string, name string, seq int")
    spec = validate.with_order(["basic", {"dedup_keys": ["name"]}], ["seq"])
    assert [tuple(r) for r in validate.clean(df, spec).collect()] == [("b", "y", 3)]
    total = validate.report(df, spec).where("rule = 'total_dropped'").collect()
    assert [r["count"] for r in total] == [2]
    with pytest.raises(ValueError):
        validate.rules_from("weekly")
    skipped = validate.report(df, {"dedup_keys": ["nothing"]}).collect()
    assert [r["rule"] for r in skipped] == ["dedup_skipped"]


# -- calendar --------------------------------------------------------------------

def test_missing_days_of_one_symbol_are_not_hidden_by_another(spark, rows):
    dates = [(d.strftime("%Y%m%d"), "1" if d.weekday() < 5 else "0") for d in map(day, range(12))]
    days = spark.createDataFrame(dates, "date string, is_open string")
    bars = spark.createDataFrame(
        [("a", day(n), 1.0) for n in (0, 1, 2, 3, 4, 7, 8)] + [("b", day(n), 1.0) for n in (1, 4, 8)], BAR)
    assert rows(calendar.missing_days(bars, days)) == [("b", day(2)), ("b", day(3)), ("b", day(7))]
    late = calendar.missing_days(bars, days, last=2, as_of=day(9), through="table")
    assert rows(late) == [("a", day(9)), ("b", day(9))]
    assert rows(calendar.completeness(bars), "symbol", "missing_days") == [("a", 0), ("b", 3)]
    assert calendar.completeness(bars, ()).first()["missing_days"] == 0
    assert calendar.is_trading_day(days, day(0)) and not calendar.is_trading_day(days, day(5))


def test_fewer_than_two_dates_lack_nothing(spark):
    one = spark.createDataFrame([("a", day(0), 1.0)], BAR)
    assert calendar.completeness(one).first()["missing_days"] == 0
    assert calendar.completeness_message(one, {}).first()["message"] is None
    assert calendar.completeness_message(one.limit(0), {}).first()["message"] is None
    gap = spark.createDataFrame([("a", day(0), 20.0), ("a", day(3), -30.0)], BAR)
    told = calendar.completeness_message(gap, {"pct_change_col": "close"}).first()["message"]
    assert told == "missing 2 trading days, 2 extreme moves (>11)"
    assert calendar.completeness_message(gap, {"check_gaps": False}).first()["message"] is None


# -- fallback --------------------------------------------------------------------

def test_fallback_covers_the_union_of_symbols_with_one_source_each(spark, rows):
    a = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 2.0)], BAR)
    b = spark.createDataFrame([("a", day(2), 3.0), ("b", day(0), 4.0)], BAR).withColumn("extra", F.lit(1))
    got = fallback.fallback_by_key([("a", a), ("b", b)])
    assert rows(got, "symbol", "close", "source") == [("a", 1.0, "a"), ("a", 2.0, "a"), ("b", 4.0, "b")]
    by_day = fallback.fallback_by_key([("a", a), ("b", b)], ("symbol", "date"), unique=True)
    assert rows(by_day, "close", "source") == [(1.0, "a"), (2.0, "a"), (3.0, "b"), (4.0, "b")]


def test_owner_table_is_broadcast_by_its_bytes_only(spark, rows):
    a = spark.createDataFrame([("a", day(0), 1.0), (None, day(0), 5.0)], BAR)
    b = spark.createDataFrame([("a", day(2), 3.0), ("b", day(0), 4.0), (None, day(1), 6.0)], BAR)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    try:
        for bytes_ in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bytes_)
            got = fallback.fallback_by_key([("a", a), ("b", b)])
            plans.append(got._jdf.queryExecution().sparkPlan().toString())
            assert rows(got, "symbol", "close", "source") == [("a", 1.0, "a"), ("b", 4.0, "b"), (None, 5.0, "a")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ["Broadcast" in p for p in plans] == [False, True]


def test_first_source_with_rows_wins_whole(spark):
    full = spark.createDataFrame([("a", day(0), 1.0)], BAR)

    def broken():
        raise OSError("gone")

    def untouched():
        raise AssertionError("a later source was looked at")

    used, df = fallback.first_with_rows([("x", broken), ("y", full.limit(0)), ("z", full), ("w", untouched)])
    assert used == "z" and df is full
    with pytest.raises(ValueError, match="gone"):
        fallback.first_with_rows([("x", broken), ("y", full.limit(0))])
    absent = lambda: spark.read.parquet("/no/such/table")
    assert fallback.first_with_rows([("x", absent), ("z", full)])[0] == "z"
    wrong = full.where(F.col("symbol").cast("int") > 0)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):  # a typing error is no reason to go on
        fallback.first_with_rows([("x", wrong), ("z", full)])


# -- comparison ------------------------------------------------------------------

def test_differences_skip_missing_zero_and_unknown_symbols(spark, rows):
    def source(*values):
        return spark.createDataFrame(list(values), BAR)

    a = source(("s", day(0), 100.0), ("s", day(1), 0.0), ("s", day(2), None), ("s", day(3), float("nan")))
    b = source(("s", day(0), 100.4), ("s", day(1), 0.0), ("s", day(2), 5.0), ("s", day(3), 5.0), ("t", day(0), 1.0),
               ("s", day(8), 1.0))
    c = source(("s", day(0), 101.0), ("s", day(1), 3.0), ("t", day(0), 2.0), ("s", day(8), 2.0))
    chain = [("a", a), ("b", b), ("c", c)]
    found = compare.source_differences(chain, ["close"])
    assert rows(found, "symbol", "date", "src1", "src2") == [
        ("s", day(0), "a", "c"), ("s", day(0), "b", "c"), ("s", day(1), "a", "c"), ("s", day(1), "b", "c"),
        ("s", day(8), "b", "c"),
    ]
    # t is not in the first source
    everything = compare.source_differences(chain, ["close"], main_only=False)
    assert everything.where("symbol = 't'").count() == 1
    other = compare.source_differences(chain, ["close"], tolerance={"close": 0.5})
    assert other.count() == 2


def test_symbols_without_differences_are_consistent(spark):
    found = spark.createDataFrame([("s", day(0))] * 9, "symbol string, date date")
    symbols = spark.createDataFrame([("s",), ("t",)], "symbol string")
    got = {r["symbol"]: tuple(r) for r in compare.consistency_by_symbol(found, symbols).collect()}
    assert got == {"s": ("s", 9, 1, 0.5), "t": ("t", 0, 0, 1.0)}
    overall = compare.overall_consistency(compare.consistency_by_symbol(found, symbols)).first()
    assert tuple(overall) == (2, 0.75, 9)
    nothing = compare.overall_consistency(compare.consistency_by_symbol(found, symbols.limit(0))).first()
    assert tuple(nothing) == (0, 0.0, 0)


# -- holdings --------------------------------------------------------------------

def test_concentration_with_few_ties_and_nulls(spark, rows):
    held = spark.createDataFrame(
        [("f", day(0), "x", 9.0), ("f", day(0), "y", 9.0), ("f", day(0), "z", None), ("g", day(-9), "x", 50.0)],
        "fund_code string, date date, symbol string, stk_mkv_ratio double",
    )
    latest = holdings.latest_period(held)
    assert rows(holdings.concentration(latest)) == [("f", 3, 18.0, 18.0)]
    assert rows(holdings.concentration(holdings.latest_period(held, per_fund=True)), "fund_code") == [("f",), ("g",)]
    assert rows(holdings.top_holdings(latest), "symbol", "rank") == [("x", 1), ("y", 2), ("z", 3)]
    assert rows(holdings.overlap(latest)) == [("x", 1, 9.0), ("y", 1, 9.0)]
    basics = spark.createDataFrame([("f.SH", "Fund F")], "symbol string, csname string")
    own = held.withColumn("fund_code", F.concat("fund_code", F.lit(".SH")))
    named = holdings.named_holdings(own, basics, ["f"])
    assert {r["fund_name"] for r in named.collect()} == {"Fund F"}
    assert holdings.display_name(holdings.named_holdings(own, basics)).where("fund_name = 'g.SH'").count() == 1
    assert set(holdings.analysis(own, basics)) == {"headline", "top_holdings", "overlap", "concentration"}


# -- quality ---------------------------------------------------------------------

def test_check_finds_stale_short_and_duplicate_tables(spark):
    df = spark.createDataFrame([("a", day(0)), ("a", day(0)), (None, day(0)), (None, day(0))], "symbol string, date date")
    row = quality.check_table("t", df, 10, 3, day(10)).first()
    assert row["issues"] == ["STALE: 10 days since 2024-01-01, allowed 3", "LOW_ROWS: 4 < 10", "DUPLICATES: 2"]
    assert row["status"] == "warn"
    assert quality.check_table("t", df.distinct(), 1, 3, day(3)).first()["status"] == "ok"
    text = spark.createDataFrame([("20240101",)], "cal_date string")
    assert quality.check_table("t", text, 1, 3, day(4)).first()["issues"] == ["STALE: 4 days since 2024-01-01, allowed 3"]
    plain = spark.createDataFrame([(1,)], "x int")
    assert quality.check_table("t", plain, 1, 3, day(0)).first()["status"] == "ok"
    empty = quality.check_table("t", df.limit(0), 1, 3, day(0)).first()
    assert empty["issues"] == ["LOW_ROWS: 0 < 1"]


def test_quality_report_shows_unreadable_tables(spark):
    df = spark.createDataFrame([("a", day(0))] * 40, "symbol string, date date")
    found = quality.quality_report({"etf_daily": df, "other": df}, day(1), errors={"etf_nav": "gone"})
    assert {(r["table"], r["status"]) for r in found.collect()} == {("etf_daily", "warn"), ("etf_nav", "error")}
    assert tuple(quality.quality_headline(found).first()) == (0, 1, 1)
    assert quality.alerts(found).count() == 2
    with pytest.raises(ValueError):
        quality.quality_report({"other": df}, day(1))


def test_inventory_bar_is_capped_and_safe_for_empty_stores(spark):
    def profiled(*counts):
        return spark.createDataFrame([(str(i), n, None) for i, n in enumerate(counts)], "table string, rows bigint, max_date date")

    assert sorted(r["bar"] for r in quality.inventory(profiled(1, 3)).collect()) == [50.0, 100.0]
    assert [r["bar"] for r in quality.inventory(profiled(0)).collect()] == [0.0]
    assert tuple(quality.inventory_headline(profiled(0, 3)).first()) == (3, 2, 1)


def test_log_queries(spark, rows):
    log = spark.createDataFrame(
        [("t", day(0), "ok", 5, 1000), ("t", day(3), "error", 7, 500), ("u", day(1), "error", 1, 0)],
        "table_name string, data_date date, status string, rows_count bigint, duration_ms bigint",
    )
    assert rows(quality.last_update(log)) == [("t", day(0))]
    assert rows(quality.updated_days(log, day(5), 5)) == [("t", day(0))]
    assert quality.updated_days(log, day(6), 5).isEmpty()
    summary = quality.run_summary(log, "table_name", "duration_ms")
    assert rows(summary) == [("t", 1, 1, 5, 1.5), ("u", 0, 1, 0, 0.0)]
