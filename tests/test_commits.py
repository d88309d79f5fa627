"""Switching tables in one step, files that stay, versions, spans, footers and wider types."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotemill.functions.scalars import to_moment
from quotemill.operators import calendar, compare, keyed, sketches
from quotemill.plans import jobs
from quotemill.sinks import bucketed, sketches as sketched, store as sink
from quotemill.sources import commits, payloads, store

DAY = dt.date(2024, 1, 1)
KEYS, ORDER = ["symbol", "date"], ["seq"]


def day(n):
    return DAY + dt.timedelta(days=n)


def bars(spark, *values, schema="symbol string, date date, close double, seq int"):
    return spark.createDataFrame([(s, day(n), v, i) for i, (s, n, v) in enumerate(values)], schema)


def rows_of(spark, root, table="t"):
    df = store.without_partitions(store.read_table(spark, root, table))
    return sorted((r["symbol"], (r["date"] - DAY).days, r["close"]) for r in df.collect())


def files(root, table="t"):
    """Data files with the time of their last change; hidden folders are not part of the table."""
    found = [p for p in Path(root, table).rglob("*.parquet") if not any(x.startswith("_") for x in p.relative_to(root).parts)]
    return {p.name: p.stat().st_mtime_ns for p in found}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- in one step -------------------------------------------------------------------

WRITES = {
    "upsert": lambda spark, root: sink.upsert(bars(spark, ("a", 0, 9.0), ("c", 1, 9.0)), root, "t", KEYS, ORDER, "year"),
    "replace": lambda spark, root: sink.write(bars(spark, ("a", 0, 9.0), ("c", 1, 9.0)), root, "t", "replace", layout="year"),
    "append": lambda spark, root: sink.write(bars(spark, ("c", 1, 9.0)), root, "t", "append", layout="year"),
}
OLD = [("a", 0, 1.0), ("a", 2, 2.0), ("b", 0, 3.0)]
NEW = {
    "upsert": [("a", 0, 9.0), ("a", 2, 2.0), ("b", 0, 3.0), ("c", 1, 9.0)],
    "replace": [("a", 0, 9.0), ("b", 0, 3.0), ("c", 1, 9.0)],
    "append": [*OLD, ("c", 1, 9.0)],
}


class Stopped(Exception):
    pass


def stop(*args, **kwargs):
    raise Stopped


@pytest.mark.parametrize("kind", list(WRITES))
@pytest.mark.parametrize("step", ["write_note", "_move", "of_uri", "after"])
def test_a_stop_between_the_steps_leaves_a_whole_table(spark, root, monkeypatch, kind, step):
    sink.write_series(bars(spark, *OLD), root, "t", time="date")
    real = commits.write_note
    with monkeypatch.context() as patched:
        if step == "write_note":  # before the switch: the plan is never written
            patched.setattr(commits, "write_note", stop)
        elif step == "after":  # at the notes, when files have moved and gone
            patched.setattr(commits, "write_note", lambda s, path, value: stop() if path.endswith("/_schema") else real(s, path, value))
        else:
            patched.setattr(commits, step, stop)
        try:
            WRITES[kind](spark, root)
        except Stopped:
            pass
    switched = step != "write_note"
    assert rows_of(spark, root) == (NEW[kind] if switched else OLD)
    assert not Path(root, "t", "_commit").exists()
    # and the next write goes on from there
    sink.upsert(bars(spark, ("z", 3, 4.0)), root, "t", KEYS, ORDER, "year")
    assert rows_of(spark, root) == [*(NEW[kind] if switched else OLD), ("z", 3, 4.0)]


def test_a_replaced_table_has_the_new_columns_and_types(spark, root):
    sink.write_table(spark.createDataFrame([(1, "p")], "x int, y string"), root, "t")
    sink.write_table(spark.createDataFrame([(2**40,)], "x long"), root, "t")
    got = store.read_table(spark, root, "t")
    assert got.dtypes == [("x", "bigint")] and [tuple(r) for r in got.collect()] == [(2**40,)]
    sink.write(spark.createDataFrame([("q", 1.5)], "x string, z double"), root, "t", "replace")
    assert store.read_table(spark, root, "t").dtypes == [("x", "string"), ("z", "double")]
    sink.write_table(spark.createDataFrame([], "w int"), root, "t")  # an empty frame replaces nothing
    assert store.read_table(spark, root, "t").count() == 1


# -- files that stay -----------------------------------------------------------------

def test_a_day_rewrites_the_files_of_its_keys_only(spark, root):
    for n in range(5):
        sink.write_series(bars(spark, *[(s, n, float(n)) for s in "abc"]), root, "t", time="date", mode="append", partitions=1)
    before = files(root)
    assert len(before) == 5
    sink.upsert(bars(spark, ("a", 2, 9.0)), root, "t", KEYS, ORDER, "year")
    after = files(root)
    assert len(before.keys() - after.keys()) == 1 and all(after[f] == t for f, t in before.items() if f in after)
    sink.upsert(bars(spark, ("a", 7, 9.0), ("d", 2, 9.0)), root, "t", KEYS, ORDER, "year")  # keys that no file has
    assert after.items() <= files(root).items()
    want = [(s, n, float(n)) for s in "abc" for n in range(5) if (s, n) != ("a", 2)] + [("a", 2, 9.0), ("a", 7, 9.0), ("d", 2, 9.0)]
    assert rows_of(spark, root) == sorted(want)


def test_null_keys_find_their_file(spark, root):
    sink.upsert(bars(spark, ("a", 0, 1.0), (None, 0, 2.0)), root, "t", KEYS, ORDER, "year")
    sink.upsert(bars(spark, (None, 0, 5.0)), root, "t", KEYS, ORDER, "year")
    got = {r["symbol"]: r["close"] for r in store.read_table(spark, root, "t").collect()}
    assert got == {"a": 1.0, None: 5.0}


def test_random_upserts_equal_a_dictionary(spark, root):
    rng, want = random.Random(3), {}
    for layout in ("year", "month", "bucket", "single"):
        want = {}
        for _ in range(4):
            batch = [(rng.choice("abcdefgh"), rng.randint(0, 60), float(rng.randint(0, 99))) for _ in range(30)]
            sink.upsert(bars(spark, *batch), root, layout, KEYS, ORDER, layout)
            want |= {(s, n): v for s, n, v in batch}
        assert rows_of(spark, root, layout) == sorted((s, n, v) for (s, n), v in want.items()), layout


def test_small_files_are_merged(spark, root):
    for n in range(10):
        sink.write_series(bars(spark, ("a", n, float(n))), root, "t", time="date", mode="append", partitions=1)
    sink.write_series(bars(spark, ("a", 400, 1.0)), root, "t", time="date", mode="append", partitions=1)
    other = {p.name for p in Path(root, "t", "year=2025").glob("*.parquet")}
    sink.compact(spark, root, "t")
    assert len(list(Path(root, "t", "year=2024").glob("*.parquet"))) < 10
    assert {p.name for p in Path(root, "t", "year=2025").glob("*.parquet")} == other
    assert len(rows_of(spark, root)) == 11 and store.symbol_spans(spark, root, "t").collect()[0]["rows"] == 11


# -- versions ----------------------------------------------------------------------

@pytest.mark.parametrize("layout", ["year", "bucket", "single"])
def test_versions_are_appended_and_folded(spark, root, layout):
    keys = KEYS

    def append(name, seq, *values):
        batch = bars(spark, *values).withColumn("seq", F.lit(seq))
        sink.append_versions(batch, root, "t", keys, ORDER, name, layout)

    append("x-1", 5, ("a", 0, 1.0), ("b", 3, 2.0), (None, 0, 8.0))
    assert len(rows_of_nulls(spark, root)) == 3 and store.table_exists(spark, root, "t")
    sink.compact(spark, root, "t")
    base = files(root)
    assert base and store.appended_versions(spark, f"{root}/t") == []
    append("x-2", 4, ("a", 0, 9.0), ("c", 400, 9.0))  # an old version comes late
    append("x-3", 6, ("b", 3, 7.0))
    append("x-3", 6, ("b", 3, 7.0))  # the same batch again
    want = [("a", 0, 1.0), ("b", 3, 7.0), ("c", 400, 9.0), (None, 0, 8.0)]
    assert files(root) == base and rows_of_nulls(spark, root) == want
    assert len(store.appended_versions(spark, f"{root}/t")) == 2
    if layout == "year":
        assert (2025,) in store.stored_periods(spark, root, "t")
        assert store.newest_bars(spark, root, "t", 5).where("symbol = 'c'").count() == 1
    with pytest.raises(ValueError, match="versions by"):
        sink.append_versions(bars(spark, ("a", 0, 1.0)), root, "t", ["date"], ORDER, "y", layout)
    # any other write finds them folded in
    sink.upsert(bars(spark, ("a", 0, 3.0)), root, "t", keys, ORDER, layout)
    want[0] = ("a", 0, 3.0)
    assert rows_of_nulls(spark, root) == want and store.appended_versions(spark, f"{root}/t") == []


def rows_of_nulls(spark, root):
    df = store.without_partitions(store.read_table(spark, root, "t"))
    return sorted(((r["symbol"], (r["date"] - DAY).days, r["close"]) for r in df.collect()), key=lambda r: (r[0] is None, r))


def test_a_batch_of_versions_writes_in_proportion(spark, root):
    many = spark.range(60_000).select(F.concat(F.lit("s"), "id").alias("symbol"), F.lit(DAY).alias("date"), F.rand(1).alias("close"), F.lit(1).alias("seq"))
    sink.upsert(many, root, "t", ["symbol"], ORDER, "bucket")
    whole = sum(p.stat().st_size for p in Path(root, "t").rglob("*.parquet"))
    sink.append_versions(bars(spark, ("s7", 0, 2.0)), root, "t", ["symbol"], ORDER, "b", "bucket")
    versions = sum(p.stat().st_size for p in Path(root, "t", "_appended").rglob("*.parquet"))
    assert 0 < versions < whole / 50
    shown = plan(store.read_table(spark, root, "t").where("symbol = 's7'"))
    assert "Window" in shown


# -- spans and footers ---------------------------------------------------------------

def test_spans_follow_every_write(spark, root):
    def check():
        spans = store.symbol_spans(spark, root, "t")
        assert all("/_spans/" in f for f in spans.inputFiles())
        got = sorted((r["symbol"], r["first"], r["last"], r["rows"]) for r in spans.collect())
        rows = store.read_table(spark, root, "t").groupBy("symbol").agg(F.min("date"), F.max("date"), F.count("*")).collect()
        assert got == sorted(tuple(r) for r in rows)

    sink.write_series(bars(spark, ("a", 0, 1.0), ("a", 400, 2.0), ("b", 3, 3.0)), root, "t", time="date")
    check()
    sink.upsert(bars(spark, ("a", 0, 5.0), ("c", 9, 1.0)), root, "t", KEYS, ORDER, "year")
    check()
    sink.write(bars(spark, ("a", 7, 5.0)), root, "t", "replace", layout="year")
    check()
    spark.createDataFrame([("z", day(0), 1.0, 1)], "symbol string, date date, close double, seq int").withColumn(
        "year", F.lit(2024)).write.mode("append").partitionBy("year").parquet(f"{root}/t")  # written by others
    assert store.symbol_spans(spark, root, "t") is None
    assert {r["symbol"] for r in store.newest_bars(spark, root, "t", 1).collect()} == {"a", "b", "c", "z"}


def test_profiles_come_from_footers(spark, root):
    sink.write_series(bars(spark, ("a", 0, 1.0), ("a", 400, 2.0)), root, "t", time="date")
    scan = store.profile_scan(spark, root, "t")
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan(scan)
    assert store.stored_profile(spark, root, "t") == (2, day(0), day(400))
    text = spark.createDataFrame([("20240105",), ("20240104",)], "list_date string")
    sink.write_table(text, root, "u")
    assert store.stored_profile(spark, root, "u") == (2, dt.date(2024, 1, 4), dt.date(2024, 1, 5))
    sink.write_table(text.withColumnRenamed("list_date", "x"), root, "v")
    assert store.stored_profile(spark, root, "v") == (2, None, None)


def test_a_broken_table_is_a_row_of_its_own(spark, root):
    sink.write_table(bars(spark, ("a", 0, 1.0)), root, "etf_daily")
    sink.write_table(bars(spark, ("a", 0, 1.0)), root, "etf_nav")
    Path(root, "etf_nav", "part=0", "part-x.parquet").write_text("no")
    got = {r["table"]: r["status"] for r in jobs.quality_of_store(spark, root, day(0), {"etf_daily": (1, 3), "etf_nav": (1, 3)}).collect()}
    assert got == {"etf_daily": "ok", "etf_nav": "error"}
    assert {r["table"]: r["rows"] for r in jobs.inventory_of_store(spark, root).collect()} == {"etf_daily": 1, "etf_nav": None}


# -- wider types ---------------------------------------------------------------------

def test_wider_types_are_taken_and_narrower_ones_refused(spark, root):
    def table(kind, value):
        return spark.sql(f"SELECT 'k{value}' AS symbol, CAST({value} AS {kind}) AS v, 1 AS seq")

    sink.upsert(table("int", 1), root, "t", ["symbol"], ORDER)
    sink.upsert(table("bigint", 2**40), root, "t", ["symbol"], ORDER)
    sink.upsert(table("smallint", 3), root, "t", ["symbol"], ORDER)  # fits the table as it is
    got = store.read_table(spark, root, "t")
    assert dict(got.dtypes)["v"] == "bigint" and sorted(r["v"] for r in got.collect()) == [1, 3, 2**40]
    for kind in ("double", "string", "decimal(10,2)"):
        with pytest.raises(TypeError, match="stored as bigint"):
            sink.upsert(table(kind, 5), root, "t", ["symbol"], ORDER)
    sink.write_table(table("float", 0.5), root, "u")
    sink.write_table(table("double", 0.1), root, "u", "append")
    assert sorted(r["v"] for r in store.read_table(spark, root, "u").collect()) == [0.1, 0.5]
    days = spark.sql("SELECT 'a' AS symbol, date'2024-01-02' AS kline_time, 1 AS seq")
    times = spark.sql("SELECT 'b' AS symbol, timestamp_ntz'2024-01-02 09:31:00' AS kline_time, 1 AS seq")
    sink.write_series(days, root, "w")
    sink.upsert(times, root, "w", ["symbol", "kline_time"], ORDER, "year", "kline_time")
    got = {r["symbol"]: r["kline_time"] for r in store.read_series(spark, root, "w").collect()}
    assert got == {"a": dt.datetime(2024, 1, 2), "b": dt.datetime(2024, 1, 2, 9, 31)}


# -- times ---------------------------------------------------------------------------

def test_forms_of_a_time(spark):
    forms = {
        "20240103": (2024, 1, 3), "2024-01-03": (2024, 1, 3), "2024/01/03": (2024, 1, 3), " 202401030931 ": (2024, 1, 3, 9, 31),
        "20240103093105": (2024, 1, 3, 9, 31, 5), "2024-01-03 09:31": (2024, 1, 3, 9, 31), "2024-01-03T09:31:05": (2024, 1, 3, 9, 31, 5),
        "2024-01-03 09:31:05.25": (2024, 1, 3, 9, 31, 5, 250000), "2024-13-03": None, "2024": None, "soon": None, "": None,
        "20240103 0931": None, "202401032531": None}
    df = spark.createDataFrame([(t,) for t in forms], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", to_moment("t").alias("m")).collect()}
    assert got == {t: dt.datetime(*parts) if parts else None for t, parts in forms.items()}


def test_minutes_survive_and_unreadable_times_are_refused(spark, root):
    text = spark.createDataFrame([("a", "2024-01-03 09:31:00", 1.0), ("a", "2024-01-03 09:32:00", 2.0)], "symbol string, kline_time string, close double")
    sink.write_series(text, root, "t", "month")
    numbers = text.withColumn("kline_time", F.lit(202401030933))
    sink.write(numbers, root, "t", layout="month", keys=["symbol", "kline_time"], order=["close"])
    got = sorted((r["kline_time"].minute, r["close"]) for r in store.read_series(spark, root, "t").collect())
    assert [m for m, _ in got] == [31, 32, 33]
    for column, value in (("kline_time", "soon"), ("date", "2024-01-03 09:31:00")):
        bad = text.drop("kline_time").withColumn(column, F.lit(value))
        with pytest.raises(PySparkException, match="cannot be read"):
            sink.write_series(bad, root, "u", time=column)
    assert not store.table_exists(spark, root, "u")


def test_a_task_takes_its_symbols_and_counts_what_it_sets_aside(spark, root):
    data = [("a", "202401030931", 1.0), ("a", "202401030932", 2.0), ("a", "late", 3.0), ("a", None, 4.0), ("b", "202401030931", 5.0), ("a", "202401050931", 6.0)]
    df = spark.createDataFrame(data, "ts_code string, kline_time string, close double")
    task = {"name": "t", "symbols": ["a"], "start_date": "2024-01-03", "end_date": "2024-01-03", "order": ["close"],
            "target": {"root": root, "table": "t", "layout": "month", "keys": ["symbol", "kline_time"], "order": ["close"]}}
    task["rejected"] = {"root": root, "table": "t_rejected"}
    runs = []

    def source():
        runs.append(1)
        return df

    result = jobs.run_task(task, [("none", df.limit(0)), ("s", source)])
    assert (result["status"], result["rows_written"], result["unreadable"], len(runs)) == ("ok", 2, 1, 1)
    assert sorted(r["close"] for r in store.read_series(spark, root, "t").collect()) == [1.0, 2.0]
    rejected = store.read_table(spark, root, "t_rejected").collect()
    assert [(r["symbol"], r["reason"]) for r in rejected] == [("a", "time cannot be read")] and '"close":3.0' in rejected[0]["record"]


# -- missing days --------------------------------------------------------------------

def test_missing_days_equal_a_set_difference(spark):
    rng = random.Random(5)
    open_ = sorted(rng.sample(range(0, 400), 250))
    cal = spark.createDataFrame([(day(n), "1" if n in set(open_) else "0") for n in range(400)], "date date, is_open string")
    have = {(s, n) for s in ("a", "b", None) for n in rng.sample(range(30, 390), 150)} | {("one", 100)}
    df = spark.createDataFrame([(s, day(n)) for s, n in have], "symbol string, date date")

    def brute(last, as_of, through, universe):
        listed = [n for n in open_ if n <= as_of][-last if last else None:]
        out = set()
        for s in universe or {s for s, _ in have}:
            own = [n for t, n in have if t == s]
            lo = listed[0] if universe else max(listed[0], min(own))
            hi = listed[-1] if universe or through == "table" else min(listed[-1], max(own))
            out |= {(s, n) for n in listed if lo <= n <= hi and (s, n) not in have}
        return out

    for last, as_of, through, universe in ((None, 399, "own", None), (70, 399, "own", None), (None, 350, "table", None), (90, 370, "table", ["a", "zz", None])):
        frame = spark.createDataFrame([(u,) for u in universe], "symbol string") if universe else None
        got = calendar.missing_days(df, cal, last=last, as_of=day(as_of), through=through, universe=frame)
        found = [(r["symbol"], (r["date"] - DAY).days) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == brute(last, as_of, through, universe)
        assert "LeftAnti" not in plan(got)


def test_filling_reads_the_partitions_of_the_days_only(spark, root, monkeypatch):
    sink.write_series(bars(spark, *[(s, n, 1.0) for s in "ab" for n in (0, 1, 370, 371, 372) if (s, n) != ("b", 371)]), root, "t", time="date")
    cal = spark.createDataFrame([(day(n), "1") for n in range(373)], "date date, is_open string")
    plans = []
    real = calendar.missing_days

    def spied(df, *args, **kwargs):
        plans.append((plan(df), kwargs["spans"]))
        return real(df, *args, **kwargs)

    monkeypatch.setattr(jobs, "missing_days", spied)
    chain = [("x", bars(spark, ("b", 371, 5.0), ("b", 5, 5.0)))]
    assert jobs.backfill_missing(spark, root, "t", cal, chain, "2025-01-10 18:00:00", days=3) == "updated"
    assert "PartitionFilters: [isnotnull(year" in plans[0][0] and all("/_spans/" in f for f in plans[0][1].inputFiles())
    assert ("b", 371, 5.0) in rows_of(spark, root) and ("b", 5, 5.0) not in rows_of(spark, root)


# -- records set aside ---------------------------------------------------------------

def test_rows_in_are_rows_out_and_rows_set_aside(spark):
    payload = '[{"day":"2024-01-02","open":"1","high":2,"low":1,"close":1.5}, 3, {"day":"2024-01-03","open":"x"}, null, {"open":null}]'
    df = spark.createDataFrame([("a", payload), ("b", "no"), ("c", None), ("d", "[]"), ("e", '{"x":1}')], "symbol string, payload string")
    examined = payloads.examine_json_bars(df)
    assert payloads.readable(examined).collect() == payloads.parse_json_bars(df).collect()
    aside = sorted((r["symbol"], r["reason"]) for r in payloads.rejected(examined).collect())
    assert aside == [
        ("a", "no object"), ("a", "no object"), ("a", "open is no number"), ("a", "open is no number"),
        ("b", payloads.NO_LIST), ("c", payloads.NO_LIST), ("e", payloads.NO_LIST)]
    assert payloads.readable(examined).count() + len(aside) == examined.count() == 8
    lines = spark.createDataFrame([("a", "2024-01-02,1,2,3,4,5,6"), ("a", "x"), ("a", None), ("a", "2024-01-02,1,2,3,4,5,6,7,y")], "symbol string, line string")
    got = sorted((r["record"] or "", r["reason"]) for r in payloads.rejected(payloads.examine_bar_lines(lines)).collect())
    assert got == [("", "fewer than seven fields"), ("2024-01-02,1,2,3,4,5,6,7,y", "pct_chg is no number"), ("x", "fewer than seven fields")]
    nested = spark.createDataFrame([("510050.SH", '{"data":{"sh510050":{"qfqday":[["2024-01-02","1","2","3","4","5"],["x"]]}}}'), ("510050.SH", '{"data":[]}'), ("510050.SH", "{")], "symbol string, payload string")
    assert sorted(r["reason"] for r in payloads.rejected(payloads.examine_nested_bars(nested)).collect()) == ["fewer than six fields", payloads.NO_LIST]
    tokens = spark.createDataFrame([("510050.SH", 'x={"data":{"sh510050":{"data":{"data":["0931 1.5 2","0932 1","9932 1 2"]}}}}', DAY)], "symbol string, payload string, day date")
    parsed = payloads.parse_minute_tokens(tokens, day="day").collect()
    assert [r["kline_time"] for r in parsed] == [dt.datetime(2024, 1, 1, 9, 31)]
    assert payloads.examine_minute_tokens(tokens, day="day").count() == 3


# -- buckets and sketches --------------------------------------------------------------

def sources_in_buckets(spark, root):
    bars_ = "SELECT concat('s', id % 50) AS symbol, date_add(date'2024-01-01', CAST(id DIV 50 AS INT)) AS date, id * 1.0D AS close, id % 7 AS volume FROM range(2000)"
    one = spark.sql(bars_)
    two = one.withColumn("close", F.when(F.col("volume") == 0, F.col("close") * 2).otherwise(F.col("close")))
    three = one.where("volume <> 1").withColumn("close", F.col("close") + 100)
    frames = [("A", one), ("B", two), ("C", three)]
    for name, df in frames:
        bucketed.write_bucketed(df, root, name, buckets=4)
    return frames, [(name, bucketed.read_bucketed(spark, root, name)) for name, _ in frames]


def test_sources_in_buckets_are_compared_without_a_shuffle(spark, root):
    frames, stored = sources_in_buckets(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = compare.source_differences(stored, ("close", "volume"), main_only=False, in_place=True)
        shown = plan(got)
        assert shown.count("SortMergeJoin") == 3 and "Exchange" not in shown and "SelectedBucketsCount: 4 out of 4" in shown
        want = compare.source_differences(frames, ("close", "volume"), main_only=False)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count()
        last = keyed.keep_last(stored[0][1], ["symbol", "date"], ["close"])
        batch = keyed.without_keys(stored[0][1], stored[2][1], ["symbol", "date"], null_safe=False)
        assert "Exchange" not in plan(last) and "Exchange" not in plan(batch)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_in_buckets_is_replaced_and_named_again(spark, root):
    bucketed.write_bucketed(bars(spark, ("a", 0, 1.0)), root, "t", buckets=2)
    bucketed.write_bucketed(bars(spark, ("a", 0, 2.0), ("b", 1, 3.0)), root, "t", buckets=2)
    assert len(list(Path(root, "t").glob("data-*"))) == 1
    note = commits.read_note(spark, f"{root}/t/_bucketed")
    spark.sql(f"DROP TABLE {bucketed._name(note)}")  # as in a new session
    got = bucketed.read_bucketed(spark, root, "t")
    assert sorted(r["close"] for r in got.collect()) == [2.0, 3.0] and got.dtypes[1] == ("date", "date")
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, root, "u")


def test_sketches_are_near_and_add_up(spark):
    df = spark.range(200_000).select((F.col("id") % 30_000).alias("x"), (F.col("id") % 8).alias("part"), F.lit(None).cast("string").alias("n"))
    columns = {"x": "x", "n": "n"}
    parts = sketches.distinct_sketches(df, columns, ["part"])
    found = {r["name"]: r for r in sketches.error_against_exact(df, parts, columns).collect()}
    assert found["x"]["exact"] == 30_000 and found["x"]["error"] < 0.04 and found["n"]["estimated"] == 0
    assert sketches.estimated_distinct(parts, ["x"]).first()["x"] == sketches.estimated_distinct(sketches.distinct_sketches(df, columns), ["x"]).first()["x"]
    assert sketches.estimated_duplicates(parts, "x").first()["duplicates"] == pytest.approx(170_000, rel=0.01)


def test_only_changed_partitions_are_sketched_again(spark, root):
    sink.write_series(bars(spark, ("a", 0, 1.0), ("b", 400, 2.0)), root, "t", time="date")
    assert [sketched.refresh_sketches(spark, root, "t", ["symbol"]) for _ in range(2)] == [2, 0]
    sink.upsert(bars(spark, ("c", 1, 1.0)), root, "t", KEYS, ORDER, "year")
    assert sketched.refresh_sketches(spark, root, "t", ["symbol"]) == 1
    got = sketched.stored_distinct(spark, root, "t", ["symbol"]).first()
    assert (got["rows"], got["symbol"]) == (3, 3)
    assert sketched.refresh_sketches(spark, root, "t", ["symbol", "date"]) == 2
    assert sketched.stored_distinct(spark, root, "t", ["symbol", "date"]).first()["date"] == 3
