"""Vendor payloads: good records, bad records, payloads that are none."""

import json

import pytest

from quotemill.sources import payloads


def landed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "symbol string, payload string")


def test_bar_lines(spark):
    lines = [
        "2024-01-05,1,2,3,0.5,100,200,9,1.5,0.1,0.2",  # all fields
        "2024-01-06,1,2,3,0.5,100,200",  # the optional ones missing
        "2024-01-07,1,2,3,0.5,100",  # too short
        "2024-01-08,1,-,3,0.5,100,200",  # no number
        "2024-01-09,1,2,3,0.5,100,200,9,x",  # optional, but no number
        "2024-01-10, 1 ,2,3,0.5,100,200,anything,1",
        "", None,
    ]
    df = spark.createDataFrame([("a", x) for x in lines], "symbol string, line string")
    got = sorted(tuple(r) for r in payloads.parse_bar_lines(df).collect())
    assert got == [
        ("a", "20240105", 1.0, 3.0, 0.5, 2.0, 100.0, 200.0, 1.5, 0.1, 0.2),
        ("a", "20240106", 1.0, 3.0, 0.5, 2.0, 100.0, 200.0, None, None, None),
        ("a", "20240110", 1.0, 3.0, 0.5, 2.0, 100.0, 200.0, 1.0, None, None),
    ]


def test_json_bars(spark):
    good = {"day": "2024-01-05", "open": "1.5", "high": 2, "low": "1", "close": "2", "volume": "7"}
    items = [good, {**good, "open": "x"}, {**good, "high": None}, {"day": "2024-01-06", "close": "3"}, {}]
    df = landed(spark, ("a", json.dumps(items)), ("b", "not json"), ("c", '{"day": "2024-01-05"}'), ("d", None))
    got = sorted(tuple(r) for r in payloads.parse_json_bars(df).where("symbol in ('a','b','d')").collect())
    assert got == [
        ("a", "", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("a", "20240105", 1.5, 2.0, 1.0, 2.0, 7.0),
        ("a", "20240106", 0.0, 0.0, 0.0, 3.0, 0.0),
    ]


def test_nested_bars(spark):
    bars = [["2024-01-05", "1", "2", "3", "0.5", "9"], ["2024-01-06", "1", "2"],
            ["2024-01-07", "1", "-", "3", "0.5", "9"], ["2024-01-08", "1", "2", "3", "0.5", "9", {"x": 1}]]
    payload = json.dumps({"code": 0, "data": {"sh510050": {"qfqday": bars, "qt": {}}}})
    df = landed(
        spark, ("510050.SH", payload), ("159919.SZ", payload), ("600000.SH", '{"data": []}'),
        ("600001.SH", '{"data": {"sh600001": {}}}'), ("600002.SH", "x"),
    )
    got = sorted(tuple(r) for r in payloads.parse_nested_bars(df).collect())
    assert got == [
        ("510050.SH", d, 1.0, 3.0, 0.5, 2.0, 9.0) for d in ("2024-01-05", "2024-01-08")
    ]


def test_minute_tokens(spark):
    tokens = ["0930 2.97 3853 1144341.00", "0931 2.98 10", "0932 2.99", "0933 x 1 1", "0934 3 1 x", " 0935  3   1  2 "]
    data = json.dumps({"data": {"sh510050": {"data": {"data": tokens, "date": "20240105"}}}})
    df = landed(spark, ("510050.SH", f"min_data={data}"), ("510050.SH", data), ("510050.SH", "min_data=x"))
    got = sorted(tuple(r) for r in payloads.parse_minute_tokens(df).collect())
    assert got == sorted([
        ("0930", 2.97, 3853.0, 1144341.0, "510050.SH"), ("0931", 2.98, 10.0, 0.0, "510050.SH"),
        ("0935", 3.0, 1.0, 2.0, "510050.SH"),
    ] * 2)


def test_spot_list(spark):
    items = [{"f12": "510050", "f13": "SH", "f14": "Fifty", "f2": 2.9, "f3": -0.5, "f5": 10, "f6": 29},
             {"f12": "159919", "f2": "-"}, {}]
    df = landed(spark, ("", json.dumps({"data": {"diff": items}})), ("", "{}"))
    got = [tuple(r) for r in payloads.parse_spot_list(df).collect()]
    assert got == [
        ("510050.SH", "Fifty", 2.9, -0.5, 10.0, 29.0),
        ("159919.SH", "", None, None, None, None),
        (".SH", "", None, None, None, None),
    ]


def test_text_rows(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-05", "", "2", "1", "1.5", "", "")],
        "symbol string, date string, open string, high string, low string, close string, volume string, amount string",
    )
    assert tuple(payloads.text_bars(df).first()) == ("a", "20240105", None, 2.0, 1.0, 1.5, 0.0, 0.0)
    factors = spark.createDataFrame([("a", "2024-01-05", ""), ("a", "2024-01-06", "0.5")], "symbol string, date string, adj_factor string")
    assert [r["adj_factor"] for r in payloads.text_adjustments(factors).orderBy("date").collect()] == [1.0, 0.5]


def test_csv_binds_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("close,date,symbol\n1.5,2024-01-05,a\n")
    got = payloads.read_landed_csv(spark, str(tmp_path), ["symbol", "date", "close"])
    assert tuple(got.first()) == ("a", "2024-01-05", "1.5")
    with pytest.raises(ValueError, match="volume"):
        payloads.read_landed_csv(spark, str(tmp_path), ["symbol", "volume"])


def test_folders_per_key_become_a_column(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "symbol string, v int")
    root = str(tmp_path / "landed")
    df.write.partitionBy("symbol").parquet(root)
    got = payloads.read_landed_per_key(spark, root)
    assert sorted((r["symbol"], r["v"]) for r in got.collect()) == [("a", 1), ("b", 2)]


def test_data_types_map_to_delivered_tables():
    assert payloads.delivered_table("etf_adj_factor") == "fund_adj"
    assert payloads.delivered_table("stk_limit") == "stk_limit"
    with pytest.raises(ValueError):
        payloads.delivered_table("weather")


def test_pipeline_names(spark):
    df = spark.sql("SELECT 'a' code, timestamp_ntz'2024-01-05 15:00:00' kline_time, 1.0d close")
    assert tuple(payloads.to_pipeline_bars(df).first()) == ("a", "20240105", 1.0)
