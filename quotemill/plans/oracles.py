"""SQL stating the result of each query of the catalogue, over the same given tables."""

from __future__ import annotations

# view -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars_daily": ((), """
        SELECT lpad(CAST(user_id AS STRING), 6, '0')
                 || CASE WHEN user_id % 2 = 0 THEN '.SH' ELSE '.SZ' END AS symbol,
               CAST(ts AS DATE) AS date,
               min_by(value, event_id) AS open, max(value) AS high, min(value) AS low,
               max_by(value, event_id) AS close, count(*) AS volume,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM events GROUP BY 1, 2"""),
    "bars_min": ((), """
        SELECT event_type AS symbol, date_trunc('minute', ts) AS kline_time,
               min_by(value, event_id) AS open, max(value) AS high, min(value) AS low,
               max_by(value, event_id) AS close, count(*) AS volume,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM events GROUP BY 1, 2"""),
    "bars_by_type": (("bars_min",), """
        SELECT symbol, CAST(kline_time AS DATE) AS date, min_by(open, kline_time) AS open,
               max(high) AS high, min(low) AS low, max_by(close, kline_time) AS close,
               CAST(sum(volume) AS BIGINT) AS volume
        FROM bars_min GROUP BY 1, 2"""),
    "holdings": ((), """
        SELECT 'F' || CAST(l_suppkey AS STRING) AS fund_code, make_date(y, 12, 31) AS date,
               'P' || CAST(l_partkey AS STRING) AS symbol, CAST(mkv AS DOUBLE) AS mkv,
               CAST(mkv AS DOUBLE) * 100
                 / CAST(sum(mkv) OVER (PARTITION BY l_suppkey, y) AS DOUBLE) AS stk_mkv_ratio
        FROM (SELECT l_suppkey, year(l_shipdate) AS y, l_partkey,
                     sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS mkv
              FROM lineitem GROUP BY 1, 2, 3) h"""),
    "fund_basic": ((), """
        SELECT 'F' || CAST(s_suppkey AS STRING) AS symbol, s_name AS csname
        FROM supplier WHERE s_suppkey % 10 <> 0"""),
    "source_b": (("bars_daily",), """
        SELECT symbol, date, open, high, low,
               CASE WHEN volume % 5 = 0 THEN close * CAST(1.01 AS DOUBLE) ELSE close END AS close,
               volume + volume % 3 AS volume, amount
        FROM bars_daily WHERE day(date) % 11 <> 0"""),
    "source_c": (("bars_daily",), """
        SELECT symbol, date,
               open * CASE WHEN volume % 4 = 0 THEN CAST(1.02 AS DOUBLE)
                           ELSE CAST(1.004 AS DOUBLE) END AS open,
               high, low, close, volume, CAST(NULL AS DOUBLE) AS amount
        FROM bars_daily
        WHERE day(date) % 7 <> 0 AND CAST(substr(symbol, 1, 6) AS INT) % 9 <> 0"""),
    "feed_dup": ((), """
        SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               l_extendedprice, l_discount, l_tax,
               row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
                 l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS seq
        FROM lineitem"""),
    "dirty": ((), """
        SELECT nullif(o_custkey, 7) AS symbol, CAST(o_orderdate AS DATE) AS date,
               '  ' || o_orderpriority || ' ' AS note,
               CASE WHEN o_orderkey % 50 = 0 THEN -o_totalprice
                    WHEN o_orderkey % 77 = 0 THEN NULL ELSE o_totalprice END AS close,
               o_orderkey AS seq
        FROM orders"""),
    "run_log": ((), """
        SELECT event_type AS table_name, CAST(ts AS DATE) AS data_date,
               CASE WHEN event_id % 7 = 0 THEN 'error' ELSE 'ok' END AS status,
               CAST(floor(value) AS BIGINT) AS rows_count, event_id AS id
        FROM events"""),
    "code_info": ((), """
        SELECT p_partkey AS code, p_retailprice AS pre_close, CAST(0.001 AS DOUBLE) AS price_tick
        FROM part"""),
    "trade_calendar": ((), """
        SELECT date, CASE WHEN isodow(date) <= 5 THEN '1' ELSE '0' END AS is_open
        FROM (SELECT CAST(o_orderdate AS DATE) AS date FROM orders
              UNION SELECT CAST(ts AS DATE) AS date FROM events) d"""),
    "bars_open": (("bars_daily", "trade_calendar"), """
        SELECT b.* FROM bars_daily b JOIN trade_calendar c ON b.date = c.date
        WHERE c.is_open = '1'"""),
    "raw_lines": (("bars_daily",), """
        SELECT symbol,
               CASE WHEN volume % 7 = 0 THEN 'bad,line'
                    ELSE concat_ws(',', CAST(date AS STRING), CAST(open AS STRING),
                      CASE WHEN volume % 6 = 0 THEN '-' ELSE CAST(close AS STRING) END,
                      CAST(high AS STRING), CAST(low AS STRING), CAST(volume AS STRING),
                      CAST(amount AS STRING), '0.0', '1.5') END AS line
        FROM bars_daily"""),
    "universe": ((), """
        SELECT lpad(CAST(c_custkey AS STRING), 6, '0')
                 || CASE WHEN c_custkey % 2 = 0 THEN '.SH' ELSE '.SZ' END AS code,
               c_name AS name, c_mktsegment AS type, '20130101' AS list_date
        FROM customer"""),
    "latest": (("holdings",), """
        SELECT * FROM holdings WHERE date = (SELECT max(date) FROM holdings)"""),
    "latest_per_fund": (("holdings",), """
        SELECT h.* FROM holdings h
        JOIN (SELECT fund_code, max(date) AS date FROM holdings GROUP BY 1) n
          ON h.fund_code = n.fund_code AND h.date = n.date"""),
    "changes": (("bars_daily",), """
        SELECT *, CASE WHEN prev = 0 THEN CASE WHEN close > 0 THEN CAST('Infinity' AS DOUBLE) END
                       ELSE (close / prev - 1) * 100 END AS pct_chg
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM bars_daily) w"""),
    "three_years": (("bars_daily",), """
        SELECT symbol, CAST(date - INTERVAL 24 MONTH AS DATE) AS date, open, high, low, close, volume, amount FROM bars_daily
        UNION ALL
        SELECT symbol, CAST(date - INTERVAL 12 MONTH AS DATE), open, high, low, close, volume, amount FROM bars_daily
        WHERE CAST(substr(symbol, 1, 6) AS INT) % 3 <> 0
        UNION ALL
        SELECT symbol, date, open, high, low, close, volume, amount FROM bars_daily
        WHERE CAST(substr(symbol, 1, 6) AS INT) % 3 <> 0"""),
    "last10": (("bars_daily",), """
        SELECT symbol, date, open, high, low, close, volume, amount,
               CASE WHEN prev = 0 THEN CASE WHEN close > 0 THEN CAST('Infinity' AS DOUBLE) END
                    ELSE (close / prev - 1) * 100 END AS pct_chg
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev
              FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn
                    FROM bars_daily) r WHERE rn <= 10) w"""),
    "cells": (("bars_daily", "source_b", "source_c"), """
        SELECT *, abs(a - b) / greatest(abs(a), abs(b)) AS rel,
               CASE WHEN field IN ('volume', 'amount') THEN CAST(0.02 AS DOUBLE)
                    ELSE CAST(0.005 AS DOUBLE) END AS threshold
        FROM (
          SELECT l.symbol, l.date, l.field, l.src AS src1, r.src AS src2, l.v AS a, r.v AS b
          FROM sides l JOIN sides r
            ON l.symbol = r.symbol AND l.date = r.date AND l.field = r.field AND l.src < r.src
        ) p WHERE NOT (a = 0 AND b = 0)"""),
    "diffs": (("cells",), """
        SELECT symbol, date, field, src1, src2, round(a, 6) AS val1, round(b, 6) AS val2,
               round(abs(a - b), 6) AS abs_diff, round(rel, 6) AS rel_diff, threshold
        FROM cells WHERE rel > threshold"""),
    "by_symbol": (("universe", "diffs"), """
        SELECT u.code AS symbol, coalesce(n_diffs, 0) AS n_diffs, coalesce(n_dates, 0) AS n_dates,
               round(1 - coalesce(n_diffs, 0) / greatest(coalesce(n_dates, 0) * 18, 1)::DOUBLE, 4)
                 AS consistency
        FROM universe u LEFT JOIN (
          SELECT symbol, count(*) AS n_diffs, count(DISTINCT date) AS n_dates FROM diffs GROUP BY 1
        ) d ON u.code = d.symbol"""),
}

_SIDE = """
        SELECT '{src}' AS src, symbol, date, '{f}' AS field, CAST({f} AS DOUBLE) AS v
        FROM {view} WHERE {f} IS NOT NULL"""
VIEWS["sides"] = (("bars_daily", "source_b", "source_c"), " UNION ALL ".join(
    _SIDE.format(src=src, f=f, view=view)
    for src, view in (("A", "bars_daily"), ("B", "source_b"), ("C", "source_c"))
    for f in ("open", "high", "low", "close", "volume", "amount")
))
VIEWS["cells"] = (("sides",), VIEWS["cells"][1])

_DATED = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
VIEWS["profiles"] = ((), " UNION ALL ".join(
    f"""
        SELECT '{t}' AS "table", count(*) AS rows,
               {f'CAST(min({_DATED[t]}) AS DATE)' if t in _DATED else 'CAST(NULL AS DATE)'} AS min_date,
               {f'CAST(max({_DATED[t]}) AS DATE)' if t in _DATED else 'CAST(NULL AS DATE)'} AS max_date
        FROM {t}"""
    for t in ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
              "lineitem", "nation", "orders", "pages", "part", "region", "supplier")
))


def _check(name: str, view: str, least: int, fresh: int, dupes: str) -> str:
    return f"""
        SELECT '{name}' AS "table", rows, min_date, max_date,
               concat_ws('; ',
                 CASE WHEN DATE '2024-01-30' - max_date > {fresh}
                      THEN 'STALE: ' || CAST(DATE '2024-01-30' - max_date AS STRING) || ' days since '
                           || CAST(max_date AS STRING) || ', allowed {fresh}' END,
                 CASE WHEN rows < {least}
                      THEN 'LOW_ROWS: ' || CAST(rows AS STRING) || ' < {least}' END,
                 CASE WHEN dupes > 0 THEN 'DUPLICATES: ' || CAST(dupes AS STRING) END) AS issues,
               CASE WHEN DATE '2024-01-30' - max_date > {fresh} OR rows < {least} OR dupes > 0
                    THEN 'warn' ELSE 'ok' END AS status
        FROM (SELECT count(*) AS rows, min(date) AS min_date, max(date) AS max_date,
                     {dupes} AS dupes FROM {view}) c"""


_DUPES = """count(*) - count(DISTINCT concat_ws('', CAST(date AS STRING), CAST(symbol AS STRING)))"""
_CHECK_DIRTY = _check("dirty", "dirty", 20000, 7, _DUPES)
VIEWS["checked"] = (("dirty", "bars_daily", "holdings", "trade_calendar"), " UNION ALL ".join([
    _CHECK_DIRTY,
    _check("etf_daily", "bars_daily", 30, 3, _DUPES),
    _check("fund_portfolio", "holdings", 1000, 120, _DUPES),
    _check("trade_calendar", "trade_calendar", 4380, 7, "0"),
]))


def with_views(body: str, *names: str) -> str:
    """The body with the views it reads, and those they read, as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    # materialized: several bodies read a view many times
    listed = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n][1]})" for n in order)
    # a body that starts with a comma goes on with the list
    return listed + ("" if body.startswith(",") else "\n") + body


_LAST_OF_FEED = """
    SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq {way}) AS rn
          FROM feed_dup) r WHERE rn = 1"""
_BAR = "symbol, date, open, high, low, close, volume, amount"
_CONCENTRATION = """
        SELECT fund_code, count(*) AS n_holdings,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) FILTER (rn <= 3) AS DOUBLE) AS top3,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) FILTER (rn <= 5) AS DOUBLE) AS top5
        FROM (SELECT *, row_number() OVER (PARTITION BY fund_code ORDER BY stk_mkv_ratio DESC, symbol) AS rn
              FROM {view}) r GROUP BY 1"""
_WEEKDAYS = """len([d FOR d IN generate_series(first_date::TIMESTAMP, last_date::TIMESTAMP, INTERVAL 1 DAY)
                       IF isodow(d) <= 5])"""
_GAPS = """
    SELECT {key} first_date, last_date, days,
           CAST(CASE WHEN n < 2 THEN 0 ELSE greatest({weekdays} - days, 0) END AS BIGINT) AS missing_days
    FROM (SELECT {key} min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS days,
                 count(date) AS n FROM bars_open {group}) g"""


# query -> (SQL, views it reads)
_SQL: dict[str, tuple[str, ...]] = {  # the SQL comes first
    "s1_scan_bars": (f"SELECT {_BAR} FROM bars_daily", "bars_daily"),
    "s2_minute_scan": ("SELECT * FROM bars_min", "bars_min"),
    "s3_unpartitioned": ("SELECT * FROM fund_basic", "fund_basic"),
    "s4_read_where": ("SELECT symbol, close, date FROM bars_daily WHERE close > open", "bars_daily"),
    "s6_code_list": ("SELECT code FROM universe", "universe"),
    "s7_code_info": ("SELECT * FROM code_info WHERE code IN (SELECT l_partkey FROM lineitem)", "code_info"),
    "s8_fund_list": ("SELECT code AS symbol, name, type, list_date FROM universe", "universe"),
    "s11_parse_lines": ("""
        SELECT symbol, replace(p[1], '-', '') AS date, try_cast(p[2] AS DOUBLE) AS open,
               try_cast(p[4] AS DOUBLE) AS high, try_cast(p[5] AS DOUBLE) AS low,
               try_cast(p[3] AS DOUBLE) AS close, try_cast(p[6] AS DOUBLE) AS volume,
               try_cast(p[7] AS DOUBLE) AS amount, try_cast(p[9] AS DOUBLE) AS pct_chg,
               CAST(NULL AS DOUBLE) AS change, CAST(NULL AS DOUBLE) AS turnover_rate
        FROM (SELECT symbol, string_split(line, ',') AS p FROM raw_lines) r
        WHERE len(p) >= 7 AND try_cast(p[3] AS DOUBLE) IS NOT NULL""", "raw_lines"),
    "s12_json_bars": ("""
        SELECT symbol, strftime(date, '%Y%m%d') AS date, open, high, low, close,
               CAST(CASE WHEN volume % 6 = 0 THEN 0 ELSE volume END AS DOUBLE) AS volume
        FROM bars_daily WHERE volume % 7 <> 0""", "bars_daily"),
    "s12_json_props": ("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",),
    "s13_nested_bars": ("""
        SELECT symbol, CAST(date AS STRING) AS date, open, high, low, close,
               CAST(volume AS DOUBLE) AS volume
        FROM bars_daily WHERE volume % 7 <> 0 AND volume % 6 <> 0
          AND CAST(substr(symbol, 1, 6) AS INT) % 9 <> 0""", "bars_daily"),
    "s14_minute_tokens": ("""
        SELECT strftime(kline_time, '%H%M') AS time, close AS price, CAST(volume AS DOUBLE) AS volume,
               CASE WHEN minute(kline_time) % 5 = 0 THEN 0 ELSE amount END AS amount, symbol
        FROM bars_min WHERE minute(kline_time) % 7 <> 0""", "bars_min"),
    "s15_spot_list": ("""
        SELECT symbol, 'N' || symbol AS name, CASE WHEN volume % 6 <> 0 THEN close END AS close,
               CAST(NULL AS DOUBLE) AS pct_chg, CAST(volume AS DOUBLE) AS volume, amount
        FROM bars_daily""", "bars_daily"),
    "s16_text_bars": ("""
        SELECT symbol, strftime(date, '%Y%m%d') AS date,
               CASE WHEN volume % 6 <> 0 THEN open END AS open, high, low, close,
               CAST(volume AS DOUBLE) AS volume,
               CASE WHEN volume % 5 = 0 THEN 0 ELSE amount END AS amount
        FROM bars_daily""", "bars_daily"),
    "s17_adjustments": ("""
        SELECT symbol, strftime(date, '%Y%m%d') AS date,
               CASE WHEN volume % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE close END AS adj_factor
        FROM bars_daily""", "bars_daily"),
    "s18_open_days": ("""
        SELECT date, CAST(strftime(date, '%Y%m%d') AS INT) AS day
        FROM trade_calendar WHERE is_open = '1'""", "trade_calendar"),
    "s19_localized_bars": ("""
        SELECT symbol AS code, CAST(date AS TIMESTAMP) AS kline_time, open, high, low, close,
               volume, amount FROM bars_daily""", "bars_daily"),
    "s20_tagged_union": (f"""
        SELECT {_BAR}, 'user' AS origin FROM bars_daily UNION ALL
        SELECT symbol, date, open, high, low, close, volume, NULL, 'type' FROM bars_by_type""",
        "bars_daily", "bars_by_type"),
    "s21_landed_alias": ("""
        SELECT symbol AS ts_code, date AS trade_date, close, split_part(symbol, '.', 2) AS exchange_code,
               split_part(symbol, '.', 1) AS etf_code FROM bars_daily""", "bars_daily"),
    "s22_bars_by_period": (f"""
        SELECT {_BAR} FROM bars_daily WHERE symbol IN (SELECT code FROM universe)""",
        "bars_daily", "universe"),
    "k1_write_series": ("""
        SELECT *, CAST(year(kline_time) AS INT) AS year, CAST(month(kline_time) AS INT) AS month
        FROM bars_min""", "bars_min"),
    "k1_minute_text": ("SELECT * FROM bars_min", "bars_min"),
    "k2_replace_columns": ("SELECT csname, CAST(length(symbol) AS INT) AS symbol FROM fund_basic", "fund_basic"),
    "k2_write_table": ("SELECT * FROM fund_basic WHERE csname IS NOT NULL", "fund_basic"),
    "k3_write_modes": ("""
        SELECT symbol, date, open, high, low,
               CASE WHEN gone THEN close * 2 ELSE close END AS close, volume, amount
        FROM (SELECT *, symbol LIKE '%.SH' AND day(date) > 20 AS late,
                     bool_or(symbol LIKE '%.SH' AND day(date) > 20)
                       OVER (PARTITION BY symbol, year(date)) AS gone FROM bars_daily) b
        WHERE late OR NOT gone""", "bars_daily"),
    "k4_upsert": (_LAST_OF_FEED.format(way="DESC"), "feed_dup"),
    "k4_upsert_bars": (f"""
        SELECT {_BAR} FROM source_b UNION ALL
        SELECT {_BAR} FROM source_c c WHERE NOT EXISTS (
          SELECT 1 FROM source_b b WHERE b.symbol = c.symbol AND b.date = c.date)""",
        "source_b", "source_c"),
    "k5_merge_null_keys": ("""
        SELECT symbol, date, note, close, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC, seq DESC) AS rn FROM dirty
        ) r WHERE rn = 1 OR symbol IS NULL""", "dirty"),
    "k6_nan_to_null": ("""
        SELECT symbol, date, open, high, low, CASE WHEN volume % 6 <> 0 THEN close END AS close,
               volume, amount FROM bars_daily""", "bars_daily"),
    "k7_database_types": ("""
        SELECT 'table_name' AS "column",
               'NVARCHAR(' || CAST(max(length(table_name)) * 2 AS STRING) || ')' AS type FROM run_log
        UNION ALL SELECT 'status', 'NVARCHAR(' || CAST(max(length(status)) * 2 AS STRING) || ')' FROM run_log
        UNION ALL SELECT 'run_date', 'DATETIME2'
        UNION ALL SELECT 'data_date', 'DATETIME2'
        UNION ALL SELECT 'rows_count', 'BIGINT'
        UNION ALL SELECT 'id', 'BIGINT'""", "run_log"),
    "k8_multi_target": ("""
        SELECT target, symbol, count(*) AS n_rows, CAST(sum(volume) AS BIGINT) AS volume, max(close) AS close
        FROM bars_daily, (VALUES ('one'), ('two')) v(target) GROUP BY 1, 2""", "bars_daily"),
    "k10_log_update": ("""
        SELECT 'etf_daily' AS table_name, 'backfill' AS run_type, '2024-01-30' AS run_date,
               '2024-01-30' AS data_date, symbol, 'events' AS source, 'ok' AS status,
               count(*) AS rows_count FROM bars_daily GROUP BY symbol
        UNION ALL
        SELECT 'fund_portfolio', 'backfill', '2024-01-30', '2024-01-30', NULL, 'lineitem', 'ok', count(*)
        FROM holdings""", "bars_daily", "holdings"),
    "k11_json_records": ("""
        SELECT '{"id":' || CAST(id AS STRING) || ',"table_name":"' || table_name || '","data_date":"'
               || CAST(data_date AS STRING) || '","status":"' || status || '","rows_count":'
               || CAST(rows_count AS STRING) || '}' AS record FROM run_log""", "run_log"),
    "p1_transforms": ("""
        SELECT fund_code AS fund, date, symbol, CAST(trunc(mkv) AS BIGINT) AS mkv,
               'lineitem' AS origin, '' AS note FROM holdings""", "holdings"),
    "p2_drop": ("SELECT symbol, date, open, high, low, close, volume FROM bars_daily", "bars_daily"),
    "p3_astype": ("""
        SELECT symbol, CAST(date AS TIMESTAMP) AS date, open, high, low, close,
               CAST(volume AS INT) AS volume, amount FROM bars_daily""", "bars_daily"),
    "p4_add_column": ("SELECT *, 'fund' AS kind FROM fund_basic", "fund_basic"),
    "p6_price_names": ("""
        SELECT symbol, date AS trade_date, open AS open_price, high AS high_price, low AS low_price,
               close AS close_price, volume, amount FROM bars_daily""", "bars_daily"),
    "p5_normalize_names": ("""
        SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount,
               1 AS volume FROM orders""",),
    "p6_consumer_names": ("""
        SELECT symbol, CAST(kline_time AS DATE) AS date, open, high, low, close, volume, amount
        FROM bars_min""", "bars_min"),
    "p8_symbol_list": (f"SELECT {_BAR} FROM bars_daily WHERE symbol IN (SELECT code FROM universe)",
                       "bars_daily", "universe"),
    "p9_date_range": ("""SELECT * FROM bars_min
        WHERE kline_time >= DATE '2024-01-08' AND kline_time < DATE '2024-01-20'""", "bars_min"),
    "p10_minute_day": ("SELECT * FROM bars_min WHERE CAST(kline_time AS DATE) = DATE '2024-01-15'", "bars_min"),
    "p11_complete_symbol": ("""
        SELECT name, CASE WHEN type = 'BUILDING' THEN substr(code, 1, 6) || '.SH' ELSE code END AS symbol
        FROM universe""", "universe"),
    "p12_symbol_dialects": ("""
        SELECT code, lower(split_part(code, '.', 2)) || '.' || substr(code, 1, 6) AS dotted,
               lower(split_part(code, '.', 2)) || substr(code, 1, 6) AS prefixed,
               CASE WHEN code LIKE '%.SH' THEN '1.' ELSE '0.' END || substr(code, 1, 6) AS numbered,
               substr(code, 1, 6) AS bare, substr(code, 1, 6) AS stripped, code AS back
        FROM universe""", "universe"),
    "p13_date_dialects": ("""
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS number,
               CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
               strftime(o_orderdate, '%Y%m%d') AS dashless FROM orders""",),
    "p14_split_code": ("""
        SELECT code AS ts_code, name, split_part(code, '.', 2) AS exchange_code,
               split_part(code, '.', 1) AS etf_code FROM universe""", "universe"),
    "p15_lookback": ("""
        SELECT * FROM bars_daily WHERE date BETWEEN DATE '2024-01-25' AND DATE '2024-01-30'""", "bars_daily"),
    "p16_price_limits": ("""
        SELECT code, pre_close,
               round(round(pre_close * CAST(1.1 AS DOUBLE) / price_tick) * price_tick, 3) AS high_limited,
               round(round(pre_close * CAST(0.9 AS DOUBLE) / price_tick) * price_tick, 3) AS low_limited
        FROM code_info""", "code_info"),
    "p18_display_name": ("""
        SELECT DISTINCT fund_code, coalesce(csname, fund_code) AS fund_name
        FROM holdings h LEFT JOIN fund_basic b ON h.fund_code = b.symbol""", "holdings", "fund_basic"),
    "p19_bands": ("""
        SELECT symbol, CASE WHEN consistency >= 0.95 THEN 'green' WHEN consistency >= 0.8 THEN 'yellow'
                            ELSE 'red' END AS band FROM by_symbol""", "by_symbol"),
    "v2_drop_null_keys": ("SELECT * FROM dirty WHERE symbol IS NOT NULL AND date IS NOT NULL", "dirty"),
    "v3_keep_last": (_LAST_OF_FEED.format(way="DESC"), "feed_dup"),
    "v3_keep_last_null_keys": ("""
        SELECT symbol, date, note, close, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) AS rn FROM dirty
        ) r WHERE rn = 1""", "dirty"),
    "v4_strip_strings": ("SELECT symbol, date, trim(note) AS note, close, seq FROM dirty", "dirty"),
    "v5_ranges": ("""
        SELECT *, close IS NULL OR close < 0.001 OR close > 200000 AS close_bad FROM dirty""", "dirty"),
    "v6_preset_daily": ("""
        SELECT symbol, date, trim(note) AS note, close, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) AS rn
          FROM dirty WHERE symbol IS NOT NULL AND date IS NOT NULL) r WHERE rn = 1""", "dirty"),
    "v6_preset_basic": ("""
        SELECT symbol, csname AS name, CASE WHEN symbol = 'F1' THEN 1 ELSE 2 END AS seq FROM fund_basic""", "fund_basic"),
    "v8_report": ("""
        , kept AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) AS rn
                         FROM dirty WHERE symbol IS NOT NULL) r WHERE rn = 1),
        c AS (SELECT (SELECT count(*) FROM dirty) AS before, (SELECT count(*) FROM kept) AS after,
                     (SELECT count(*) FROM dirty WHERE symbol IS NULL) AS nulls,
                     (SELECT count(*) FROM kept
                      WHERE close IS NULL OR close < 0.001 OR close > 200000) AS bad)
        SELECT * FROM (
          SELECT 'error' AS level, 'missing_columns' AS rule, 'name' AS detail, 1 AS count FROM c
          UNION ALL SELECT 'warn', 'null_keys', 'symbol', nulls FROM c
          UNION ALL SELECT 'warn', 'dedup', 'symbol, date', before - nulls - after FROM c
          UNION ALL SELECT 'warn', 'range', 'close [0.001, 200000]', bad FROM c
          UNION ALL SELECT 'warn', 'total_dropped', 'rows', before - after FROM c) f
        WHERE count > 0""", "dirty"),
    "j1_holdings_named": ("""
        SELECT h.*, b.csname AS fund_name FROM holdings h LEFT JOIN fund_basic b
          ON h.fund_code = b.symbol""", "holdings", "fund_basic"),
    "j3_common_dates": ("""
        SELECT b.symbol, b.date, b.close AS close_b, c.close AS close_c
        FROM source_b b JOIN source_c c ON b.symbol = c.symbol AND b.date = c.date""",
        "source_b", "source_c"),
    "j4_symbol_fallback": (f"""
        SELECT {_BAR}, 'c' AS source FROM source_c UNION ALL
        SELECT {_BAR}, 'a' FROM bars_daily WHERE symbol NOT IN (SELECT symbol FROM source_c)""",
        "bars_daily", "source_c"),
    "j4_day_fallback": (f"""
        SELECT {_BAR}, 'c' AS source FROM source_c UNION ALL
        SELECT {_BAR}, 'b' FROM source_b b WHERE NOT EXISTS (
          SELECT 1 FROM source_c c WHERE c.symbol = b.symbol AND c.date = b.date) UNION ALL
        SELECT {_BAR}, 'a' FROM bars_daily a WHERE NOT EXISTS (
          SELECT 1 FROM source_c c WHERE c.symbol = a.symbol AND c.date = a.date) AND NOT EXISTS (
          SELECT 1 FROM source_b b WHERE b.symbol = a.symbol AND b.date = a.date)""",
        "bars_daily", "source_b", "source_c"),
    "j5_table_fallback": (f"SELECT {_BAR}, 'c' AS used_source FROM source_c", "source_c"),
    "j6_open_days": (f"SELECT {_BAR} FROM bars_open", "bars_open"),
    "j7_membership": ("SELECT * FROM universe WHERE code IN (SELECT symbol FROM bars_daily)",
                      "universe", "bars_daily"),
    "j8_missing_days": ("""
        SELECT s.symbol, c.date
        FROM (SELECT symbol, min(date) AS a, max(date) AS z FROM bars_open GROUP BY 1) s
        JOIN trade_calendar c ON c.date BETWEEN s.a AND s.z AND c.is_open = '1'
        WHERE NOT EXISTS (SELECT 1 FROM bars_open b WHERE b.symbol = s.symbol AND b.date = c.date)""",
        "bars_open", "trade_calendar"),
    "j8_missing_recent": ("""
        SELECT s.symbol, c.date
        FROM (SELECT symbol, min(date) AS a FROM bars_open GROUP BY 1) s
        JOIN (SELECT date FROM trade_calendar WHERE is_open = '1' AND date <= DATE '2024-01-30'
              ORDER BY date DESC LIMIT 10) c ON c.date >= s.a
        WHERE NOT EXISTS (SELECT 1 FROM bars_open b WHERE b.symbol = s.symbol AND b.date = c.date)""",
        "bars_open", "trade_calendar"),
    "a1_profile": ("SELECT * FROM profiles", "profiles"),
    "a2_freshness": ("""
        SELECT *, CAST(DATE '2024-01-30' - max_date AS INT) AS stale_days,
               coalesce(DATE '2024-01-30' - max_date > 3, false) AS stale FROM profiles""", "profiles"),
    "a3_row_floor": ("SELECT *, rows < 1000 AS low_rows FROM profiles", "profiles"),
    "a4_duplicates": (f"SELECT {_DUPES} AS duplicates FROM dirty", "dirty"),
    "a5_check_table": (_CHECK_DIRTY, "dirty"),
    "a6_headline": ("""
        SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'warn') AS warn,
               count(*) FILTER (status = 'error') AS error FROM checked""", "checked"),
    "a7_inventory": ("""
        SELECT "table", rows, max_date,
               least(rows / greatest((SELECT sum(rows)::DOUBLE / count(*) FROM profiles), 1) * 100, 100) AS bar
        FROM profiles""", "profiles"),
    "a7_inventory_headline": ("""
        SELECT CAST(sum(rows) AS BIGINT) AS total_rows, count(*) AS tables,
               count(*) FILTER (rows > 0) AS nonempty_tables FROM profiles""", "profiles"),
    "a8_last_update": ("""
        SELECT table_name, max(data_date) AS last_update FROM run_log WHERE status = 'ok' GROUP BY 1""",
        "run_log"),
    "a9_updated_days": ("""
        SELECT DISTINCT table_name, data_date FROM run_log
        WHERE status = 'ok' AND data_date >= DATE '2024-01-23'""", "run_log"),
    "a10_completeness": (_GAPS.format(key="symbol,", group="GROUP BY symbol", weekdays=_WEEKDAYS), "bars_open"),
    "a10_completeness_pooled": (_GAPS.format(key="", group="", weekdays=_WEEKDAYS), "bars_open"),
    "a11_extreme_moves": ("""
        SELECT symbol, count(*) FILTER (abs(pct_chg) > 11) AS extreme_moves FROM changes GROUP BY 1""", "changes"),
    "a12_fetch_metadata": ("""
        SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date,
               'symbol,trade_date,open,high,low,close,volume,amount' AS columns FROM bars_daily""", "bars_daily"),
    "a13_headline": ("""
        SELECT max(date) AS latest_date, count(DISTINCT fund_code) AS n_funds,
               count(DISTINCT symbol) AS n_stocks FROM latest""", "latest"),
    "a14_overlap": ("""
        SELECT symbol, count(DISTINCT fund_code) AS fund_count,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) AS DOUBLE) / count(stk_mkv_ratio) AS avg_ratio
        FROM latest WHERE stk_mkv_ratio >= 3 GROUP BY 1
        ORDER BY fund_count DESC, symbol LIMIT 20""", "latest"),
    "a14_overlap_all": ("""
        SELECT symbol, count(DISTINCT fund_code) AS fund_count,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) AS DOUBLE) / count(stk_mkv_ratio) AS avg_ratio
        FROM latest_per_fund WHERE stk_mkv_ratio >= 3 GROUP BY 1""", "latest_per_fund"),
    "a15_concentration": (_CONCENTRATION.format(view="latest"), "latest"),
    "w4_top_k_sum": ("""
        SELECT fund_code, date, count(*) AS n_holdings,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) FILTER (rn <= 3) AS DOUBLE) AS top3,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) FILTER (rn <= 5) AS DOUBLE) AS top5
        FROM (SELECT *, row_number() OVER (PARTITION BY fund_code, date ORDER BY stk_mkv_ratio DESC, symbol) AS rn
              FROM holdings) r GROUP BY 1, 2""", "holdings"),
    "a16_consistency": ("SELECT * FROM by_symbol", "by_symbol"),
    "a16_consistency_all_cells": ("""
        SELECT symbol, count(*) AS n_cells, count(*) FILTER (rel > threshold) AS n_diffs,
               round(1 - count(*) FILTER (rel > threshold) / count(*)::DOUBLE, 4) AS consistency_all
        FROM cells GROUP BY 1""", "cells"),
    "a17_overall": ("""
        SELECT count(*) AS n_symbols,
               round(CAST(sum(CAST(consistency AS DECIMAL(28,4))) AS DOUBLE) / count(*), 4) AS avg_consistency,
               CAST(sum(n_diffs) AS BIGINT) AS total_diffs FROM by_symbol""", "by_symbol"),
    "a18_by_field": ("""
        SELECT field, count(*) AS n_diffs, count(*) / (SELECT count(*) FROM diffs)::DOUBLE AS share
        FROM diffs GROUP BY 1""", "diffs"),
    "a19_by_pair": ("""
        SELECT src1 || ' vs ' || src2 AS pair, count(*) AS n_diffs,
               count(*) / (SELECT count(*) FROM diffs)::DOUBLE AS share FROM diffs GROUP BY 1""", "diffs"),
    "a20_symbol_details": ("""
        SELECT symbol, n_dates, n_dates * 18 AS comparisons, n_diffs, consistency,
               CASE WHEN consistency >= 0.95 THEN 'green' WHEN consistency >= 0.8 THEN 'yellow'
                    ELSE 'red' END AS band FROM by_symbol""", "by_symbol"),
    "a21_run_summary": ("""
        SELECT data_date, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status <> 'ok') AS failed,
               CAST(coalesce(sum(rows_count) FILTER (status = 'ok'), 0) AS BIGINT) AS rows_written
        FROM run_log GROUP BY 1""", "run_log"),
    "a22_rows_by_symbol": ("SELECT symbol, count(*) AS rows_count FROM bars_daily GROUP BY 1", "bars_daily"),
    "w2_last_n_bars": ("SELECT * FROM last10", "last10"),
    "w3_top5_holdings": ("""
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY fund_code ORDER BY stk_mkv_ratio DESC, symbol) AS INT)
                   AS rank FROM latest) r WHERE rank <= 5""", "latest"),
    "w5_keep_first": (_LAST_OF_FEED.format(way="ASC"), "feed_dup"),
    "w6_close_matrix_long": ("""
        SELECT date, symbol, close FROM bars_daily
        WHERE date IN (SELECT DISTINCT date FROM bars_daily ORDER BY date DESC LIMIT 10)""", "bars_daily"),
    "o1_sorted_series": ("SELECT * FROM bars_daily", "bars_daily"),
    "o2_first_symbols": ("SELECT * FROM universe ORDER BY code LIMIT 100", "universe"),
    "u1_concat": (f"""
        SELECT symbol, date, open, high, low, close, volume, CAST(NULL AS DOUBLE) AS amount FROM source_b
        UNION ALL SELECT {_BAR} FROM source_c""", "source_b", "source_c"),
    "u2_union_distinct": (f"""
        SELECT {_BAR} FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol, date
                   ORDER BY close DESC, volume DESC, open DESC, amount DESC NULLS LAST) AS rn
          FROM (SELECT {_BAR} FROM source_b UNION ALL SELECT {_BAR} FROM source_c) u) r
        WHERE rn = 1""", "source_b", "source_c"),
    "u3_common_dates": ("""
        SELECT symbol, date FROM source_b INTERSECT SELECT symbol, date FROM source_c""",
        "source_b", "source_c"),
    "u4_symbols_lacking": ("""
        SELECT DISTINCT symbol FROM bars_daily WHERE symbol NOT IN (SELECT symbol FROM source_c)""",
        "bars_daily", "source_c"),
    "c1_source_diffs": ("SELECT * FROM diffs", "diffs"),
    "c1_diffs_in_buckets": ("SELECT * FROM diffs", "diffs"),
    "v3_keep_last_in_buckets": (f"SELECT {_BAR} FROM source_b", "source_b"),
    "a13_estimated_distinct": ("""
        SELECT 'funds' AS name, count(DISTINCT fund_code) AS exact, true AS close FROM holdings
        UNION ALL SELECT 'stocks', count(DISTINCT symbol), true FROM holdings
        UNION ALL SELECT 'positions', count(DISTINCT fund_code || '|' || symbol), true FROM holdings""", "holdings"),
    "a4_estimated_duplicates": ("""
        SELECT (SELECT 2 * count(*) FROM bars_daily) + (SELECT count(*) FROM source_b) AS rows,
               true AS symbols_close, true AS days_close""", "bars_daily", "source_b"),
    "c2_run_task": ("""
        SELECT symbol, CAST(p[1] AS DATE) AS date, try_cast(p[2] AS DOUBLE) AS open,
               try_cast(p[4] AS DOUBLE) AS high, try_cast(p[5] AS DOUBLE) AS low,
               try_cast(p[3] AS DOUBLE) AS close, try_cast(p[6] AS DOUBLE) AS volume,
               try_cast(p[7] AS DOUBLE) AS amount, try_cast(p[9] AS DOUBLE) AS pct_chg,
               CAST(NULL AS DOUBLE) AS change, CAST(NULL AS DOUBLE) AS turnover_rate, 1 AS seq
        FROM (SELECT symbol, string_split(line, ',') AS p FROM raw_lines) r
        WHERE len(p) >= 7 AND try_cast(p[3] AS DOUBLE) IS NOT NULL AND CAST(p[1] AS DATE) >= DATE '2024-01-08'""",
        "raw_lines"),
    "c4_completeness_message": (f"""
        SELECT nullif(concat_ws(', ',
                 CASE WHEN weekdays - days > 0
                      THEN 'missing ' || CAST(weekdays - days AS STRING) || ' trading days' END,
                 CASE WHEN extreme > 0
                      THEN CAST(extreme AS STRING) || ' extreme moves (>11)' END), '') AS message
        FROM (SELECT *, {_WEEKDAYS} AS weekdays
              FROM (SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS days,
                           count(*) FILTER (abs(pct_chg) > 11) AS extreme FROM changes) g) w""", "changes"),
    "c5_quality_report": ("SELECT * FROM checked", "checked"),
    "c5_alerts": ("""SELECT "table", status FROM checked WHERE status <> 'ok'""", "checked"),
    "c6_holdings_analysis": ("""
        SELECT fund_code, date, symbol, mkv, stk_mkv_ratio, coalesce(csname, fund_code) AS fund_name, rank
        FROM (SELECT h.*, b.csname, CAST(row_number() OVER (
                       PARTITION BY fund_code ORDER BY stk_mkv_ratio DESC, h.symbol) AS INT) AS rank
              FROM latest_per_fund h LEFT JOIN fund_basic b ON h.fund_code = b.symbol) r
        WHERE rank <= 5""", "latest_per_fund", "fund_basic"),
    "c7_inventory": ("""
        , p AS (SELECT 'etf_universe' AS "table", count(*) AS rows,
                       CAST(strptime(max(list_date), '%Y%m%d') AS DATE) AS max_date FROM universe
                UNION ALL SELECT 'code_info', count(*), NULL FROM code_info
                UNION ALL SELECT 'etf_basic', count(*), NULL FROM fund_basic)
        SELECT "table", rows, max_date,
               least(rows / greatest((SELECT sum(rows)::DOUBLE / count(*) FROM p), 1) * 100, 100) AS bar
        FROM p""", "universe", "code_info", "fund_basic"),
    "c8_backfill": ("""
        SELECT 'etf_daily' AS table_name, 'ok' AS status, count(*) AS n_rows,
               count(DISTINCT symbol) AS n_symbols FROM bars_daily
        UNION ALL SELECT 'etf_min1', 'ok', count(*), count(DISTINCT symbol) FROM bars_min
        UNION ALL SELECT 'etf_nav', 'ok', count(*), 0 FROM bars_by_type
        UNION ALL SELECT 'etf_universe', 'ok', count(*), 0 FROM universe""",
        "bars_daily", "bars_min", "bars_by_type", "universe"),
    "c9_update_day": (f"""
        SELECT {_BAR} FROM bars_daily WHERE date < DATE '2024-01-30' UNION ALL
        SELECT {_BAR} FROM source_c WHERE date = DATE '2024-01-30' UNION ALL
        SELECT {_BAR} FROM bars_daily WHERE date = DATE '2024-01-30' AND symbol NOT IN (
          SELECT symbol FROM source_c WHERE date = DATE '2024-01-30')""", "bars_daily", "source_c"),
    "c10_backfill_missing": (f"""
        , missing AS (
          SELECT s.symbol, c.date
          FROM (SELECT symbol, min(date) AS a FROM source_c GROUP BY 1) s
          JOIN trade_calendar c ON c.date BETWEEN s.a AND DATE '2024-01-30' AND c.is_open = '1'
          WHERE NOT EXISTS (SELECT 1 FROM source_c b WHERE b.symbol = s.symbol AND b.date = c.date)),
        from_b AS (SELECT b.* FROM source_b b JOIN missing m ON b.symbol = m.symbol AND b.date = m.date)
        SELECT {_BAR} FROM source_c UNION ALL SELECT {_BAR} FROM from_b UNION ALL
        SELECT a.symbol, a.date, open, high, low, close, volume, amount
        FROM bars_daily a JOIN missing m ON a.symbol = m.symbol AND a.date = m.date
        WHERE NOT EXISTS (SELECT 1 FROM from_b b WHERE b.symbol = a.symbol AND b.date = a.date)""",
        "bars_daily", "source_b", "source_c", "trade_calendar"),
    "c10_backfill_universe": (f"""
        , missing AS (
          SELECT s.symbol, c.date
          FROM (SELECT DISTINCT symbol FROM bars_daily) s
          JOIN (SELECT DISTINCT date FROM trade_calendar WHERE is_open = '1' AND date <= DATE '2024-01-30'
                ORDER BY date DESC LIMIT 10) c ON true
          WHERE NOT EXISTS (SELECT 1 FROM source_c b WHERE b.symbol = s.symbol AND b.date = c.date)),
        from_b AS (SELECT b.* FROM source_b b JOIN missing m ON b.symbol = m.symbol AND b.date = m.date)
        SELECT {_BAR} FROM source_c UNION ALL SELECT {_BAR} FROM from_b UNION ALL
        SELECT a.symbol, a.date, open, high, low, close, volume, amount
        FROM bars_daily a JOIN missing m ON a.symbol = m.symbol AND a.date = m.date
        WHERE NOT EXISTS (SELECT 1 FROM from_b b WHERE b.symbol = a.symbol AND b.date = a.date)""",
        "bars_daily", "source_b", "source_c", "trade_calendar"),
    "c9_update_minutes": ("""
        SELECT symbol, kline_time - INTERVAL 31 DAY AS kline_time, open, high, low, close, volume, amount FROM bars_min
        UNION ALL SELECT symbol, kline_time, open, high, low, close, volume, amount FROM bars_min
        WHERE kline_time < DATE '2024-01-31'""", "bars_min"),
    "k1_overwrite_one_symbol": ("""
        SELECT symbol, CAST(date - INTERVAL 12 MONTH AS DATE) AS date, open, high, low, close, volume, amount FROM bars_daily
        UNION ALL SELECT symbol, date, open, high, low, CASE WHEN symbol LIKE '%.SH' THEN close * 2 ELSE close END, volume, amount
        FROM bars_daily""", "bars_daily"),
    "k4_upsert_null_date": (f"""
        SELECT {_BAR} FROM bars_daily UNION ALL
        SELECT symbol, NULL, max(open), max(high), max(low),
               CASE WHEN symbol LIKE '%.SH' THEN max(close) * 2 ELSE max(close) END, max(volume), max(amount)
        FROM bars_daily GROUP BY symbol""", "bars_daily"),
    "k4_upsert_new_column": ("""
        SELECT symbol, CAST(date - INTERVAL 12 MONTH AS DATE) AS date, open, high, low, close, volume, amount,
               CAST(NULL AS DOUBLE) AS pct_chg FROM bars_daily
        UNION ALL SELECT symbol, date, open, high, low, CASE WHEN symbol LIKE '%.SH' THEN close * 2 ELSE close END,
               volume, amount, CASE WHEN symbol LIKE '%.SH' THEN NULL ELSE 1.5 END FROM bars_daily""", "bars_daily"),
    "j4_symbol_fallback_null": (f"""
        , c AS (SELECT * REPLACE (CASE WHEN volume % 5 <> 0 THEN symbol END AS symbol) FROM source_c),
        a AS (SELECT * REPLACE (CASE WHEN volume % 5 <> 0 THEN symbol END AS symbol) FROM bars_daily)
        SELECT {_BAR}, 'c' AS source FROM c UNION ALL
        SELECT {_BAR}, 'a' FROM a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.symbol IS NOT DISTINCT FROM a.symbol)""",
        "bars_daily", "source_c"),
    "a21_task_log": ("""
        SELECT 'etf_daily' AS table_name, 1 AS ok, 0 AS failed,
               (SELECT count(*) FROM (SELECT string_split(line, ',') AS p FROM raw_lines) r
                WHERE len(p) >= 7 AND try_cast(p[3] AS DOUBLE) IS NOT NULL) AS rows_written
        UNION ALL SELECT 'etf_nav', 0, 1, 0""", "raw_lines"),
    "w2_newest_from_store": ("""
        SELECT symbol, date, open, high, low, close, volume, amount,
               CASE WHEN prev = 0 THEN CASE WHEN close > 0 THEN CAST('Infinity' AS DOUBLE) END
                    ELSE (close / prev - 1) * 100 END AS pct_chg
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev
              FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM three_years) r
              WHERE rn <= 40) w""", "three_years"),
    "w6_closes_from_store": ("""
        SELECT date, symbol, close FROM three_years
        WHERE date IN (SELECT DISTINCT date FROM three_years ORDER BY date DESC LIMIT 35)""", "three_years"),
    "c5_quality_store": ("""
        SELECT 'etf_daily' AS "table", count(*) AS rows, min(date) AS min_date, max(date) AS max_date,
               concat_ws('; ',
                 CASE WHEN date_diff('day', max(date), DATE '2024-01-30') > 3 THEN 'STALE: ' || CAST(date_diff('day', max(date), DATE '2024-01-30') AS VARCHAR)
                      || ' days since ' || CAST(max(date) AS VARCHAR) || ', allowed 3' END,
                 CASE WHEN count(*) < 30 THEN 'LOW_ROWS: ' || CAST(count(*) AS VARCHAR) || ' < 30' END) AS issues,
               CASE WHEN count(*) < 30 OR date_diff('day', max(date), DATE '2024-01-30') > 3 THEN 'warn' ELSE 'ok' END AS status
        FROM bars_daily
        UNION ALL SELECT unnest(['trade_calendar', 'etf_basic', 'etf_adj_factor', 'etf_share', 'etf_nav', 'index_daily',
                                 'fund_portfolio', 'stk_limit', 'etf_spot_ths', 'etf_scale_sse', 'etf_minute']),
               0, NULL, NULL, 'ERROR: no such table', 'error'""", "bars_daily"),
    "c6_headline": ("""
        SELECT max(date) AS latest_date, count(DISTINCT fund_code) AS n_funds,
               count(DISTINCT symbol) AS n_stocks FROM latest_per_fund""", "latest_per_fund"),
    "c6_overlap": ("""
        SELECT symbol, count(DISTINCT fund_code) AS fund_count,
               CAST(sum(CAST(stk_mkv_ratio AS DECIMAL(28,10))) AS DOUBLE) / count(stk_mkv_ratio) AS avg_ratio
        FROM latest_per_fund WHERE stk_mkv_ratio >= 3 GROUP BY 1
        ORDER BY fund_count DESC, symbol LIMIT 20""", "latest_per_fund"),
    "c6_concentration": (_CONCENTRATION.format(view="latest_per_fund"), "latest_per_fund"),
    "c11_fund_holdings": ("SELECT * FROM holdings WHERE fund_code IN (SELECT symbol FROM fund_basic)",
                          "holdings", "fund_basic"),
    "c11_open_days_of_year": ("""
        SELECT date, CAST(strftime(date, '%Y%m%d') AS INT) AS day FROM trade_calendar
        WHERE is_open = '1' AND year(date) = 1998""", "trade_calendar"),
    "s11_rejected": ("""
        SELECT symbol, line AS record, CASE WHEN len(p) < 7 THEN 'fewer than seven fields' ELSE 'close is no number' END AS reason
        FROM (SELECT symbol, line, string_split(line, ',') AS p FROM raw_lines) r
        WHERE len(p) < 7 OR try_cast(p[3] AS DOUBLE) IS NULL""", "raw_lines"),
    "s12_rejected": ("""
        SELECT symbol, CAST(date AS STRING) AS day, 'open is no number' AS reason FROM bars_daily
        WHERE volume % 7 = 0 AND CAST(substr(symbol, 1, 6) AS INT) % 9 <> 0
        UNION ALL
        SELECT symbol, NULL, 'no JSON with a list of records' FROM bars_daily
        WHERE CAST(substr(symbol, 1, 6) AS INT) % 9 = 0 GROUP BY symbol, date_trunc('month', date)""", "bars_daily"),
    "s14_minute_stored": ("""
        SELECT kline_time, close AS price, CAST(volume AS DOUBLE) AS volume, CAST(0 AS DOUBLE) AS amount, symbol
        FROM bars_min""", "bars_min"),
    "k4_upsert_files": ("""
        SELECT symbol, date, open, high, low, CASE WHEN date = DATE '2024-01-15' THEN close * 2 ELSE close END AS close,
               volume, amount FROM bars_daily WHERE date <= DATE '2024-01-16'""", "bars_daily"),
    "k4_upsert_wider": ("""
        SELECT symbol, date, open, high, low, close,
               CAST(CASE WHEN symbol LIKE '%.SH' THEN volume + 3000000000 ELSE volume END AS BIGINT) AS volume, amount
        FROM bars_daily""", "bars_daily"),
    "k4_compact": (f"SELECT {_BAR} FROM bars_daily", "bars_daily"),
    "c2_minute_task": ("""
        SELECT *, (SELECT count(*) FROM bars_min WHERE symbol IN ('click', 'view') AND minute(kline_time) % 7 = 0) AS set_aside
        FROM bars_min WHERE symbol IN ('click', 'view') AND minute(kline_time) % 7 <> 0
          AND kline_time < DATE '2024-01-26'""", "bars_min"),
    "c2_task_rejected": ("""
        SELECT symbol, line AS record, CASE WHEN len(p) < 7 THEN 'fewer than seven fields' ELSE 'close is no number' END AS reason
        FROM (SELECT symbol, line, string_split(line, ',') AS p FROM raw_lines) r
        WHERE len(p) < 7 OR try_cast(p[3] AS DOUBLE) IS NULL""", "raw_lines"),
    "k8_targets_rows": (f"SELECT {_BAR}, target FROM bars_daily, (VALUES ('one'), ('two')) v(target)", "bars_daily"),
    "c8_backfill_rows": ("""
        SELECT symbol, date, open, high, low, close, volume, 'etf_daily' AS dataset FROM bars_daily
        UNION ALL SELECT symbol, date, open, high, low, close, volume, 'etf_nav' FROM bars_by_type""", "bars_daily", "bars_by_type"),
    "c5_corrupt_table": ("""
        SELECT 'etf_daily' AS "table", count(*) AS rows,
               CASE WHEN count(*) < 30 OR date_diff('day', max(date), DATE '2024-01-30') > 3 THEN 'warn' ELSE 'ok' END AS status
        FROM bars_daily UNION ALL SELECT 'etf_share', 0, 'error'""", "bars_daily"),
    "c8_backfill_again": ("""
        SELECT CASE WHEN symbol LIKE '%.SH' THEN '2024-01-29 18:00:00' ELSE '2024-01-30 18:00:00' END AS start_time,
               'etf_daily' AS table_name, symbol, count(*) AS rows_count, 'ok' AS status
        FROM bars_daily GROUP BY symbol""", "bars_daily"),
    "w2_spans_of_store": ("""
        SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows
        FROM three_years GROUP BY symbol""", "three_years"),
    "t1_compacted": (_LAST_OF_FEED.format(way="DESC"), "feed_dup"),
    "t1_stream_upsert": (_LAST_OF_FEED.format(way="DESC"), "feed_dup"),
}

_CHANGE = """
    SELECT {cols}, CASE WHEN prev = 0 THEN CASE WHEN close > 0 THEN CAST('Infinity' AS DOUBLE) END
                        ELSE (close / prev - 1) * 100 END AS pct_chg
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY {time}) AS prev FROM {view}) w"""
_SQL["w1_pct_change"] = (_CHANGE.format(cols=_BAR, time="date", view="bars_daily"), "bars_daily")
_SQL["w1_pct_change_minutes"] = (
    _CHANGE.format(cols=_BAR.replace("date", "kline_time"), time="kline_time", view="bars_min"), "bars_min",
)

_MATRIX = "SELECT date, " + ", ".join(
    f"max(CASE WHEN symbol = '{s}' THEN close END) AS {s}" for s in ("click", "error", "purchase", "signup", "view")
) + " FROM bars_by_type {where} GROUP BY date"
_SQL["j2_close_matrix"] = (_MATRIX.format(where=""), "bars_by_type")
_SQL["w6_close_matrix"] = (_MATRIX.format(
    where="WHERE date IN (SELECT DISTINCT date FROM bars_by_type ORDER BY date DESC LIMIT 10)"), "bars_by_type")


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body.strip(), *views) for name, (body, *views) in _SQL.items()}
