"""Empty, null, tie and single-row cases of operators."""

import random

import pytest
from pyspark.sql import functions as F

from barlight.functions import predicates as P
from barlight.functions import scalars as S
from barlight.operators import bars, joins, market, options, outcomes, signals, windows
from barlight.sources import tables

TICKS = "ticker string, sip_ns long, price double, size double, exchange long, sequence long, ts timestamp_ntz"


def test_trade_bars_of_one_and_of_no_trade(spark):
    one = spark.createDataFrame([("A", 5, 10.0, 3.0, 1, 1, None), ("A", None, 1.0, 1.0, 1, 2, None)], TICKS)
    r = bars.trade_bars(one).collect()
    assert len(r) == 1 and r[0].trade_count == 1 and r[0].size_stdev == 0 and r[0].aggression_ratio == 0.5 and r[0].avg_seconds_between_trades == 0
    assert bars.trade_bars(one.limit(0)).count() == 0


def test_zero_volume_has_no_vwap(spark):
    r = bars.trade_bars(spark.createDataFrame([("A", 5, 10.0, 0.0, 1, 1, None)], TICKS)).first()
    assert r.vwap == 0 and r.delta_pct == 0


def test_asof_takes_the_last_value_that_is_not_null(spark):
    b = spark.createDataFrame([("A", 1), ("A", 3), ("A", 5), ("B", 3)], "ticker string, ts long")
    f = spark.createDataFrame([("A", 3, 7.0), ("A", 4, None), ("B", 9, 1.0)], "ticker string, ts long, x double")
    got = {(r.ticker, r.ts): r.x for r in joins.asof_ffill_join(b, f, ["x"]).collect()}
    assert got == {("A", 1): None, ("A", 3): 7.0, ("A", 5): 7.0, ("B", 3): None}


def test_numbers_and_symbols(spark):
    df = spark.createDataFrame([(x,) for x in ["1.5", " 2 ", "", "x", "NaN", "Infinity", None]], "x string")
    assert [r[0] for r in df.select(S.to_number(F.col("x"))).collect()] == [1.5, 2.0, None, None, None, None, None]
    df = spark.createDataFrame([("O:ABC240119C00050500",), ("ABC",), (None,)], "x string")
    got = [r[0] for r in df.select(S.parse_occ_symbol(F.col("x"))).collect()]
    assert (got[0].root, str(got[0].expiry), got[0].type, got[0].strike) == ("ABC", "2024-01-19", "C", 50.5) and got[1] is None and got[2] is None


def test_range_filter_fails_nulls_only_with_a_bound(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert df.where(P.range_filter(F.col("x"))).count() == 3
    assert df.where(P.range_filter(F.col("x"), 1, 2)).count() == 1


def test_config_with_comments():
    assert P.read_config('# a\n{"price_min": 1,\n  # b\n "price_max": 2}') == {"price_min": 1, "price_max": 2}


def test_naive_time_is_eight_hours_ahead(spark):
    df = spark.createDataFrame([("2024-01-01T08:00:00",), ("2024-01-01T00:00:00+00:00",), ("bad",)], "x string")
    a, b, c = (r[0] for r in df.select(F.unix_seconds(S.naive_ts_to_utc(F.col("x")))).collect())
    assert a == b == 1704067200 and c is None


def test_ema_over_tickers_and_nulls(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, None), ("A", 3, 3.0), ("B", 1, 5.0)], "ticker string, ts long, close double")
    got = {(r.ticker, r.ts): r.e for r in windows.with_ema(df, {"e": 3}).collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 1.0, ("A", 3): 2.0, ("B", 1): 5.0}


def test_registered_signal(spark):
    signals.register_signal("every", lambda p: signals._emit(p, "every", F.lit(1)))
    b = spark.createDataFrame([("A", 1, 1.0, 2.0, 0.5, 1.5, 10.0)], "ticker string, ts int, open double, high double, low double, close double, volume double").withColumn("ts", F.lit("2024-01-02 10:00:00").cast("timestamp_ntz"))
    assert signals.generate_signals(b, ["every"]).count() == 1


def test_scores_without_deviation_are_the_middle(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 1.0)], "ticker string, x double")
    assert {r.z for r in windows.zscore_0_100(df, {"z": "x"}).collect()} == {50.0}


def test_order_book(spark):
    level = "array<struct<price:double,x:map<string,double>>>"
    df = spark.createDataFrame([("A", [(1.0, {"a": 1.0}), (2.0, {"b": 1.0})], [(3.0, {"a": 1.0})])], f"ticker string, bids {level}, asks {level}")
    r = market.order_book_l2(market.order_book_levels(df)).first()
    assert (r.best_bid, r.best_ask, r.spread, r.bid_levels) == (2.0, 3.0, 1.0, 2)


def test_files_there_and_back(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0, "1min", 2024), ("B", 2.0, "1min", 2024), ("B", 3.0, "1D", 2024)], "ticker string, close double, agg string, year int").withColumn("ts", F.lit("2024-01-02 10:00:00").cast("timestamp_ntz"))
    path = str(tmp_path / "bars")
    tables.write_parquet(df, path, "agg", "year")
    tables.append_table(df.limit(1), path, "agg", "year")
    assert tables.scan_bars(spark, path, "1min", 2024).count() == 3
    assert {(r.ticker, r.agg) for r in tables.scan_chains(spark, path, "1D").collect()} == {("A", "1min"), ("B", "1D")}
    tables.verify_publish(df, df.schema, 3)
    with pytest.raises(ValueError):
        tables.verify_publish(df, df.schema, 4)


def test_json_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"results": [{"T": "A", "o": 1.0, "c": 2.0}, {"ticker": "B", "close": 3.0}], "status": "OK"}')
    got = {(r.ticker, r.open, r.close) for r in tables.ingest_json_payloads(spark, str(tmp_path), "aggs", "ticker string, open double, close double").collect()}
    assert got == {("A", 1.0, 2.0), ("B", None, 3.0)}


def test_option_flatfile(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,volume,open,close,high,low,window_start,transactions\nO:F240119C00010000,1,1,1,1,1,60000000000,1\nO:FB240119C00010000,1,1,1,1,1,60000000000,1\nbad,1,1,1,1,1,1,1\n")
    assert tables.scan_option_flatfile(spark, str(tmp_path / "a.csv")).count() == 2
    assert tables.scan_option_flatfile(spark, str(tmp_path / "a.csv"), ["F"]).first().strike == 10.0


def test_feature_greeks_keep_repeated_rows(spark):
    from barlight.operators import options

    row = (100.0, 0.04, 100.0, 5.0, 30, "C", 100.0, 4.0, 30, "P")
    cols = "underlying double, rate double, " + ", ".join(f"{p}_strike double, {p}_close double, {p}_dte int, {p}_type string" for p in ("call", "put"))
    out = options.enrich_feature_greeks(spark.createDataFrame([row, row, (None,) * 10], cols), ("call", "put")).collect()
    assert len(out) == 3 and [r.call_iv is None for r in out] == [False, False, True] and out[0].put_delta < 0 < out[0].call_delta


def test_error_function():
    import math

    import numpy as np

    from barlight.operators.options import _erf

    x = np.linspace(-8, 8, 5001)
    assert np.abs(_erf(x) - np.array([math.erf(v) for v in x])).max() < 1e-10


def test_a_row_with_two_splits_stays_one_row(spark):
    from barlight.operators import splits

    rows = spark.createDataFrame([("A", "2020-01-01", 100.0, 6.0), ("A", "2021-06-01", 100.0, 6.0), ("A", "2023-01-01", 100.0, 6.0), ("B", "2020-01-01", 1.0, 1.0)], "ticker string, day string, close double, volume double").withColumn("day", F.to_date("day"))
    records = spark.createDataFrame([("A", "2021-01-01", 2.0), ("A", "2022-01-01", 3.0)], "ticker string, split_date string, factor double").withColumn("split_date", F.to_date("split_date"))
    out = sorted((str(r.day), r.ticker, round(r.close, 6), r.volume) for r in splits.adjust_trades_quotes(rows, records, ("close",), ("volume",)).collect())
    assert out == [("2020-01-01", "A", 16.666667, 36.0), ("2020-01-01", "B", 1.0, 1.0), ("2021-06-01", "A", 33.333333, 18.0), ("2023-01-01", "A", 100.0, 6.0)]


def test_yields_as_of_by_equal_dates(spark):
    curve = spark.sql("select date'2000-01-01' + int(id) as date, double(id) as y from range(0, 150000, 3)")
    rows = spark.sql("select id, date'1999-12-31' + int(id) as day from range(0, 9)").union(spark.sql("select 99, null"))
    out = joins.asof_yield_join(rows, curve)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.y for r in out.collect()} == {0: 0.0, 1: 0.0, 2: 0.0, 3: 0.0, 4: 3.0, 5: 3.0, 6: 3.0, 7: 6.0, 8: 6.0, 99: None}


def walk(spark, direction, *bars_):
    """Bars from bar 0 on (open, high, low, close, bid, ask) and a signal at bar 0 with the stop at 9 or 11."""
    bars_df = spark.createDataFrame([("A", k, *map(float, b[:4]), *b[4:]) for k, b in enumerate(bars_)], "ticker string, bar_no long, open double, high double, low double, close double, bid double, ask double")
    signal = spark.createDataFrame([("A", 0, direction, 10.0 - direction, None, "i")], "ticker string, bar_no long, direction int, stop_abs double, stop_offset double, id string")
    return signal, bars_df


QUIET = (10, 10.1, 9.9, 10, None, None)


def test_a_gap_through_the_stop_is_left_at_the_market(spark):
    signal, b = walk(spark, 1, QUIET, QUIET, (8, 8.2, 7.5, 8, 7.9, 8.1))
    got = {e: outcomes.barrier_outcome_v3(signal, b, execution=e).first() for e in outcomes.EXECUTIONS}
    assert [got[e].result for e in got] == ["loss"] * 3
    assert got["mid"].exit == 8 and got["bid_ask"].exit == 7.9 and got["bid_ask_slippage"].exit == pytest.approx(7.9 * (1 - 5e-4))
    assert got["mid"].entry == 10 and got["bid_ask_slippage"].entry == pytest.approx(10 * (1 + 5e-4))  # no quote: the open
    assert (got["mid"].mfe, got["mid"].mae, got["mid"].duration) == (pytest.approx(0.1), -2.5, 1)
    signal, b = walk(spark, -1, QUIET, QUIET, (10.9, 11.5, 10.8, 10.9, 10.7, 10.8))
    r = outcomes.barrier_outcome_v3(signal, b).first()
    assert (r.result, r.exit) == ("loss", 11)  # the market has come back: the stop is worse


def test_both_barriers_in_a_bar(spark):
    signal, b = walk(spark, 1, QUIET, (10, 13, 8, 12, 11.9, 12.1))
    assert [outcomes.barrier_outcome_v3(signal, b, stop_first=f).first().result for f in (True, False)] == ["loss", "win"]
    assert outcomes.barrier_outcome_v3(signal, b, stop_first=False).first().exit == 12
    assert outcomes.barrier_outcome_v3(signal, b, latency=3).count() == 0  # no entry bar
    timeout = outcomes.barrier_outcome_v3(*walk(spark, 1, QUIET, QUIET, QUIET), execution="bid_ask").first()
    assert (timeout.result, timeout.exit, timeout.duration) == ("timeout", 10, 1)


def test_the_grid_is_every_outcome_for_itself(spark):
    rng = random.Random(5)
    rows, price = [], 10.0
    for _ in range(200):
        o = price
        price *= 1 + rng.uniform(-0.05, 0.05)
        rows.append((o, max(o, price) * 1.01, min(o, price) * 0.99, price, None if rng.random() < 0.2 else price * 0.999, price * 1.001))
    _, b = walk(spark, 1, *rows)
    signals_df = b.where("bar_no % 3 = 0").select("ticker", "bar_no", F.when(F.col("bar_no") % 2 == 0, 1).otherwise(-1).alias("direction"), F.when(F.col("bar_no") % 5 > 0, F.col("close") * 0.97).alias("stop_abs"), F.lit(0.3).alias("stop_offset"), F.col("bar_no").cast("string").alias("id"))
    grid = {(r.rr, r.timeout, r.execution): (r.n, r.wins, r.losses, pytest.approx(r.total_pnl)) for r in outcomes.robustness_grid(signals_df, b, (1.5, 2.5), (3, 20), latency=1).collect()}
    assert len(grid) == 12
    for (rr, timeout, execution), want in grid.items():
        one = outcomes.barrier_outcome_v3(signals_df, b, rr, timeout, 1, execution=execution).agg(F.count("*"), F.count(F.when(F.col("result") == "win", 1)), F.count(F.when(F.col("result") == "loss", 1)), F.sum("pnl")).first()
        assert tuple(one) == want


def test_audit_of_trades(spark):
    _, b = walk(spark, 1, (10, 10.1, 8.9, 10, None, None), (10, 12.5, 8.5, 10, None, None), QUIET)
    schema = "id string, ticker string, bar_no long, direction int, entry double, stop double, target double, result string, exit double, bars_held long"
    trades = spark.createDataFrame([("x", "A", 0, 1, 10.5, 9.0, 12.0, "win", 12.0, 1), ("y", "A", 1, -1, 8.0, 11.0, 7.0, "loss", 13.0, 1)], schema)
    r = outcomes.audit_ambiguous_bars(trades, b, 5).first()
    assert (r.n, r.ambiguous, r.losses_stop_first, r.timeouts_stop_first, r.relabelled) == (2, 1, 1, 1, 2)
    assert (r.entry_bar_stop, r.phantom_entry, r.unreachable_exit, r.wins_target_first) == (2, 2, 1, 1)
    assert outcomes.audit_ambiguous_bars(trades.where("false"), b).first().n == 0


def test_greeks_job_fills_what_is_missing(spark):
    """The minute's close first, then the contract's last known underlying; rows without either keep nulls."""
    rows = [("C1", "A", "2024-01-02 10:00:30", None, 5.0), ("C1", "A", "2024-01-02 10:01:00", 101.0, 5.0), ("C1", "A", "2024-01-03 10:02:10", None, 6.0), ("C1", "A", "2024-01-04 11:00:00", None, 6.0), ("C2", "B", "2024-01-04 11:00:00", None, 6.0)]
    chains = spark.createDataFrame(rows, "symbol string, ticker string, t string, underlying double, close double").select("symbol", "ticker", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(100.0).alias("strike"), F.lit(30).alias("dte"), F.lit("C").alias("type"), "close", "underlying")
    minutes = spark.createDataFrame([("A", "2024-01-03 10:02:00", 103.0)], "ticker string, t string, close double").select("ticker", F.col("t").cast("timestamp_ntz").alias("minute"), "close")
    curve = spark.createDataFrame([("2024-01-01", 5.0, 4.0), ("2024-01-04", 6.0, 4.0)], "d string, m1 double, y1 double").select(F.col("d").cast("date").alias("date"), "m1", "y1")
    got = {(r.symbol, str(r.ts)): r for r in options.greeks_job(chains, curve, minutes, {"m1": 30, "y1": 365}).collect()}
    assert [got[k].underlying for k in sorted(got)] == [None, 101, 103, 103, None]
    assert got["C1", "2024-01-03 10:02:10"].rate == 0.05 and got["C1", "2024-01-04 11:00:00"].rate == 0.06
    assert got["C1", "2024-01-03 10:02:10"].iv > 0 and got["C2", "2024-01-04 11:00:00"].iv is None
    assert len(got) == 5


def test_sessions_by_calendar(spark):
    """An early close, a holiday, a weekend, a null time, and columns named like those of the calendar."""
    rows = [(1, "2024-01-02 18:30:00"), (2, "2024-01-03 18:30:00"), (3, "2024-01-04 18:30:00"), (4, "2024-01-06 18:30:00"), (5, None), (6, "2024-01-03 14:29:59"), (7, "2024-01-03 14:30:00")]
    df = spark.createDataFrame(rows, "closed int, t string").selectExpr("closed", "cast(t as timestamp_ntz) as ts")
    calendar = spark.createDataFrame([("2024-01-02", False, 780), ("2024-01-04", True, None)], "d string, closed boolean, early_close int").selectExpr("cast(d as date) as date", "closed", "early_close")
    out = {r.closed: r.session for r in joins.session_labels(df, calendar).collect()}
    assert out == {1: "after-hours", 2: "regular", 3: "closed", 4: "closed", 5: "closed", 6: "pre-market", 7: "regular"}


def test_symmetric_difference_counts_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("z", 4), ("z", 4)], "v string, k int")
    assert sorted(map(tuple, joins.symmetric_difference(a, b).collect())) == [(1, "x"), (3, "y"), (4, "z"), (4, "z")]
    assert joins.symmetric_difference(a, a).count() == 0


def test_bars_of_years(spark, tmp_path):
    root = str(tmp_path / "bars")
    df = spark.createDataFrame([(y, f"t{y % 2}", "1h") for y in range(2019, 2024)], "year int, ticker string, agg string").withColumn("ts", F.make_timestamp_ntz("year", F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    assert tables.write_counted(df, root, "agg", "year") == 5
    count = lambda years, **more: tables.scan_bars(spark, root, "1h", years, **more).count()
    assert [count(2020), count((2020, 2022)), count(None), count(None, tickers=["t1"]), count(1999)] == [1, 3, 5, 3, 0]
    assert "PartitionFilters: [isnotnull(agg" in tables.scan_bars(spark, root, "1h", (2020, 2022))._jdf.queryExecution().toString()
