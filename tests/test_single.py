"""Queries of single operators do no less than the queries that use these operators in passing."""

from pyspark.sql import functions as F

from barlight.plans import catalog, fixtures

SF = "/root/testdata/sf0.001"


def lost(spark, whole, part, columns):
    """Rows of the query `whole` that `part` hasn't."""
    return catalog.QUERIES[whole](spark, SF).select(*columns).exceptAll(catalog.QUERIES[part](spark, SF).select(*columns)).count()


def test_confluence_has_all_confirmed_signals(spark):
    assert lost(spark, "generate_signals", "confluence_semi_join", ["ticker", "ts", "bar_no", "direction", "stop_abs", "stop_offset"]) == 0
    rows = catalog.QUERIES["confluence_semi_join"](spark, SF).groupBy("strategy").count().collect()
    assert {r.strategy for r in rows} >= {"vwap_reversion", "vwap_delta", "day"}


def test_prefixed_bars_keep_rows_and_columns(spark):
    assert lost(spark, "align_feature_bars", "prefix_columns", ["ticker", "ts", "tr_n", "qu_spread"]) == 0
    bars = fixtures.hour_bars(spark, SF).count() + fixtures.day_bars(spark, SF).count()
    df = catalog.QUERIES["prefix_columns"](spark, SF)
    assert df.count() == bars and df.where("tr_vwap is not null").count() == bars


def test_no_valid_contract_is_lost(spark):
    df = catalog.QUERIES["valid_contracts"](spark, SF)
    assert df.count() == fixtures.chains(spark, SF).where("strike is not null and close > 0 and dte >= 1").count()
    columns = ["symbol", "day", "line_order", "close"]
    assert df.where("premium").select(*columns).exceptAll(catalog.QUERIES["has_time_premium"](spark, SF).select(*columns)).count() == 0
    assert lost(spark, "has_time_premium", "valid_contracts", columns) == 0


def test_iv_at_delta_has_both_kinds(spark):
    assert lost(spark, "skew_25d", "iv_at_delta", ["ticker", "day"]) == 0
    df = catalog.QUERIES["iv_at_delta"](spark, SF)
    counts = df.agg(*(F.count(c).alias(c) for c in ("put_iv", "call_iv", "put_iv_50", "iv_50"))).first()
    old = catalog.QUERIES["skew_25d"](spark, SF).agg(F.count("put_iv"), F.count("call_iv")).first()
    assert (counts.put_iv, counts.call_iv) == tuple(old) == (counts.put_iv_50, counts.iv_50)
