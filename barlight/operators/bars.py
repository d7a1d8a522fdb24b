"""Bars from ticks, quotes and smaller bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.functions.scalars import safe_divide

NS = {"1sec": 10**9, "1min": 60 * 10**9, "5min": 300 * 10**9, "15min": 900 * 10**9, "1H": 3600 * 10**9, "4H": 14400 * 10**9, "1D": 86400 * 10**9}


def valid_trades(ticks: DataFrame) -> DataFrame:
    return ticks.dropna(subset=["sip_ns", "price", "size"])


def valid_quotes(quotes: DataFrame) -> DataFrame:
    return quotes.dropna(subset=["sip_ns", "bid_price", "ask_price", "bid_size", "ask_size"])


def bucket(size: str) -> Column:
    return F.expr(f"sip_ns div {NS[size]}")


def tick_rule(ticks: DataFrame, *keys: str) -> DataFrame:
    """side: 1 above the trade before in the same keys, -1 below, 0 equal or first."""
    before = F.lag("price").over(Window.partitionBy(*keys).orderBy("sip_ns", "sequence"))
    return ticks.withColumn("side", F.coalesce(F.signum(F.col("price") - before), F.lit(0.0)).cast("int"))


def trade_bars(ticks: DataFrame, size: str = "1min") -> DataFrame:
    """One row a ticker and bucket with order-flow measures.

    Ticks are dealt once, by ticker and bucket, which all windows and the aggregation share; so a ticker with
    many ticks lies in many tasks. The large-trade count needs the bucket's mean and deviation first, which a
    window over the same partitioning gives. Only bars, one a bucket, go on by ticker.
    """
    keyed = tick_rule(valid_trades(ticks).withColumn("bucket", bucket(size)), "ticker", "bucket")
    whole = Window.partitionBy("ticker", "bucket")
    sd = F.coalesce(F.stddev_samp("size").over(whole), F.lit(0.0))
    keyed = keyed.withColumn("large", (sd > 0) & (F.col("size") >= F.avg("size").over(whole) + 2 * sd))
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("size")).otherwise(0.0))
    bars = keyed.groupBy("ticker", "bucket").agg(
        F.count("*").alias("trade_count"), F.sum("size").alias("volume"), F.sum(F.col("price") * F.col("size")).alias("notional"), F.avg("size").alias("avg_size"), F.median("size").alias("median_size"), F.max("size").alias("max_size"),
        F.coalesce(F.stddev_samp("size"), F.lit(0.0)).alias("size_stdev"), side(1).alias("buy_volume"), side(-1).alias("sell_volume"), F.sum(F.col("large").cast("long")).alias("large_trade_count"), ((F.max("sip_ns") - F.min("sip_ns")) / 1e9).alias("span_s"),
    )
    n, span, both = F.col("trade_count"), F.col("span_s"), F.col("buy_volume") + F.col("sell_volume")
    bars = bars.withColumn("vwap", safe_divide(F.col("notional"), F.col("volume"), 0.0)).withColumn("delta", F.col("buy_volume") - F.col("sell_volume"))
    bars = bars.withColumn("cumulative_delta", F.sum("delta").over(Window.partitionBy("ticker").orderBy("bucket")))
    return bars.select(
        "ticker", "bucket", "trade_count", "volume", "vwap", "avg_size", "median_size", "max_size", "size_stdev", "buy_volume", "sell_volume", "delta", "cumulative_delta",
        safe_divide(100 * F.col("delta"), both, 0.0).alias("delta_pct"), safe_divide(F.col("buy_volume"), both, 0.5).alias("aggression_ratio"), F.when(span > 0, n / span).otherwise(n / 60).alias("trade_frequency"),
        "large_trade_count", (F.col("large_trade_count") / n).alias("large_trade_ratio"), F.when(n > 1, span / (n - 1)).otherwise(0.0).alias("avg_seconds_between_trades"),
    )


def trade_bars_rollup(bars: DataFrame, mult: int, seconds: int) -> DataFrame:
    """Larger bars from smaller ones. As in the smaller rows' use, median and deviation are set to the mean size."""
    out = bars.withColumn("small", F.col("bucket")).withColumn("bucket", F.expr(f"small div {mult}")).groupBy("ticker", "bucket").agg(
        *(F.sum(c).alias(c) for c in ("trade_count", "volume", "buy_volume", "sell_volume", "delta", "large_trade_count")), F.max("max_size").alias("max_size"), F.sum(F.col("vwap") * F.col("volume")).alias("notional"), F.sum(F.col("avg_size") * F.col("trade_count")).alias("sizes"), F.max_by("cumulative_delta", "small").alias("cumulative_delta"),
    )
    both = F.col("buy_volume") + F.col("sell_volume")
    n = F.col("trade_count")
    mean = safe_divide(F.col("sizes"), n.cast("double"), 0.0)
    return out.select(
        "ticker", "bucket", "trade_count", "volume", safe_divide(F.col("notional"), F.col("volume"), 0.0).alias("vwap"), mean.alias("avg_size"), mean.alias("median_size"), "max_size", mean.alias("size_stdev"), "buy_volume", "sell_volume", "delta", "cumulative_delta",
        safe_divide(100 * F.col("delta"), both, 0.0).alias("delta_pct"), safe_divide(F.col("buy_volume"), both, 0.5).alias("aggression_ratio"), (n / seconds).alias("trade_frequency"), "large_trade_count", (F.col("large_trade_count") / n).alias("large_trade_ratio"), (F.lit(float(seconds)) / n).alias("avg_seconds_between_trades"),
    )


def quote_bars(quotes: DataFrame, size: str = "1min") -> DataFrame:
    """Spread, sizes, imbalance, mid and microprice of each ticker and bucket, in one aggregation."""
    bid, ask, bs, as_ = (F.col(c) for c in ("bid_price", "ask_price", "bid_size", "ask_size"))
    spread = ask - bid
    out = valid_quotes(quotes).withColumn("bucket", bucket(size)).groupBy("ticker", "bucket").agg(
        F.count("*").alias("quote_count"), F.avg(spread).alias("avg_spread"), F.max(spread).alias("max_spread"), F.min(spread).alias("min_spread"), F.avg(bid).alias("avg_bid"), F.avg(ask).alias("avg_ask"), F.sum(bs).alias("bid_size"), F.sum(as_).alias("ask_size"),
        F.coalesce(F.stddev_samp(spread), F.lit(0.0)).alias("spread_stdev"),
    )
    b, a = F.col("bid_size"), F.col("ask_size")
    mid = (F.col("avg_bid") + F.col("avg_ask")) / 2
    micro = safe_divide(F.col("avg_bid") * a + F.col("avg_ask") * b, a + b)
    return out.withColumn("imbalance", safe_divide(b - a, a + b, 0.0)).withColumn("mid", mid).withColumn("microprice", F.coalesce(micro, mid))


def quote_bars_rollup(bars: DataFrame, mult: int) -> DataFrame:
    """Larger quote bars: averages by count, the deviation of the smaller average spreads, microprice by size."""
    n = F.col("quote_count")
    by_count = lambda c: (F.sum(F.col(c) * n) / F.sum(n)).alias(c)
    both = F.col("bid_size") + F.col("ask_size")
    out = bars.withColumn("bucket", F.expr(f"bucket div {mult}")).groupBy("ticker", "bucket").agg(
        F.sum(n).alias("quote_count"), by_count("avg_spread"), F.max("max_spread").alias("max_spread"), F.min("min_spread").alias("min_spread"), by_count("avg_bid"), by_count("avg_ask"), F.sum("bid_size").alias("b"), F.sum("ask_size").alias("a"),
        F.coalesce(F.stddev_samp("avg_spread"), F.max("spread_stdev")).alias("spread_stdev"), (F.sum(F.col("microprice") * both) / F.nullif(F.sum(both), F.lit(0.0))).alias("micro"),
    )
    mid = (F.col("avg_bid") + F.col("avg_ask")) / 2
    out = out.withColumnsRenamed({"b": "bid_size", "a": "ask_size"})
    return out.withColumn("imbalance", safe_divide(F.col("bid_size") - F.col("ask_size"), F.col("bid_size") + F.col("ask_size"), 0.0)).withColumn("mid", mid).withColumn("microprice", F.coalesce("micro", mid)).drop("micro")


def ohlcv_resample(bars: DataFrame, key: Column, name: str = "bucket") -> DataFrame:
    """First open, largest high, least low and last close above 0, summed volume, mean vwap above 0; groups without an open go."""
    above = lambda c: F.when(F.col(c) > 0, F.col(c))
    ordered = lambda c, by: by(c, F.when(F.col(c) > 0, F.col("ts")))
    out = bars.groupBy("ticker", key.alias(name)).agg(ordered("open", F.min_by).alias("open"), F.max(above("high")).alias("high"), F.min(above("low")).alias("low"), ordered("close", F.max_by).alias("close"), F.sum("volume").alias("volume"), F.avg(above("vwap")).alias("vwap"), F.max(above("open")).alias("any"))
    return out.where("any is not null").drop("any")


def bars_from_ticks(ticks: DataFrame, key: Column, name: str = "bucket") -> DataFrame:
    """Plain OHLCV of trades, ordered by time and sequence."""
    at = F.struct("sip_ns", "sequence")
    return ticks.groupBy("ticker", key.alias(name)).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("size").alias("volume"), (F.sum(F.col("price") * F.col("size")) / F.sum("size")).alias("vwap"), F.count("*").alias("transactions"))
