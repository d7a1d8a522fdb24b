"""Daily features of aligned bars, screens and rules that build on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.functions.predicates import detail_filter, snapshot_filter
from barlight.functions.scalars import new_york, safe_divide

# Mean columns of a day's features by their source column in aligned bars.
MEANS = {"trade_frequency": "tr_trade_frequency", "large_ratio": "tr_large_trade_ratio", "aggression": "tr_aggression_ratio", "spread": "qu_avg_spread", "imbalance": "qu_imbalance", "straddle": "opt_straddle", "expected_move": "opt_expected_move", "pcr": "opt_pcr"}
SUMS = {"delta": "tr_delta", "trade_count": "tr_trade_count", "option_volume": "opt_volume"}
# Least mean scores for which a strategy is run on a ticker.
RULES = {
    "momentum_breakout": {"score_volatility": 50, "score_liquidity": 45}, "vwap_reversion": {"score_liquidity": 50}, "rsi_scalp": {"score_volatility": 45}, "ema_pullback": {"score_volatility": 40, "score_liquidity": 40}, "orb": {"score_volatility": 55},
    "delta_breakout": {"score_orderflow": 50}, "quote_imbalance_breakout": {"score_quotes": 50}, "vwap_delta": {"score_orderflow": 45, "score_liquidity": 45}, "liquidity_vacuum": {"score_quotes": 45},
}


def daily_features(bars: DataFrame, least: int = 10, edge: int = 30) -> DataFrame:
    """One row a ticker and UTC day of at least `least` bars, in one aggregation after one window.

    bars: OHLCV and any of the tr_, qu_ and opt_ columns; a missing one gives null. first_range: of the
    first `edge` bars in percent of the open; contraction: mean spread of the first less that of the
    last `edge` bars, on days of at least twice as many.
    """
    bars = bars.withColumn("day", F.to_date("ts"))
    day = Window.partitionBy("ticker", "day")
    bars = bars.withColumn("up", F.row_number().over(day.orderBy("ts"))).withColumn("down", F.row_number().over(day.orderBy(F.desc("ts"))))
    have = set(bars.columns)
    col = lambda c: F.col(c).cast("double") if c in have else F.lit(None).cast("double")
    early = F.col("up") <= edge
    out = bars.groupBy("ticker", "day").agg(
        F.count("*").alias("n_bars"), F.avg(F.col("close") * F.col("volume")).alias("dollar_volume"), F.sum("volume").alias("total_volume"), F.avg((F.col("high") - F.col("low")) / F.col("close") * 100).alias("range_pct"), F.max_by("close", "ts").alias("last_close"),
        ((F.max(F.when(early, F.col("high"))) - F.min(F.when(early, F.col("low")))) / F.min_by("open", "ts") * 100).alias("first_range"), (F.avg(F.when(early, col("qu_avg_spread"))) - F.avg(F.when(F.col("down") <= edge, col("qu_avg_spread")))).alias("contraction"),
        *(F.avg(col(c)).alias(n) for n, c in MEANS.items()), *(F.sum(col(c)).alias(n) for n, c in SUMS.items()), F.avg(F.abs(col("qu_imbalance"))).alias("imbalance_abs"),
        F.avg(F.abs(col("qu_microprice") - col("qu_mid")) / F.nullif(col("qu_mid"), F.lit(0.0)) * 100).alias("micro_mid_abs"), F.avg(F.abs(col("tr_delta_pct"))).alias("delta_pct_abs"), F.avg(col("qu_bid_size") + col("qu_ask_size")).alias("depth"),
    )
    return out.where(F.col("n_bars") >= least).withColumn("delta_abs", F.abs("delta")).withColumn("contraction", F.when(F.col("n_bars") >= 2 * edge, F.col("contraction")))


def daily_features_et(bars: DataFrame, least: int = 10) -> DataFrame:
    """The same by New York day: dollar volume, volume, range, deviation of returns, last close."""
    before = F.lag("close").over(Window.partitionBy("ticker").orderBy("ts"))
    rows = bars.withColumn("day", F.to_date(new_york(F.col("ts")))).withColumn("ret", F.col("close") / before - 1)
    out = rows.groupBy("ticker", "day").agg(F.count("*").alias("n_bars"), F.avg(F.col("close") * F.col("volume")).alias("dollar_volume"), F.sum("volume").alias("total_volume"), F.avg((F.col("high") - F.col("low")) / F.col("close") * 100).alias("range_pct"), (F.stddev_samp("ret") * 100).alias("return_stdev"), F.max_by("close", "ts").alias("last_close"))
    return out.where(F.col("n_bars") >= least)


def select_strategies(days: DataFrame, rules: dict[str, dict[str, float]] = RULES) -> DataFrame:
    """(ticker, strategy) where the mean scores reach a strategy's thresholds."""
    names = sorted({c for r in rules.values() for c in r if c in days.columns})
    means = days.groupBy("ticker").agg(*(F.avg(c).alias(c) for c in names))
    tests = [F.when(all_reach(r, names), F.lit(s)) for s, r in rules.items()]
    return means.select("ticker", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("strategy"))


def all_reach(rule: dict[str, float], names: list[str]) -> Column:
    out = F.lit(True)
    for c, k in rule.items():
        out = out & ((F.col(c) >= k) if c in names else F.lit(False))
    return out


def screen_stocks(fundamentals: DataFrame, reference: DataFrame, config: dict) -> DataFrame:
    """Tickers of either table that pass the detail filter; an empty sector is filled from the reference."""
    r = reference.select("ticker", F.col("exchange"), F.col("sector_industry"))
    both = fundamentals.join(r, "ticker", "full").withColumn("sector", F.coalesce(F.nullif("sector", F.lit("")), "sector_industry")).drop("sector_industry")
    return both.where(detail_filter(config))


def screen_snapshot(snapshots: DataFrame, config: dict, faithful: bool = False) -> DataFrame:
    """price, volume and rvol of snapshots inside the ranges of config.

    rvol compares the day's volume with the previous day's. faithful: the volume itself is the previous
    day's where there is one, so rvol is 1 there.
    """
    price = F.coalesce("last_price", "prev_close", "day_close")
    volume = F.coalesce("prev_volume", "day_volume") if faithful else F.coalesce("day_volume", "prev_volume")
    out = snapshots.select("ticker", price.alias("price"), volume.alias("volume"), safe_divide(volume, F.col("prev_volume")).alias("rvol"))
    return out.where(snapshot_filter(config))


def option_underlying_join(options: DataFrame, minutes: DataFrame) -> DataFrame:
    """Option bars with the underlying's close of the same minute."""
    return options.join(minutes.select("ticker", "minute", F.col("close").alias("underlying")), ["ticker", "minute"])


def option_bars_resample(bars: DataFrame, minutes: int, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Bars of contracts in buckets of so many minutes from the epoch."""
    return bars.withColumn("bucket", F.expr(f"minute div {minutes}")).groupBy(*keys, "bucket").agg(F.min_by("open", "minute").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "minute").alias("close"), F.sum("volume").alias("volume"))


def option_ticker_coverage(options: DataFrame, tickers: DataFrame) -> DataFrame:
    """Whether each ticker is the root of any option; roots are parsed, so F doesn't match FB."""
    found = options.select(F.col("root").alias("ticker")).distinct().withColumn("found", F.lit(True))
    return tickers.select("ticker").distinct().join(found, "ticker", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def combined_universe(lists: list[DataFrame], present: DataFrame) -> DataFrame:
    out = lists[0].select("ticker")
    for x in lists[1:]:
        out = out.unionByName(x.select("ticker"))
    return out.distinct().join(present.select("ticker").distinct(), "ticker", "left_anti").orderBy("ticker")


def spread_adjusted_pnl(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """pnl less half the spread at entry and at exit, each the last quote at or before it."""
    q = quotes.select("ticker", "ts", ((F.col("ask_price") - F.col("bid_price")) / 2).alias("half"))
    one = _at(trades, q, "entry_ts").withColumnRenamed("half", "entry_half")
    return _at(one, q, "exit_ts").withColumn("adjusted_pnl", F.col("pnl") - F.coalesce("entry_half", F.lit(0.0)) - F.coalesce("half", F.lit(0.0)))


def _at(rows: DataFrame, quotes: DataFrame, ts: str) -> DataFrame:
    from barlight.operators.joins import asof_ffill_join

    return asof_ffill_join(rows, quotes.withColumnRenamed("ts", ts), ["half"], ts=ts)


def stock_leaderboard(metrics: DataFrame, scores: DataFrame) -> DataFrame:
    """Tickers by the composite of their best strategy (profit factor), with their mean scores."""
    n = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("profit_factor"), "strategy", "rr_ratio"))
    best = metrics.withColumn("k", n).where("k = 1").drop("k")
    composite = 3 * F.col("profit_factor") + 2 * F.coalesce("sharpe", F.lit(0.0)) - 0.1 * F.col("max_losing_streak") + F.coalesce("win_rate", F.lit(0.0)) / 50
    mean = scores.groupBy("ticker").agg(*(F.avg(c).alias(c) for c in scores.columns if c.startswith("score_")))
    return best.withColumn("composite", composite).join(mean, "ticker", "left")
