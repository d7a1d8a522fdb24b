"""Signals from bars, their confluence, scores and universes.

A signal is a row (ticker, ts, bar_no, direction, strategy, stop_abs, stop_offset).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.operators import windows as w
from barlight.operators.joins import confluence_semi_join, symmetric_difference

SIGNAL = ("ticker", "ts", "bar_no", "direction", "strategy", "stop_abs", "stop_offset")


def prepared(bars: DataFrame) -> DataFrame:
    """Bars with every rolling measure the signals share, over one partitioning."""
    out = w.with_prior(bars.withColumn("bar_no", w.bar_number()))
    out = w.with_local_atr(w.with_local_atr(w.with_rsi(out, 5), 10, "atr10"), 14, "atr14")
    out = out.withColumn("vwap20", w.rolling_vwap(20)).withColumn("spike", w.volume_spike(50)).withColumn("move", w.price_move())
    out = out.withColumn("range20", w.gated(F.avg, w.bar_range(), -19, 0, 20)).withColumn("rsi_before", w.lag("rsi"))
    return out.withColumn("dev", (F.col("close") - F.col("vwap20")) / F.col("vwap20") * 100)


def _emit(rows: DataFrame, name: str, direction: Column, stop_abs: Column | None = None, stop_offset: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("double")
    out = rows.withColumn("direction", direction).where("direction <> 0")
    return out.select("ticker", "ts", "bar_no", "direction", F.lit(name).alias("strategy"), (none if stop_abs is None else stop_abs).alias("stop_abs"), (none if stop_offset is None else stop_offset).alias("stop_offset"))


def sig_momentum_breakout(p: DataFrame, name: str = "momentum_breakout", also: Column | None = None) -> DataFrame:
    hit = (F.col("bar_no") >= 10) & (F.col("high") > F.col("prior_high")) & (F.col("volume") > 1.2 * F.col("prior_avg_volume"))
    hit = hit if also is None else hit & also
    return _emit(p, name, F.when(hit, 1).otherwise(0), stop_abs=F.col("prior_low"))


def sig_vwap_reversion(p: DataFrame) -> DataFrame:
    ok = F.col("bar_no") >= 25
    return _emit(p, "vwap_reversion", F.when(ok & (F.col("dev") > 0.3), -1).when(ok & (F.col("dev") < -0.3), 1).otherwise(0), stop_offset=2 * F.col("atr10"))


def sig_rsi_scalp(p: DataFrame) -> DataFrame:
    ok, now, before = F.col("bar_no") >= 15, F.col("rsi"), F.col("rsi_before")
    return _emit(p, "rsi_scalp", F.when(ok & (before < 30) & (now >= 30), 1).when(ok & (before > 70) & (now <= 70), -1).otherwise(0), stop_offset=2 * F.col("atr10"))


def sig_ema_pullback(p: DataFrame, span: int = 20) -> DataFrame:
    """Price near its exponential mean inside a trend of it; the stop is beyond the last three bars."""
    out = w.with_ema(p, {"ema": span})
    trend = F.col("ema") - w.lag("ema", 5)
    near = (F.col("close") - F.col("ema")) / F.col("ema") * 100
    three = w.by_ticker().rowsBetween(-2, 0)
    out = out.withColumn("trend", trend).withColumn("near", near).withColumn("low3", F.min("low").over(three)).withColumn("high3", F.max("high").over(three))
    ok = F.col("bar_no") >= 40
    up, down = ok & (F.col("trend") > 0) & (F.col("near") > -0.2) & (F.col("near") < 0.15), ok & (F.col("trend") < 0) & (F.col("near") > -0.15) & (F.col("near") < 0.2)
    stop = F.when(up, F.col("low3") - 0.5 * F.col("atr14")).otherwise(F.col("high3") + 0.5 * F.col("atr14"))
    return _emit(out, "ema_pullback", F.when(up, 1).when(down, -1).otherwise(0), stop_abs=stop)


def sig_orb(p: DataFrame, n: int = 5) -> DataFrame:
    """Break of the range of the day's first n bars; the stop is the range's other side."""
    ranges = w.opening_range(p, n)
    out = p.withColumn("day", F.to_date("ts")).join(ranges, ["ticker", "day"]).where(F.col("ts") > F.col("or_end"))
    up, down = F.col("high") > F.col("or_high"), F.col("low") < F.col("or_low")
    return _emit(out, "orb", F.when(up, 1).when(down, -1).otherwise(0), stop_abs=F.when(up, F.col("or_low")).otherwise(F.col("or_high")))


def sig_delta_breakout(p: DataFrame) -> DataFrame:
    return sig_momentum_breakout(p, "delta_breakout", F.col("delta").isNull() | (F.col("delta") > 0))


def sig_quote_imbalance_breakout(p: DataFrame) -> DataFrame:
    return sig_momentum_breakout(p, "quote_imbalance_breakout", F.col("imbalance").isNull() | (F.col("imbalance") > 0))


def sig_vwap_delta(p: DataFrame) -> DataFrame:
    ok = F.col("bar_no") >= 25
    return _emit(p, "vwap_delta", F.when(ok & (F.col("dev") > 0.3) & (F.col("delta") < 0), -1).when(ok & (F.col("dev") < -0.3) & (F.col("delta") > 0), 1).otherwise(0), stop_offset=2 * F.col("atr10"))


def sig_liquidity_vacuum(p: DataFrame) -> DataFrame:
    hit = (F.col("bar_no") >= 55) & (F.col("spike") >= 2.5) & (w.bar_range() < 0.7 * F.col("range20"))
    return _emit(p, "liquidity_vacuum", F.when(hit, -F.signum("move")).otherwise(0).cast("int"), stop_offset=1.5 * F.col("atr10"))


REGISTRY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "momentum_breakout": sig_momentum_breakout, "vwap_reversion": sig_vwap_reversion, "rsi_scalp": sig_rsi_scalp, "ema_pullback": sig_ema_pullback, "orb": sig_orb,
    "delta_breakout": sig_delta_breakout, "quote_imbalance_breakout": sig_quote_imbalance_breakout, "vwap_delta": sig_vwap_delta, "liquidity_vacuum": sig_liquidity_vacuum,
}


def register_signal(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """A strategy of the user's: prepared bars to signals."""
    REGISTRY[name] = fn


def generate_signals(bars: DataFrame, strategies: list[str], confluences: dict[str, tuple[str, list[str], int]] | None = None) -> DataFrame:
    """Signals of the enabled strategies. confluences: name to (primary, confirmations, least)."""
    confluences = confluences or {}
    p = prepared(bars)
    base: dict[str, DataFrame] = {}
    for s in strategies:
        for name in [confluences[s][0], *confluences[s][1]] if s in confluences else [s]:
            base.setdefault(name, REGISTRY[name](p))
    out = None
    for s in strategies:
        one = base[s] if s not in confluences else sig_confluence(base, s, *confluences[s])
        out = one if out is None else out.unionByName(one)
    return out


def sig_confluence(base: dict[str, DataFrame], name: str, primary: str, confirmations: list[str], least: int) -> DataFrame:
    return confluence_semi_join(base[primary], [base[c] for c in confirmations], least).withColumn("strategy", F.lit(name))


def lookahead_check(bars: DataFrame, strategy: str, cut: int) -> DataFrame:
    """Signals before bar `cut` that differ between the whole and the truncated history: none, if nothing looks ahead."""
    whole = REGISTRY[strategy](prepared(bars)).where(F.col("bar_no") < cut)
    short = REGISTRY[strategy](prepared(bars.withColumn("n", w.bar_number()).where(F.col("n") < cut).drop("n")))
    return symmetric_difference(whole, short)


# Weights of the scores' parts. A minus sign marks parts for which less is better.
SCORES = {
    "score_liquidity": (("dollar_volume", 0.25), ("trade_frequency", 0.25), ("spread", -0.25), ("depth", 0.25)),
    "score_orderflow": (("delta_abs", 0.2), ("aggression", 0.2), ("large_ratio", 0.2), ("delta_pct_abs", 0.2), ("trade_count", 0.2)),
    "score_volatility": (("atr_pct", 0.3), ("rel_vol", 0.25), ("return_stdev", 0.2), ("first_range", 0.25)),
    "score_quotes": (("imbalance_abs", 0.3), ("micro_mid_abs", 0.25), ("contraction", 0.25), ("spread", -0.2)),
    "score_options": (("pcr", 0.15), ("option_volume", 0.15), ("expected_move", 0.1), ("straddle", 0.15), ("gamma_exposure", 0.15), ("iv_skew", 0.15)),
}
OPPORTUNITY = {"score_liquidity": 0.15, "score_orderflow": 0.2, "score_volatility": 0.2, "score_quotes": 0.15, "score_options": 0.15, "score_cross_market": 0.15}


def score(days: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The named scores over all rows; z-scores of all their parts come from one aggregation."""
    parts = sorted({c for n in names for c, _ in SCORES[n]})
    out = w.zscore_0_100(days, {f"z_{c}": c for c in parts})
    for n in names:
        total = F.lit(0.0)
        for c, k in SCORES[n]:
            total = total + (k * F.col(f"z_{c}") if k > 0 else -k * (100 - F.col(f"z_{c}")))
        out = out.withColumn(n, total)
    return out.drop(*(f"z_{c}" for c in parts))


def score_cross_market(flags: list[Column]) -> Column:
    return sum((F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags), F.lit(0.0)) / len(flags) * 100


def opportunity_score(days: DataFrame) -> Column:
    return F.round(sum((F.lit(k) * F.coalesce(F.col(n), F.lit(50.0)) for n, k in OPPORTUNITY.items() if n in days.columns), F.lit(0.0)), 1)


def daily_rank(days: DataFrame, score_column: str = "opportunity_score") -> DataFrame:
    return days.withColumn("rank", F.row_number().over(Window.partitionBy("day").orderBy(F.desc(score_column), "ticker")))


def rank_universe(days: DataFrame, top: int, n: int = 20, least: int = 5) -> DataFrame:
    """Top tickers of each day by .4 dollar volume, .3 volume and .3 range, from the days before it only."""
    means = {c: w.lookback_mean(days, c, n, least) for c in ("dollar_volume", "total_volume", "range_pct")}
    past = days.select("ticker", "day", *(m.alias(c) for c, m in means.items())).where("dollar_volume is not null")
    s = 0.4 * w.zscore_clip("dollar_volume", "day") + 0.3 * w.zscore_clip("total_volume", "day") + 0.3 * w.zscore_clip("range_pct", "day")
    ranked = past.withColumn("score", s).withColumn("rank", F.row_number().over(Window.partitionBy("day").orderBy(F.desc("score"), "ticker")))
    return ranked.where(F.col("rank") <= top).select("ticker", "day", "score", "rank")


def build_universes(stats: DataFrame, lists: dict[str, tuple[int, int]]) -> DataFrame:
    """(name, ticker, market_cap, rank) of lists given as ranges of ranks by dollar volume; one ranking serves all."""
    ranked = stats.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("dollar_volume"), "ticker")))
    spans = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in lists.items()))
    out = ranked.withColumn("x", F.explode(spans)).where((F.col("rank") >= F.col("x.a")) & (F.col("rank") <= F.col("x.b")))
    return out.select(F.col("x.name").alias("name"), "ticker", F.round("market_cap", 0).alias("market_cap"), (F.col("rank") - F.col("x.a") + 1).alias("rank"))
