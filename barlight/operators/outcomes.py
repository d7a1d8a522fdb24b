"""Trade outcomes and statistics of trade tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.operators import windows as w
from barlight.operators.joins import forward_range_join
from barlight.operators.scans import exact_quantiles
from barlight.sources.shared import written

# Edges of the six bins of results in units of risk.
R_BINS = ((None, -1.0, "<-1R"), (-1.0, 0.0, "-1R..0"), (0.0, 1.0, "0..1R"), (1.0, 2.0, "1R..2R"), (2.0, 3.0, "2R..3R"), (3.0, None, ">=3R"))


def barrier_outcome_v2(signals: DataFrame, bars: DataFrame, max_bars: int = 60) -> DataFrame:
    """First barrier that the bars after a signal reach; in one bar the target comes first; else the last close.

    signals: ticker, bar_no, direction, entry, stop, target, id. One equi-join and one aggregation.
    """
    ahead = forward_range_join(signals, bars, 1, max_bars - 1)
    up = F.col("direction") == 1
    t = F.when(up, F.col("b_high") >= F.col("target")).otherwise(F.col("b_low") <= F.col("target"))
    s = F.when(up, F.col("b_low") <= F.col("stop")).otherwise(F.col("b_high") >= F.col("stop"))
    keys = ["id", "ticker", "bar_no", "direction", "entry", "stop", "target"]
    hit = ahead.groupBy(*keys).agg(F.min(F.when(t, F.col("at"))).alias("t"), F.min(F.when(s, F.col("at"))).alias("s"), F.max("at").alias("last"), F.max_by("b_close", "at").alias("close"))
    win = F.col("t").isNotNull() & (F.col("s").isNull() | (F.col("t") <= F.col("s")))
    loss = ~win & F.col("s").isNotNull()
    exit_ = F.when(win, F.col("target")).when(loss, F.col("stop")).otherwise(F.col("close"))
    at = F.when(win, F.col("t")).when(loss, F.col("s")).otherwise(F.col("last"))
    out = hit.withColumn("result", F.when(win, "win").when(loss, "loss").otherwise("timeout")).withColumn("exit", exit_).withColumn("bars_held", at - F.col("bar_no"))
    return out.withColumn("pnl_pct", (F.col("exit") - F.col("entry")) * F.col("direction") / F.col("entry") * 100).drop("t", "s", "last", "close")


# How entries and exits are priced, and the slippage in basis points that the last has of its own.
EXECUTIONS = ("mid", "bid_ask", "bid_ask_slippage")
OWN_SLIPPAGE = 5.0


def fill_price(side: Column, kind: str, opening: Column, bid: Column, ask: Column, bps: float = 0.0) -> Column:
    """mid: the open; else the ask to buy and the bid to sell, where there is one above 0, or the open; slipped against the side."""
    buy = side == 1
    quote = F.when(buy, ask).otherwise(bid)
    base = opening if kind == "mid" else F.coalesce(F.when(quote > 0, quote), opening)
    slip = bps if bps > 0 else OWN_SLIPPAGE if kind == "bid_ask_slippage" else 0.0
    return base * F.when(buy, 1 + slip / 1e4).otherwise(1 - slip / 1e4)


def _quoted(bars: DataFrame) -> DataFrame:
    return bars.withColumns({c: F.lit(None).cast("double") for c in ("bid", "ask") if c not in bars.columns})


def _entered(signals: DataFrame, bars: DataFrame, latency: int) -> DataFrame:
    """Signals whose entry bar is there, with its open, bid and ask."""
    first = bars.select("ticker", (F.col("bar_no") - 1 - latency).alias("bar_no"), F.col("open").alias("e_open"), F.col("bid").alias("e_bid"), F.col("ask").alias("e_ask"))
    return signals.join(first, ["ticker", "bar_no"])


def _plan(execution: str, rr: float, bps: float) -> dict[str, Column]:
    """entry, stop, risk and target of an entered signal."""
    d = F.col("direction")
    entry = fill_price(d, execution, F.col("e_open"), F.col("e_bid"), F.col("e_ask"), bps)
    offset = F.coalesce("stop_offset", F.lit(0.0))
    stop = F.coalesce(F.col("stop_abs"), entry - d * offset)
    risk = F.when(F.col("stop_abs").isNotNull(), F.abs(entry - stop)).otherwise(offset)
    return {"entry": entry, "stop": stop, "risk": risk, "target": entry + d * risk * rr}


def _reached(target: Column, stop: Column) -> tuple[Column, Column]:
    """Whether a bar of the walk reaches the target, and the stop."""
    up = F.col("direction") == 1
    return F.when(up, F.col("b_high") >= target).otherwise(F.col("b_low") <= target), F.when(up, F.col("b_low") <= stop).otherwise(F.col("b_high") >= stop)


def _leave(result: Column, target: Column, stop: Column, bar: Column, execution: str, bps: float) -> Column:
    """The exit: at the target; at the market, but no better than the stop; or at the market."""
    d = F.col("direction")
    market = fill_price(-d, execution, bar["b_close"], bar["b_bid"], bar["b_ask"], bps)
    stopped = F.when(d == 1, F.least(market, stop)).otherwise(F.greatest(market, stop))
    return F.when(result == "win", target).when(result == "loss", stopped).otherwise(market)


def barrier_outcome_v3(signals: DataFrame, bars: DataFrame, rr: float = 2.0, timeout: int = 60, latency: int = 0, slippage_bps: float = 0.0, stop_first: bool = True, execution: str = "mid") -> DataFrame:
    """Entry in bar signal + 1 + latency, walked from that bar on for `timeout` bars more; excursions up to the exit.

    signals: ticker, bar_no, direction, stop_abs, stop_offset, id; bars may have bid and ask. Signals whose entry
    bar isn't there, or whose risk is 0, have no row. execution: see fill_price(). A stop is left at the market or the
    stop, whichever is worse. mfe is 0 or more, mae 0 or less. Running extremes go with the walk, so no bars are collected.
    """
    bars = _quoted(bars)
    start = 1 + latency
    plan = _entered(signals, bars, latency).withColumns(_plan(execution, rr, slippage_bps)).where("risk > 0")
    keys = ["id", "ticker", "bar_no", "direction", "entry", "stop", "target", "risk"]
    walk = forward_range_join(plan.select(*keys), bars, start, start + timeout)
    so_far = Window.partitionBy("id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    t, s = _reached(F.col("target"), F.col("stop"))
    walk = walk.withColumn("high", F.max("b_high").over(so_far)).withColumn("low", F.min("b_low").over(so_far)).withColumn("t", t).withColumn("s", s)
    bar = F.struct("at", "t", "s", "high", "low", "b_close", "b_bid", "b_ask")
    hit = walk.groupBy(*keys).agg(F.min(F.when(F.col("t") | F.col("s"), bar)).alias("end"), F.max(bar).alias("last"))
    x = F.coalesce("end", "last")
    result = F.when(F.col("end").isNull(), "timeout").when(x["s"] & (~x["t"] | F.lit(stop_first)), "loss").otherwise("win")
    d = F.col("direction")
    up_move, down_move = x["high"] - F.col("entry"), F.col("entry") - x["low"]
    out = hit.withColumn("result", result).withColumn("exit", _leave(F.col("result"), F.col("target"), F.col("stop"), x, execution, slippage_bps))
    out = out.withColumn("mfe", F.greatest(F.when(d == 1, up_move).otherwise(down_move), F.lit(0.0))).withColumn("mae", F.least(F.when(d == 1, -down_move).otherwise(-up_move), F.lit(0.0)))
    return out.withColumn("pnl", (F.col("exit") - F.col("entry")) * d).withColumn("duration", x["at"] - F.col("bar_no") - start).drop("end", "last")


def position_size(signals: DataFrame, risk_dollars: float, cash: float) -> DataFrame:
    """Whole shares by risk and by what cash buys at 25 % margin; rows of 0 shares go."""
    by_risk = F.floor(F.lit(risk_dollars) / F.nullif(F.abs(F.col("entry") - F.col("stop")), F.lit(0.0)))
    by_cash = F.floor(F.lit(cash) / (F.col("entry") * 0.25))
    out = signals.withColumn("shares", F.least(by_risk, by_cash)).where("shares > 0").withColumn("notional", F.col("shares") * F.col("entry")).withColumn("margin", F.col("notional") * 0.25)
    return out.withColumn("commission", F.greatest(F.lit(0.35), F.col("shares") * 0.0001))


def audit_ambiguous_bars(trades: DataFrame, bars: DataFrame, max_bars: int = 60) -> DataFrame:
    """Tests of trades against the bars they were taken in; one row of counts, from one join and one aggregation.

    trades: id, ticker, bar_no (of the entry), direction, entry, stop, target, result, exit, bars_held. ambiguous:
    some bar after the entry reaches both barriers. losses_, wins_, timeouts_stop_first: results if the stop came first
    in such bars; relabelled: those that differ from the result given. wins_target_first: if the target did.
    entry_bar_stop: the entry bar itself reaches the stop. phantom_entry: the entry bar doesn't reach the entry.
    unreachable_exit: the exit bar of a win or loss doesn't reach the exit.
    """
    ahead = forward_range_join(trades, bars, 0, max_bars - 1)
    d, at = F.col("direction"), F.col("at") - F.col("bar_no")
    t, s = _reached(F.col("target"), F.col("stop"))
    later = at >= 1
    phantom = F.when(d == 1, F.col("b_high") < F.col("entry")).otherwise(F.col("b_low") > F.col("entry"))
    with_trade, against = F.when(d == 1, F.col("b_high") >= F.col("exit")).otherwise(F.col("b_low") <= F.col("exit")), F.when(d == 1, F.col("b_low") <= F.col("exit")).otherwise(F.col("b_high") >= F.col("exit"))
    reached = F.when(F.col("result") == "win", with_trade).when(F.col("result") == "loss", against).otherwise(True)
    any_ = lambda c, name: F.max(F.coalesce(c, F.lit(False))).alias(name)
    hit = ahead.groupBy("id", "result").agg(F.min(F.when(later & t, at)).alias("t"), F.min(F.when(later & s, at)).alias("s"), any_(later & t & s, "both"), any_((at == 0) & s, "entry_stop"), any_((at == 0) & phantom, "phantom"), any_((at == F.col("bars_held")) & ~reached, "unreachable"))
    loss = F.col("s").isNotNull() & (F.col("t").isNull() | (F.col("s") <= F.col("t")))
    hit = hit.withColumn("stop_first", F.when(loss, "loss").when(F.col("t").isNotNull(), "win").otherwise("timeout"))
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    return hit.agg(
        F.count("*").alias("n"), count(F.col("both"), "ambiguous"), *(count(F.col("stop_first") == r, f"{name}_stop_first") for r, name in (("loss", "losses"), ("win", "wins"), ("timeout", "timeouts"))), count(F.col("stop_first") != F.col("result"), "relabelled"),
        count(F.col("t").isNotNull() & (F.col("s").isNull() | (F.col("t") <= F.col("s"))), "wins_target_first"), count(F.col("entry_stop"), "entry_bar_stop"), count(F.col("phantom"), "phantom_entry"), count(F.col("unreachable"), "unreachable_exit"),
    )


def metrics(pnl: str = "pnl", result: str = "result", sharpe: float = 252.0) -> list[Column]:
    """Aggregates of a group of trades."""
    p, r = F.col(pnl), F.col(result)
    count = lambda c: F.count(F.when(c, 1))
    total = lambda c: F.sum(F.when(c, p).otherwise(0.0))
    wins, losses = count(r == "win"), count(r == "loss")
    gain, loss = total(p > 0), -total(p < 0)
    n, mean, sd = F.count("*"), F.avg(p), F.stddev_samp(p)
    average_win, average_loss = F.avg(F.when(p > 0, p)), F.avg(F.when(p < 0, p))
    return [
        n.alias("n"), wins.alias("wins"), losses.alias("losses"), (wins / F.nullif(wins + losses, F.lit(0)) * 100).alias("win_rate"), F.when(loss > 0, gain / loss).otherwise(999.0).alias("profit_factor"),
        F.sum(p).alias("total_pnl"), mean.alias("mean_pnl"), F.median(p).alias("median_pnl"), sd.alias("stdev_pnl"), average_win.alias("average_win"), average_loss.alias("average_loss"), F.max(p).alias("largest_win"), F.min(p).alias("largest_loss"),
        (mean / F.nullif(sd, F.lit(0.0)) * F.sqrt(F.lit(sharpe))).alias("sharpe"), (sd * 1.96 / F.sqrt(n)).alias("ci95"), (average_win / F.nullif(-average_loss, F.lit(0.0))).alias("win_loss_ratio"),
    ]


def trade_metrics(trades: DataFrame, keys: list[str], order: list[str], pnl: str = "pnl", sharpe: float = 252.0) -> DataFrame:
    """Statistics of each group with its longest run of losses or timeouts."""
    runs = w.streaks(trades, keys, order, F.col("result") != "win", "max_losing_streak")
    return trades.groupBy(*keys).agg(*metrics(pnl, sharpe=sharpe)).join(runs, keys, "left").fillna(0, ["max_losing_streak"])


def trade_summary(trades: DataFrame, order: list[str], pnl: str = "pnl_pct") -> DataFrame:
    return trade_metrics(trades, ["ticker", "strategy", "rr_ratio"], order, pnl, 252 / 20)


def portfolio_diagnostics(trades: DataFrame, pnl: str = "pnl") -> DataFrame:
    """Outcome shares, expectancy, and daily Sharpe and Sortino by population deviations, in one row."""
    count = lambda c: F.count(F.when(F.col("result") == c, 1))
    n = F.count("*")
    whole = trades.agg(n.alias("n"), *((count(c) / n * 100).alias(f"{c}_pct") for c in ("win", "loss", "timeout")), (count("win") / F.nullif(count("win") + count("loss"), F.lit(0)) * 100).alias("win_rate"), F.avg(pnl).alias("expectancy"), F.sum(pnl).alias("total_pnl"))
    daily = trades.groupBy("day").agg(F.sum(pnl).alias("p"))
    root = F.sqrt(F.lit(252.0))
    days = daily.agg(F.count("*").alias("days"), F.avg("p").alias("mean_day"), F.max("p").alias("best_day"), F.min("p").alias("worst_day"), (F.avg("p") / F.nullif(F.stddev_pop("p"), F.lit(0.0)) * root).alias("sharpe"), (F.avg("p") / F.nullif(F.sqrt(F.avg(F.pow(F.least("p", F.lit(0.0)), F.lit(2)))), F.lit(0.0)) * root).alias("sortino"))
    return whole.crossJoin(F.broadcast(days))  # one row each


def r_multiple_histogram(trades: DataFrame, r: str = "r") -> DataFrame:
    label = F.lit(None).cast("string")
    for a, b, name in reversed(R_BINS):
        inside = (F.lit(True) if a is None else F.col(r) >= a) & (F.lit(True) if b is None else F.col(r) < b)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return trades.where(F.col(r).isNotNull()).groupBy(label.alias("bin")).agg(F.count("*").alias("n"))


def skip_reason_counts(log: DataFrame, reason: str = "reason") -> DataFrame:
    return log.groupBy(reason).agg(F.count("*").alias("n"))


def leaderboard(trades: DataFrame, order: list[str], pnl: str = "pnl", start: float = 100_000.0) -> DataFrame:
    """Strategies and ratios by 3 * profit factor + 2 * Sharpe + win rate / 10, with the mean drawdown."""
    keys = ["strategy", "rr_ratio"]
    m = trade_metrics(trades, keys, order, pnl)
    dd = w.mean_drawdown(trades, keys, order, pnl, start)
    s = 3 * F.col("profit_factor") + 2 * F.coalesce("sharpe", F.lit(0.0)) + F.coalesce("win_rate", F.lit(0.0)) / 10
    return m.join(dd, keys).withColumn("score", s).withColumn("confidence", F.when(F.col("n") < 20, "LOW").otherwise("OK"))


def best_of(rows: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    from pyspark.sql import Window

    return rows.withColumn("best", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("best = 1").drop("best")


def by_quintile(trades: DataFrame, names: list[str], pnl: str = "pnl") -> DataFrame:
    """Statistics of each quintile of several measures; all quantiles are found in the same few passes."""
    edges = exact_quantiles(written(trades.select(*names)), names, [k / 5 for k in range(6)])
    parts = F.array(*(F.struct(F.lit(c).alias("metric"), w.quantile_bin(F.col(c).cast("double"), edges[c]).alias("quintile")) for c in names))
    long = trades.withColumn("m", F.explode(parts)).select("*", "m.*").where("quintile is not null")
    return long.groupBy("metric", "quintile").agg(*metrics(pnl))


def robustness_grid(signals: DataFrame, bars: DataFrame, ratios: tuple[float, ...], timeouts: tuple[int, ...], executions: tuple[str, ...] = EXECUTIONS, latency: int = 0, slippage_bps: float = 0.0, stop_first: bool = True) -> DataFrame:
    """Statistics of barrier_outcome_v3() over a grid of reward ratios, timeouts and executions; the walk is joined once.

    signals: ticker, bar_no, direction, stop_abs, stop_offset, id. The first bar that ends a trade follows from
    ratio and execution, the last bar from the timeout; so a walk's row is not copied for each cell, and an aggregation of
    plain numbers finds both. Only exits, a row a signal and cell, are joined to their bars' prices.
    """
    bars = _quoted(bars)
    start = 1 + latency
    cells = [(e, r) for e in executions for r in ratios]
    entered = _entered(signals, bars, latency)
    plans = F.array(*(F.struct(F.lit(e).alias("execution"), F.lit(r).alias("rr"), *(c.alias(n) for n, c in _plan(e, r, slippage_bps).items())) for e, r in cells))
    planned = entered.select("id", "ticker", "bar_no", "direction", plans.alias("plans"))
    narrow = entered.select("id", "ticker", "bar_no", "direction", "stop_abs", "stop_offset", "e_open", "e_bid", "e_ask")
    walk = forward_range_join(narrow, bars.drop("bid", "ask"), start, start + max(timeouts))
    ends = []
    for k, (execution, rr) in enumerate(cells):
        plan = _plan(execution, rr, slippage_bps)
        t, s = _reached(plan["target"], plan["stop"])
        ends.append(F.min(F.when(t | s, F.col("at") * 4 + F.when(s, 2).otherwise(0) + F.when(t, 1).otherwise(0))).alias(f"end{k}"))
    lasts = [F.max(F.when(F.col("at") <= F.col("bar_no") + start + m, F.col("at"))).alias(f"last{m}") for m in timeouts]
    hit = walk.groupBy("id", "ticker", "bar_no").agg(*ends, *lasts)
    rows = []
    for k in range(len(cells)):
        end = F.col(f"end{k}")
        at, stopped, reached = F.floor(end / 4), end.bitwiseAND(F.lit(2)) > 0, end.bitwiseAND(F.lit(1)) > 0
        for m in timeouts:
            within = end.isNotNull() & (at <= F.col("bar_no") + start + m)
            result = F.when(~within, "timeout").when(stopped & (~reached | F.lit(stop_first)), "loss").otherwise("win")
            rows.append(F.struct(F.lit(k).alias("k"), F.lit(m).alias("timeout"), result.alias("result"), F.when(within, at).otherwise(F.col(f"last{m}")).alias("at")))
    exits = hit.select("id", "ticker", "bar_no", F.inline(F.array(*rows))).join(planned.select("id", "bar_no", "ticker", "direction", "plans"), ["id", "ticker", "bar_no"])
    exits = exits.withColumn("p", F.col("plans")[F.col("k")]).select("ticker", "at", "timeout", "result", "direction", "p.*").where("risk > 0")
    prices = bars.select("ticker", F.col("bar_no").alias("at"), F.struct(F.col("close").alias("b_close"), F.col("bid").alias("b_bid"), F.col("ask").alias("b_ask")).alias("bar"))
    left = F.coalesce(*(F.when(F.col("execution") == e, _leave(F.col("result"), F.col("target"), F.col("stop"), F.col("bar"), e, slippage_bps)) for e in executions))
    done = exits.join(prices, ["ticker", "at"]).withColumn("pnl", (left - F.col("entry")) * F.col("direction"))
    return done.groupBy("rr", "timeout", "execution").agg(*metrics("pnl"))
