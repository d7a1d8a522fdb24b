"""Rolling measures of each ticker's bars in order of time.

All windows of a call share one partitioning and order, so Spark sorts once. A rolling measure of n
rows is null until it has n values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.scalars import safe_divide
from barlight.operators.scans import exact_quantiles, with_ema
from barlight.sources.shared import written


def by_ticker(*more: str) -> WindowSpec:
    return Window.partitionBy("ticker", *more).orderBy("ts")


def gated(agg, c: Column, first: int, last: int, n: int, window: WindowSpec | None = None) -> Column:
    """agg of c over rows first .. last, null unless n of them have a value."""
    w = (window or by_ticker()).rowsBetween(first, last)
    return F.when(F.count(c).over(w) == n, agg(c).over(w))


def lag(c: str | Column, n: int = 1) -> Column:
    return F.lag(c, n).over(by_ticker())


def bar_number() -> Column:
    return F.row_number().over(by_ticker()) - 1


def returns() -> Column:
    return F.col("close") / lag("close") - 1


def log_returns() -> Column:
    return F.log(F.col("close") / lag("close"))


def bar_range() -> Column:
    return F.col("high") - F.col("low")


def true_range() -> Column:
    before = lag("close")
    return F.coalesce(F.greatest(bar_range(), F.abs(F.col("high") - before), F.abs(F.col("low") - before)), bar_range())


def with_atr(bars: DataFrame, n: int = 14) -> DataFrame:
    out = bars.withColumn("true_range", true_range())
    atr = gated(F.avg, F.col("true_range"), -(n - 1), 0, n)
    return out.withColumn("atr", atr).withColumn("atr_pct", F.col("atr") / F.col("close") * 100)


def with_rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength by plain means of gains and losses; the first change is 0, and no loss at all gives 0."""
    out = bars.withColumn("change", F.coalesce(F.col("close") - lag("close"), F.lit(0.0)))
    gain = gated(F.avg, F.greatest(F.col("change"), F.lit(0.0)), -(n - 1), 0, n)
    loss = gated(F.avg, F.greatest(-F.col("change"), F.lit(0.0)), -(n - 1), 0, n)
    out = out.withColumn("g", gain).withColumn("l", loss)
    strength = F.when(F.col("l") > 0, F.col("g") / F.col("l")).otherwise(0.0)
    return out.withColumn("rsi", F.when(F.col("g").isNotNull(), 100 - 100 / (1 + strength))).drop("g", "l", "change")


def with_volume_ma(bars: DataFrame, n: int = 20) -> DataFrame:
    out = bars.withColumn("volume_ma", gated(F.avg, F.col("volume"), -(n - 1), 0, n))
    return out.withColumn("rel_vol", safe_divide(F.col("volume"), F.col("volume_ma")))


def with_return_stdev(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.withColumn("ret", returns()).withColumn("return_stdev", gated(F.stddev_samp, F.col("ret"), -(n - 1), 0, n)).drop("ret")


def with_session_vwap(bars: DataFrame) -> DataFrame:
    day = Window.partitionBy("ticker", F.to_date("ts")).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    vwap = safe_divide(F.sum(F.col("close") * F.col("volume")).over(day), F.sum("volume").over(day))
    return bars.withColumn("session_vwap", vwap).withColumn("vwap_dist_pct", (F.col("close") - F.col("session_vwap")) / F.col("session_vwap") * 100)


def rolling_vwap(n: int = 20) -> Column:
    """Of the n bars before this one."""
    w = by_ticker().rowsBetween(-n, -1)
    return F.when(F.count("close").over(w) == n, F.sum(F.col("close") * F.col("volume")).over(w) / (F.sum("volume").over(w) + 1e-9))


def with_local_atr(bars: DataFrame, k: int, name: str = "local_atr") -> DataFrame:
    """Mean absolute change of the close inside the k bars before this one."""
    out = bars.withColumn("move", F.abs(F.col("close") - lag("close")))
    return out.withColumn(name, gated(F.avg, F.col("move"), -(k - 1), -1, k - 1)).drop("move")


def with_prior(bars: DataFrame, n: int = 5) -> DataFrame:
    """prior_high, prior_low and prior_avg_volume of the n bars before."""
    return bars.withColumn("prior_high", gated(F.max, F.col("high"), -n, -1, n)).withColumn("prior_low", gated(F.min, F.col("low"), -n, -1, n)).withColumn("prior_avg_volume", gated(F.avg, F.col("volume"), -n, -1, n))


def sma(c: str = "close", n: int = 20) -> Column:
    return gated(F.avg, F.col(c), -(n - 1), 0, n)


def with_macd(bars: DataFrame, short: int = 12, long: int = 26, signal: int = 9) -> DataFrame:
    out = with_ema(bars, {"ema_short": short, "ema_long": long}).withColumn("macd", F.col("ema_short") - F.col("ema_long"))
    return with_ema(out, {"macd_signal": signal}, "macd").withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("ema_short", "ema_long")


def price_move() -> Column:
    return lag("close", 1) - lag("close", 5)


def volume_spike(n: int = 50) -> Column:
    return safe_divide(F.col("volume"), gated(F.avg, F.col("volume"), -(n - 1), 0, n))


def inter_trade_gap() -> Column:
    """Mean seconds between trades of a group."""
    n = F.count("*")
    return F.when(n > 1, (F.max("sip_ns") - F.min("sip_ns")) / 1e9 / (n - 1)).otherwise(0.0)


def of_day(bars: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The first or last rows of each ticker and UTC day."""
    day = Window.partitionBy("ticker", F.to_date("ts"))
    n = F.row_number().over(day.orderBy("ts")) if first else F.row_number().over(day.orderBy(F.desc("ts")))
    return bars.withColumn("n_of_day", n).where(F.col("n_of_day") <= (first or last))


def opening_range(bars: DataFrame, n: int) -> DataFrame:
    """High and low of the first n bars of each ticker's UTC day."""
    return of_day(bars, first=n).groupBy("ticker", F.to_date("ts").alias("day")).agg(F.max("high").alias("or_high"), F.min("low").alias("or_low"), F.max("ts").alias("or_end"))


def _clean(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def _cut(x: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd inside -3 .. 3; 0 without deviation."""
    z = F.coalesce((x - mean) / F.nullif(sd, F.lit(0.0)), F.lit(0.0))
    return F.least(F.greatest(z, F.lit(-3.0)), F.lit(3.0))


def zscore_0_100(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """z-scores over all rows, cut at 3, as 0 .. 100; 50 without deviation. One aggregation serves all columns."""
    stats = df.agg(*(f(_clean(F.col(c))).alias(f"{n}_{k}") for n, c in columns.items() for k, f in (("m", F.avg), ("s", F.stddev_samp))))
    out = df.crossJoin(F.broadcast(stats))  # one row
    for n, c in columns.items():
        out = out.withColumn(n, (_cut(_clean(F.col(c)), F.col(f"{n}_m"), F.col(f"{n}_s")) + 3) / 6 * 100)
    return out.drop(*stats.columns)


def zscore_clip(c: str, *keys: str) -> Column:
    """z-score inside the keys, cut at 3; 0 without deviation."""
    w = Window.partitionBy(*keys)
    x = _clean(F.col(c))
    return _cut(x, F.avg(x).over(w), F.stddev_samp(x).over(w))


def trade_count_anomaly(days: DataFrame, n: int = 5, above: float = 3) -> DataFrame:
    """Days whose transactions are more than `above` deviations over the n days before, with the change of the close."""
    w = Window.partitionBy("ticker").orderBy("day")
    mean = gated(F.avg, F.col("transactions"), -n, -1, n, w)
    sd = gated(F.stddev_samp, F.col("transactions"), -n, -1, n, w)
    before = F.lag("close").over(w)
    out = days.select("ticker", "day", "transactions", "close", mean.alias("avg_trades"), sd.alias("std_trades"), ((F.col("close") - before) / before * 100).alias("price_diff"))
    out = out.withColumn("z", (F.col("transactions") - F.col("avg_trades")) / F.nullif(F.col("std_trades"), F.lit(0.0)))
    return out.where(F.col("z") > above)


def lookback_mean(days: DataFrame, column: str, n: int = 20, least: int = 5) -> Column:
    """Mean of up to n daily rows strictly before; null with fewer than `least`."""
    w = Window.partitionBy("ticker").orderBy("day").rowsBetween(-n, -1)
    return F.when(F.count(column).over(w) >= least, F.avg(column).over(w))


def quantile_bin(x: Column, edges: list[float]) -> Column:
    """Bin 1 .. of a value by the quantiles from 0 to 1, closed at the right; equal edges are one."""
    inner = sorted(set(edges))[1:-1]
    return F.when(x.isNotNull(), sum((F.when(F.lit(e) < x, 1).otherwise(0) for e in inner), F.lit(1)))


def quintile(df: DataFrame, column: str, bins: int = 5) -> DataFrame:
    """Bin 1 .. bins by linearly interpolated quantiles, closed at the right; equal edges are one.

    The quantiles are exact and found in a few passes over the column, which is written once for them.
    """
    edges = exact_quantiles(written(df.select(column)), [column], [k / bins for k in range(bins + 1)])[column]
    return df.withColumn("quintile", quantile_bin(F.col(column), edges))


def _in_slices(trades: DataFrame, keys: list[str], order: list[str], **more: Column) -> DataFrame:
    """keys, order and more of trades, with slice_no: the day of order's first column, or its value if it is no time. Without a day comes first."""
    day = F.col(order[0])
    if not isinstance(trades.schema[order[0]].dataType, T.NumericType):
        day = F.unix_date(day.cast("date"))
    return trades.select(*dict.fromkeys([*keys, *order]), F.coalesce(day.cast("long"), F.lit(-(2**63))).alias("slice_no"), *(c.alias(n) for n, c in more.items()))


def streaks(trades: DataFrame, keys: list[str], order: list[str], flag: Column, name: str) -> DataFrame:
    """Longest run of rows with the flag in each group that has one. order: its first column is a time, or a number that many rows share.

    A group's rows lie in slices, a day each. A slice gives its rows, its longest run and the runs at both ends; these, a row a slice, are put together.
    """
    inside = Window.partitionBy(*keys, "slice_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = _in_slices(trades, keys, order, flagged=F.coalesce(flag, F.lit(False))).withColumn("breaks", F.sum(F.when(F.col("flagged"), 0).otherwise(1)).over(inside))
    runs = marked.groupBy(*keys, "slice_no", "breaks").agg(F.count("*").alias("n"), F.count_if("flagged").alias("run"))
    slices = runs.groupBy(*keys, "slice_no").agg(F.sum("n").alias("n"), F.max("run").alias("best"), F.coalesce(F.max(F.when(F.col("breaks") == 0, F.col("run"))), F.lit(0)).alias("first"), F.max_by("run", "breaks").alias("last"), F.max("breaks").alias("breaks"))
    all_ = Window.partitionBy(*keys).orderBy("slice_no")
    before = all_.rowsBetween(Window.unboundedPreceding, -1)
    # The run that goes on from the slices before: all of their rows since the last that has a break, and what that one ends with.
    slices = slices.withColumn("since", F.when(F.col("breaks") > 0, F.col("last") - F.sum("n").over(all_.rowsBetween(Window.unboundedPreceding, 0))))
    carried = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.coalesce(F.last("since", ignorenulls=True).over(before), F.lit(0))
    longest = slices.withColumn("carried", carried).groupBy(*keys).agg(F.max(F.greatest(F.col("best"), F.col("carried") + F.col("first"))).alias(name))
    return longest.where(F.col(name) > 0)


def mean_drawdown(trades: DataFrame, keys: list[str], order: list[str], pnl: str, start: float) -> DataFrame:
    """Mean of equity()'s drawdown in each group with keys, without a task for a whole group. order: as in streaks().

    Sums so far and their largest are taken inside slices; the sum and the highest equity before a slice, a row a slice, are joined to its rows.
    """
    inside = Window.partitionBy(*keys, "slice_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = _in_slices(trades, keys, order, p=F.col(pnl)).withColumn("so_far", F.sum("p").over(inside)).withColumn("most", F.max("so_far").over(inside))
    before = Window.partitionBy(*keys).orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*keys, "slice_no").agg(F.sum("p").alias("total"), F.max("so_far").alias("highest")).withColumn("sum_before", F.sum("total").over(before))
    ends = ends.withColumn("top_before", F.max(F.coalesce("sum_before", F.lit(0)) + F.col("highest")).over(before))
    out = rows.join(ends.select(*keys, "slice_no", "sum_before", "top_before"), [*keys, "slice_no"])
    carried = F.coalesce("sum_before", F.lit(0))
    running = F.when(F.col("so_far").isNull(), F.col("sum_before")).otherwise(F.col("so_far") + carried)
    top = F.lit(start) + F.greatest(carried + F.col("most"), F.col("top_before"), F.lit(0.0))
    return out.groupBy(*keys).agg(F.avg((top - (F.lit(start) + running)) / top * 100).alias("mean_drawdown"))


def equity(trades: DataFrame, keys: list[str], order: list[str], pnl: str, start: float) -> DataFrame:
    """running_pnl, equity and drawdown in percent of the highest equity so far."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = trades.withColumn("running_pnl", F.sum(pnl).over(w)).withColumn("equity", F.lit(start) + F.col("running_pnl"))
    top = F.greatest(F.max("equity").over(w), F.lit(start))
    return out.withColumn("drawdown", (top - F.col("equity")) / top * 100)
