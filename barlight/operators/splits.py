"""Price-basis repair: finding splits and putting tables on one basis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlight.operators.joins import split_factor_join

# Columns that a split scales, and usual ratios.
PRICES = ("underlying", "atm_strike", "call_close", "put_close", "straddle", "expected_move")
RATIOS = (1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 15.0, 20.0, 25.0, 30.0, 50.0)


def dedupe_splits(splits: DataFrame) -> DataFrame:
    """One row of each ticker and date: that of the smallest id."""
    n = F.row_number().over(Window.partitionBy("ticker", "execution_date").orderBy("id"))
    return splits.withColumn("n", n).where("n = 1").drop("n")


def adjust_option_splits(features: DataFrame, splits: DataFrame, date: str = "day", price_op: str = "multiply") -> DataFrame:
    """Prices times (or divided by) the factor of all later splits; the straddle is the sum of its legs again."""
    out = split_factor_join(features, splits, date)
    f = F.col("factor") if price_op == "multiply" else 1 / F.col("factor")
    out = out.withColumns({c: F.col(c) * f for c in PRICES if c in features.columns})
    if {"call_close", "put_close"} <= set(features.columns):
        legs = F.coalesce(F.col("call_close") + F.col("put_close"), F.col("call_close"), F.col("put_close"))
        out = out.withColumn("straddle", F.when(F.col("factor") != 1, legs).otherwise(F.col("straddle"))).withColumn("expected_move", F.col("straddle"))
    return out


def validate_adjusted(features: DataFrame) -> DataFrame:
    """Counts of errors (negative price, straddle unlike expected move) and warnings (strike or straddle far off)."""
    s = F.col("underlying")
    tests = {"negative_price": F.least("atm_strike", "call_close", "put_close", "straddle") < 0, "straddle_mismatch": F.abs(F.col("straddle") - F.col("expected_move")) > 1e-6, "strike_far": F.abs(F.col("atm_strike") - s) > 0.25 * s, "straddle_large": F.col("straddle") > 0.5 * s}
    return features.agg(F.count("*").alias("n"), *(F.sum(F.coalesce(t.cast("long"), F.lit(0))).alias(n) for n, t in tests.items()))


def daily_price_ratio(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """ratio of the mean trade vwap to the last close of each ticker and day."""
    a = trades.groupBy("ticker", "day").agg(F.avg("vwap").alias("vwap"))
    b = bars.groupBy("ticker", "day").agg(F.max_by("close", "ts").alias("close"))
    return a.join(b, ["ticker", "day"]).select("ticker", "day", (F.col("vwap") / F.nullif(F.col("close"), F.lit(0.0))).alias("ratio"))


def detect_splits(ratios: DataFrame, least: int = 40, side: int = 10) -> DataFrame:
    """ticker, split_date, factor: where the daily ratio of two sources steps back to one.

    A day is divergent outside [1 / 1.2, 1.2]. The boundary is the first consistent day after the last
    divergent one; a ticker needs `least` days, `side` on each side, half of the days before divergent,
    and medians that differ by more than 1.25; the factor snaps to a usual ratio within 2 %.
    """
    off = (F.col("ratio") > 1.2) | (F.col("ratio") < 1 / 1.2)
    days = ratios.where("ratio is not null").withColumn("off", off)
    last = days.groupBy("ticker").agg(F.max(F.when(F.col("off"), F.col("day"))).alias("last_off"), F.count("*").alias("n")).where((F.col("n") >= least) & F.col("last_off").isNotNull())
    both = days.join(last, "ticker").withColumn("pre", F.col("day") <= F.col("last_off"))
    out = both.groupBy("ticker").agg(
        F.min(F.when(~F.col("pre"), F.col("day"))).alias("split_date"), F.count(F.when(F.col("pre"), 1)).alias("n_pre"), F.count(F.when(~F.col("pre"), 1)).alias("n_post"), F.avg(F.when(F.col("pre"), F.col("off").cast("int"))).alias("share"),
        (F.median(F.when(F.col("pre"), F.col("ratio"))) / F.median(F.when(~F.col("pre"), F.col("ratio")))).alias("raw"),
    )
    big = F.greatest("raw", 1 / F.col("raw"))
    out = out.where((F.col("n_pre") >= side) & (F.col("n_post") >= side) & (F.col("share") >= 0.5) & (big > 1.25))
    known = F.array(*map(F.lit, RATIOS))
    near = F.filter(known, lambda r: F.abs(big / r - 1) <= 0.02)
    snapped = F.coalesce(F.get(near, 0), big)
    return out.select("ticker", "split_date", F.when(F.col("raw") >= 1, snapped).otherwise(1 / snapped).alias("factor"))


def adjust_trades_quotes(rows: DataFrame, records: DataFrame, prices: tuple[str, ...], sizes: tuple[str, ...]) -> DataFrame:
    """Prices divided, and sizes multiplied, by the product of the factors of the ticker's splits after the row's day.

    records: ticker, split_date, factor, any number a ticker; a row stays one row. Always from the raw table.
    """
    steps = records.select("ticker", F.col("split_date").alias("execution_date"), F.col("factor").alias("split_to"), F.lit(1.0).alias("split_from"))
    out = split_factor_join(rows, steps, name="later_splits")
    f = F.col("later_splits")
    return out.withColumns({c: F.col(c) / f for c in prices} | {c: F.col(c) * f for c in sizes}).select(*rows.columns)


def check_split_consistency(ratios: DataFrame, records: DataFrame) -> DataFrame:
    """OK if the medians of the ratio before and after agree within 1.15, else STEP; MISSING without days on a side."""
    j = records.join(ratios, "ticker", "left")
    pre = F.median(F.when(F.col("day") < F.col("split_date"), F.col("ratio")))
    post = F.median(F.when(F.col("day") >= F.col("split_date"), F.col("ratio")))
    out = j.groupBy("ticker", "split_date").agg(pre.alias("pre"), post.alias("post"))
    step = F.col("pre") / F.col("post")
    return out.withColumn("status", F.when(step.isNull(), "MISSING").when(step.between(1 / 1.15, 1.15), "OK").otherwise("STEP"))
