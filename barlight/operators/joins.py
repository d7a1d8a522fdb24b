"""Joins of market tables by key, by time and by range. Catalyst picks the physical join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.functions.scalars import new_york, session_label
from barlight.operators.scans import last_known


def align_feature_bars(bars: DataFrame, trade_bars: DataFrame | None = None, quote_bars: DataFrame | None = None, option_bars: DataFrame | None = None, on: tuple[str, ...] = ("ticker", "ts")) -> DataFrame:
    """Bars with the columns of the other bars of the same key, prefixed tr_, qu_ and opt_."""
    for side, prefix in ((trade_bars, "tr_"), (quote_bars, "qu_"), (option_bars, "opt_")):
        if side is not None:
            bars = bars.join(prefix_columns(side, prefix, on), list(on), "left")
    return bars


def prefix_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("ticker", "ts")) -> DataFrame:
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns))


def asof_ffill_join(bars: DataFrame, facts: DataFrame, columns: list[str], key: str = "ticker", ts: str = "ts") -> DataFrame:
    """Each bar with the last non-null value of each column of facts at or before it.

    One union of both, in slices of time of a key: no pair of rows is ever made, and no task has a whole key.
    """
    none = lambda c: F.lit(None).alias(c)
    struct = F.struct(*bars.columns)
    left = bars.select(F.col(key).alias("k"), F.col(ts).alias("t"), F.lit(1).alias("side"), struct.alias("row"), *map(none, columns))
    right = facts.select(F.col(key).alias("k"), F.col(ts).alias("t"), F.lit(0).alias("side"), F.lit(None).alias("row"), *columns)
    known = last_known(left.unionByName(right), columns, "k", ["t", "side"])
    return known.where("side = 1").select("row.*", *(F.col(f"known_{c}").alias(c) for c in columns))


def valid_from(rows: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Rows as intervals [valid_from, valid_to); the first of a key reaches back without end."""
    w = Window.partitionBy(*key).orderBy(ts)
    first = F.row_number().over(w) == 1
    return rows.withColumn("valid_from", F.when(~first, F.col(ts))).withColumn("valid_to", F.lead(ts).over(w))


def asof_yield_join(rows: DataFrame, curve: DataFrame, date: str = "day") -> DataFrame:
    """Each row with the latest curve at or before its date, or the first curve before that; a null date has none.

    The curve is looked up once for each different date, of which there are as many as days; rows are then
    joined by equal dates, so no rows are compared with ranges and the curve may be of any length. What was found, a
    row a day, is sent to the rows, which are not shuffled for it.
    """
    columns = [c for c in curve.columns if c != "date"]
    dates = rows.select(F.col(date).alias("at")).where("at is not null").distinct().withColumn("c", F.lit(None))
    known = curve.select(F.col("date").alias("at"), F.struct(F.col("date").alias("curve_date"), *columns).alias("c"))
    both = known.withColumn("side", F.lit(0)).unionByName(dates.withColumn("side", F.lit(1)))
    # a row a day: the only table here that one task sorts
    days = Window.orderBy("at", "side")
    here = F.last("c", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first("c", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found = both.withColumn("c", F.coalesce(here, first)).where("side = 1").select(F.col("at").alias("asof_date"), "c.*")
    return rows.join(F.broadcast(found), F.col(date) == F.col("asof_date"), "left").select(*(rows[c] for c in rows.columns), "curve_date", *columns)


def minute_backfill_join(rows: DataFrame, minutes: DataFrame, column: str = "underlying") -> DataFrame:
    """Null values of a column from the close of the row's minute (ticker, minute, close)."""
    m = minutes.select("ticker", F.col("minute").alias("m"), F.col("close").alias("c"))
    keyed = rows.withColumn("m", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    return keyed.join(m, ["ticker", "m"], "left").withColumn(column, F.coalesce(column, "c")).select(*rows.columns)


def contract_underlying_ffill(chains: DataFrame, minutes: DataFrame, contract: str = "contract") -> DataFrame:
    """The underlying of the exact minute, else the last known of the contract."""
    rows = chains.join(minutes.select("ticker", F.col("ts"), F.col("close").alias("u")), ["ticker", "ts"], "left")
    w = Window.partitionBy(contract).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("underlying", F.last("u", ignorenulls=True).over(w)).drop("u")


def bar_override_join(bars: DataFrame, observed: DataFrame, columns: tuple[str, ...] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Observed rows with the values of bars where there is a bar."""
    b = bars.select("ticker", "ts", *(F.col(c).alias("b_" + c) for c in columns))
    return observed.join(b, ["ticker", "ts"], "left").withColumns({c: F.coalesce("b_" + c, c) for c in columns}).drop(*("b_" + c for c in columns))


def split_intervals(splits: DataFrame) -> DataFrame:
    """ticker, before, factor: the product of all ratios of later splits, for rows before a split and not before the one before."""
    later = Window.partitionBy("ticker").orderBy(F.desc("execution_date"))
    upto = later.rowsBetween(Window.unboundedPreceding, 0)
    ratio = F.col("split_to") / F.col("split_from")
    factor = F.product(ratio).over(upto)
    start = F.lead("execution_date").over(later)
    return splits.select("ticker", start.alias("start"), F.col("execution_date").alias("before"), factor.alias("factor"))


def split_factor_join(rows: DataFrame, splits: DataFrame, date: str = "day", name: str = "factor") -> DataFrame:
    """name: the product of split_to / split_from over splits with execution_date > date; 1 without. A row stays one row."""
    steps = split_intervals(splits).withColumnsRenamed({"ticker": "tk", "factor": name})
    on = (F.col("ticker") == F.col("tk")) & (F.col(date) < F.col("before")) & (F.col("start").isNull() | (F.col(date) >= F.col("start")))
    return rows.join(steps, on, "left").withColumn(name, F.coalesce(name, F.lit(1.0))).drop("tk", "start", "before")


def confluence_semi_join(primary: DataFrame, others: list[DataFrame], least: int = 1, on: tuple[str, ...] = ("ticker", "ts", "direction")) -> DataFrame:
    """Primary signals that at least `least` of the other sets have at the same bar and direction."""
    tagged = [o.select(*on).distinct().withColumn("set", F.lit(k)) for k, o in enumerate(others)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    enough = union.groupBy(*on).agg(F.count("*").alias("sets")).where(F.col("sets") >= least)
    return primary.join(enough, list(on), "left_semi")


def forward_range_join(signals: DataFrame, bars: DataFrame, first: int, last: int) -> DataFrame:
    """Each signal with the bars first .. last places ahead: as equal keys, not as a range. b_bid and b_ask come along if bars have them."""
    ahead = signals.withColumn("at", F.explode(F.sequence(F.col("bar_no") + first, F.col("bar_no") + last)))
    b = bars.select("ticker", F.col("bar_no").alias("at"), F.col("open").alias("b_open"), F.col("high").alias("b_high"), F.col("low").alias("b_low"), F.col("close").alias("b_close"), *(F.col(c).alias(f"b_{c}") for c in ("bid", "ask") if c in bars.columns))
    return ahead.join(b, ["ticker", "at"])


def trades_by_ticker_quantile(trades: DataFrame, days: DataFrame, on: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """Trades with the quintile of their ticker-day. on=("ticker",) multiplies trades by days."""
    return trades.join(days.select(*on, "quintile"), list(on))


def missing_keys(reference: DataFrame, target: DataFrame, key: str = "ticker") -> DataFrame:
    return reference.select(key).distinct().join(target.select(key).distinct(), key, "left_anti").orderBy(key)


def exclude_tickers(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    return rows.join(excluded.select("ticker").distinct(), "ticker", "left_anti")


def incremental_anti_join(rows: DataFrame, done: DataFrame, key: str = "ticker") -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def universe_semi_join(signals: DataFrame, universe: DataFrame, on: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    return signals.join(universe.select(*on).distinct(), list(on), "left_semi")


def enrich_reference_join(rows: DataFrame, fundamentals: DataFrame, reference: DataFrame) -> DataFrame:
    return rows.join(fundamentals, "ticker", "left").join(reference, "ticker", "left")


def complete_grid(counts: DataFrame, key: str = "exchange", slots: int = 48) -> DataFrame:
    """Every key with every slot, 0 where there was none. Slots are a day's half hours, so the grid is keys times 48."""
    grid = counts.select(key).distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return grid.join(counts, [key, "slot"], "left").fillna(0)


def outer_align_closes(bars: DataFrame, symbols: list[str]) -> DataFrame:
    return bars.groupBy("ts").pivot("ticker", symbols).agg(F.first("close"))


def ticker_list_distinct(lists: list[DataFrame], clean: Column | None = None) -> DataFrame:
    out = lists[0].select("ticker")
    for x in lists[1:]:
        out = out.unionByName(x.select("ticker"))
    return (out.select(clean.alias("ticker")) if clean is not None else out).distinct()


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other has fewer times, as often as they are more; columns go by name."""
    b = b.select(*a.columns)
    return a.exceptAll(b).unionByName(b.exceptAll(a))


def chain_day_join(days: DataFrame, chains: DataFrame, keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """Daily rows with what their day's chain comes to: contracts, volume and mean IV; null where there is no chain.

    The chain is brought down to a row a ticker and day before the join.
    """
    daily = chains.groupBy(*keys).agg(F.count("*").alias("chain_rows"), F.sum("volume").alias("chain_volume"), F.avg("iv").alias("chain_iv"))
    return days.join(daily, list(keys), "left")


def session_labels(rows: DataFrame, calendar: DataFrame, ts: str = "ts", name: str = "session") -> DataFrame:
    """Rows with their session by the New York clock. calendar: date, closed, early_close (minute of the day, or null).

    Weekends are closed, and days that the calendar doesn't name are whole trading days. It has a row a day.
    """
    local = new_york(F.col(ts))
    special = calendar.select(F.col("date").alias("special_date"), F.struct("closed", "early_close").alias("special"))
    joined = rows.withColumn("special_date", F.to_date(local)).join(special, "special_date", "left")
    closed = F.coalesce("special.closed", F.lit(False)) | F.dayofweek(local).isin(1, 7)
    return joined.withColumn(name, session_label(F.col(ts), closed, F.col("special.early_close"))).select(*rows.columns, name)
