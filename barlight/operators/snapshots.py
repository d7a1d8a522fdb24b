"""Snapshots: the state of each ticker or contract after the newest trade and quote."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlight.functions.scalars import minute_of_day, new_york

# Minutes of the New York day at which the regular session begins and ends.
OPENS, CLOSES = 570, 960


def full_snapshot(ticks: DataFrame, quotes: DataFrame) -> DataFrame:
    """A row a ticker with trades: its last New York day and minute, the day before, last trade and quote, and changes.

    ticks: ticker, sip_ns, ts (UTC), price, size, exchange, sequence; quotes: ticker, sip_ns, bid_price, ask_price,
    bid_size, ask_size. early_change and regular_change: the last price of that part of the day against the close of
    the day before; late_change: the last price after the close against the last regular one; null without trades in that
    part. Ticks become minutes, partially aggregated, and days come of these; only days, a row each, are put in order. Ties
    go by sequence, those of quotes by their values. A ticker without quotes has nulls there.
    """
    local = new_york(F.col("ts"))
    minute = minute_of_day(local)
    part = F.when(minute < OPENS, "early").when(minute < CLOSES, "regular").otherwise("late")
    rows = ticks.where("price is not null").select("ticker", F.to_date(local).alias("day"), minute.alias("minute"), part.alias("part"), "price", "size", F.struct("sip_ns", "sequence", "price", "size", "exchange").alias("at"))
    minutes = rows.groupBy("ticker", "day", "minute", "part").agg(F.min_by("price", "at").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "at").alias("close"), F.sum("size").alias("volume"), F.sum(F.col("price") * F.col("size")).alias("notional"), F.count("*").alias("transactions"), F.max("at").alias("last"))
    last_of = lambda p: F.max_by("close", F.when(F.col("part") == p, F.col("minute"))).alias(p)
    bar = F.struct("minute", "open", "high", "low", "close", "volume", (F.col("notional") / F.nullif(F.col("volume"), F.lit(0.0))).alias("vwap"), "transactions")
    days = minutes.groupBy("ticker", "day").agg(F.min_by("open", "minute").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "minute").alias("close"), F.sum("volume").alias("volume"), F.sum("notional").alias("notional"), F.sum("transactions").alias("transactions"), F.max_by(bar, "minute").alias("min"), F.max("last").alias("trade"), *map(last_of, ("early", "regular", "late")))
    before = F.lag(F.struct("day", "open", "high", "low", "close", "volume")).over(Window.partitionBy("ticker").orderBy("day"))
    newest = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("day")))
    now = days.withColumn("prev", before).withColumn("newest", newest).where("newest = 1")
    last_quote = quotes.groupBy("ticker").agg(F.max(F.struct("sip_ns", "bid_price", "ask_price", "bid_size", "ask_size")).alias("quote"))
    now = now.join(last_quote, "ticker", "left")
    change = F.col("close") - F.col("prev.close")
    return now.select(
        "ticker", "day", *(F.col(c).alias(f"day_{c}") for c in ("open", "high", "low", "close", "volume")), (F.col("notional") / F.nullif(F.col("volume"), F.lit(0.0))).alias("day_vwap"), F.col("transactions").alias("day_transactions"),
        *(F.col(f"prev.{c}").alias(f"prev_{c}") for c in ("open", "high", "low", "close", "volume")), *(F.col(f"min.{c}").alias(f"min_{c}") for c in ("minute", "open", "high", "low", "close", "volume", "vwap", "transactions")),
        F.col("trade.price").alias("trade_price"), F.col("trade.size").alias("trade_size"), F.col("trade.exchange").alias("trade_exchange"), F.col("trade.sip_ns").alias("trade_ns"),
        *(F.col(f"quote.{c}").alias(c) for c in ("bid_price", "bid_size", "ask_price", "ask_size")), F.greatest("trade.sip_ns", "quote.sip_ns").alias("updated"),
        change.alias("change"), (change / F.col("prev.close") * 100).alias("change_pct"), (F.col("early") - F.col("prev.close")).alias("early_change"), (F.col("regular") - F.col("prev.close")).alias("regular_change"), (F.col("late") - F.col("regular")).alias("late_change"),
    )


def option_snapshot(chains: DataFrame, underlyings: DataFrame, order: list[str]) -> DataFrame:
    """The newest state of each contract: day's prices, greeks, open interest, break-even, and its underlying's price.

    chains: symbol, ticker (of the underlying), type, strike, dte, day, close, volume, iv, delta, gamma, vega, open_interest;
    order: columns by which the last row of a contract is told. underlyings: ticker, price. previous_close: of
    the contract's last row on a day before the newest one.
    """
    at = F.struct(*order)
    of_day = chains.groupBy("symbol", "day").agg(F.max_by(F.struct("ticker", "type", "strike", "dte", "close", "iv", "delta", "gamma", "vega", "open_interest"), at).alias("l"), F.max("close").alias("high"), F.min("close").alias("low"), F.min_by("close", at).alias("open"), F.sum("volume").alias("volume"))
    w = Window.partitionBy("symbol").orderBy("day")
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("day")))
    now = of_day.withColumn("previous_close", F.lag("l.close").over(w)).withColumn("newest", newest).where("newest = 1").select("symbol", "day", "open", "high", "low", "volume", "previous_close", "l.*")
    price = underlyings.select(F.col("ticker").alias("u_ticker"), F.col("price").alias("underlying_price"))
    out = now.join(price, F.col("ticker") == F.col("u_ticker"), "left").drop("u_ticker")
    even = F.when(F.col("type") == "C", F.col("strike") + F.col("close")).otherwise(F.col("strike") - F.col("close"))
    return out.withColumn("break_even", even).withColumn("to_break_even", even - F.col("underlying_price")).withColumn("change", F.col("close") - F.col("previous_close"))


def summaries(wanted: DataFrame, stocks: DataFrame, options: DataFrame) -> DataFrame:
    """A row for each different ticker wanted: type, price, session, for contracts options, and error where it isn't known.

    stocks: rows of full_snapshot(); options: rows of option_snapshot(). session and options are structs; options is null
    for other types.
    """
    no = F.lit(None).cast("double")
    of_stock = stocks.select("ticker", F.lit("stocks").alias("type"), F.col("day_close").alias("price"), F.struct("change", F.col("change_pct").alias("change_percent"), F.col("early_change").alias("early_trading_change"), F.col("late_change").alias("late_trading_change"), F.col("day_close").alias("close"), F.col("day_high").alias("high"), F.col("day_low").alias("low"), F.col("day_open").alias("open"), F.col("prev_close").alias("previous_close"), F.col("day_volume").alias("volume")).alias("session"), F.lit(None).cast("struct<contract_type: string, strike_price: double, underlying_ticker: string>").alias("options"))
    percent = F.col("change") / F.nullif(F.col("previous_close"), F.lit(0.0)) * 100
    of_option = options.select(F.col("symbol").alias("ticker"), F.lit("options").alias("type"), F.col("close").alias("price"), F.struct("change", percent.alias("change_percent"), no.alias("early_trading_change"), no.alias("late_trading_change"), "close", "high", "low", "open", "previous_close", "volume").alias("session"), F.struct(F.col("type").alias("contract_type"), F.col("strike").alias("strike_price"), F.col("ticker").alias("underlying_ticker")).alias("options"))
    known = of_stock.union(of_option)
    out = wanted.select("ticker").where("ticker is not null").distinct().join(known, "ticker", "left")
    return out.withColumn("error", F.when(F.col("type").isNull(), "NOT_FOUND"))
