"""Market-data queries: listings, snapshots, calendars and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlight.functions.predicates import compare_filter, date_range_filter
from barlight.functions.scalars import minute_of_day, new_york, safe_divide, sic_group
from barlight.operators.bars import bars_from_ticks
from barlight.operators.joins import complete_grid
from barlight.operators.scans import correlation_blocks

# Nanoseconds of spans whose buckets are counted from the epoch.
SPANS = {"second": 10**9, "minute": 60 * 10**9, "hour": 3600 * 10**9, "day": 86400 * 10**9, "week": 604800 * 10**9}


def trade_notional(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker").agg(F.sum(F.col("price") * F.col("size")).alias("notional"))


def share_of(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key and their percentage; the total is one row."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(key, "n", (F.col("n") * 100.0 / F.col("total")).alias("share"))


def _slot() -> Column:
    """Half hour of the New York day."""
    return F.floor(minute_of_day(new_york(F.col("ts"))) / 30).cast("int")


def trades_per_half_hour(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy(_slot().alias("slot")).agg(F.count("*").alias("n"))


def exchange_heatmap(ticks: DataFrame) -> DataFrame:
    counts = ticks.groupBy("exchange", _slot().alias("slot")).agg(F.count("*").alias("n"))
    return complete_grid(counts).withColumn("heat", F.log1p("n"))


#: Tickers of a block of the correlation matrix, about.
BLOCK_TICKERS = 256


def correlation_matrix(bars: DataFrame) -> DataFrame:
    """(a, b, corr) of returns over the times at which every ticker has one."""
    before = F.lag("close").over(Window.partitionBy("ticker").orderBy("ts"))
    r = bars.select("ticker", "ts", (F.col("close") / before - 1).alias("r"))
    tickers = bars.agg(F.countDistinct("ticker").alias("tickers"))
    whole = r.groupBy("ts").agg(F.count("r").alias("n")).crossJoin(F.broadcast(tickers)).where("n = tickers").select("ts")
    r = r.join(whole, "ts", "left_semi")
    # Blocks of some hundred tickers: their products are what a task holds.
    names = bars.agg(F.approx_count_distinct("ticker").alias("n")).first()["n"]
    return correlation_blocks(r, blocks=1 + names // BLOCK_TICKERS)


def prev_day_change(days: DataFrame) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("day")))
    return days.withColumn("n", n).where("n = 2").select("ticker", "day", "open", "close", ((F.col("close") - F.col("open")) / F.col("open") * 100).alias("change_pct"))


def aggs(ticks: DataFrame, ticker: str, mult: int, span: str, start: str, end: str) -> DataFrame:
    """Bars of any size of one ticker from whole UTC days; months, quarters and years follow the calendar."""
    rows = ticks.where((F.col("ticker") == ticker) & date_range_filter(F.col("ts"), start, end))
    key = F.expr(f"sip_ns div {mult * SPANS[span]}") if span in SPANS else F.date_trunc(span, "ts")
    return bars_from_ticks(rows, key)


def grouped_daily(days: DataFrame, day: str) -> DataFrame:
    return days.where(F.col("day") == F.lit(day).cast("date"))


def previous_close(days: DataFrame) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("day")))
    return days.withColumn("n", n).where("n = 1").drop("n")


def daily_open_close(ticks: DataFrame) -> DataFrame:
    """Regular OHLC of each New York day, the first price before and the last after it."""
    at, clock = F.struct("sip_ns", "sequence"), new_york(F.col("ts"))
    m = minute_of_day(clock)
    inside = lambda a, b: (m >= a) & (m < b)
    when = lambda a, b, x: F.when(inside(a, b), x)
    p = F.col("price")
    return ticks.groupBy("ticker", F.to_date(clock).alias("day")).agg(
        F.min_by("price", when(570, 960, at)).alias("open"), F.max(when(570, 960, p)).alias("high"), F.min(when(570, 960, p)).alias("low"), F.max_by("price", when(570, 960, at)).alias("close"),
        F.min_by("price", when(240, 570, at)).alias("pre_market"), F.max_by("price", when(960, 1200, at)).alias("after_hours"),
    )


def listing(rows: DataFrame, limit: int, sort: str, ascending: bool = True, **tests) -> DataFrame:
    """Rows that pass comparison tests, sorted and limited: one operator for every listed dataset."""
    return rows.where(compare_filter(**tests)).orderBy(F.col(sort).asc() if ascending else F.col(sort).desc()).limit(limit)


def latest(rows: DataFrame, keys: list[str], ts: str, columns: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max(ts).alias(ts), *(F.max_by(c, ts).alias(c) for c in columns))


def currency_convert(amounts: DataFrame, quotes: DataFrame, column: str, places: int = 2) -> DataFrame:
    rate = latest(quotes.withColumn("rate", (F.col("bid_price") + F.col("ask_price")) / 2), ["ticker"], "sip_ns", ["rate"]).select("ticker", "rate")
    return amounts.join(rate, "ticker").withColumn("converted", F.round(F.col(column) * F.col("rate"), places)).drop("rate", column)


def snapshot(ticks: DataFrame) -> DataFrame:
    """Latest day's bar of each ticker against the close of the day before."""
    days = bars_from_ticks(ticks, F.to_date("ts"), "day")
    w = Window.partitionBy("ticker").orderBy("day")
    before = F.lag("close").over(w)
    n = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("day")))
    out = days.withColumn("prev_close", before).withColumn("n", n).where("n = 1")
    change = F.col("close") - F.col("prev_close")
    return out.select("ticker", "day", F.col("open").alias("day_open"), F.col("close").alias("day_close"), F.col("volume").alias("day_volume"), "prev_close", change.alias("change"), (change / F.col("prev_close") * 100).alias("change_pct"))


def gainers_losers(days: DataFrame, direction: str = "gainers", n: int = 20) -> DataFrame:
    w = Window.partitionBy("ticker").orderBy("day")
    last = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("day")))
    rows = days.withColumn("prev_close", F.lag("close").over(w)).withColumn("n", last).where("n = 1")
    rows = rows.select("ticker", "close", "prev_close", ((F.col("close") - F.col("prev_close")) / F.col("prev_close") * 100).alias("change_pct"))
    return rows.orderBy(F.desc("change_pct") if direction == "gainers" else F.asc("change_pct"), "ticker").limit(n)


def order_book_levels(books: DataFrame) -> DataFrame:
    """ticker, side, price, exchange, size: one row a level and exchange of nested books (ticker, bids, asks of price and exchange sizes)."""
    side = lambda c: books.select("ticker", F.lit(c).alias("side"), F.explode(c).alias("l")).select("ticker", "side", F.col("l.price").alias("price"), F.explode_outer("l.x").alias("exchange", "size"))
    return side("bids").union(side("asks"))


def order_book_l2(levels: DataFrame) -> DataFrame:
    """Best bid and ask, spread and numbers of bid and ask levels of each ticker, from rows of levels: one partial aggregation."""
    of = lambda side, c="price": F.when(F.col("side") == side, F.col(c))
    out = levels.groupBy("ticker").agg(F.max(of("bids")).alias("best_bid"), F.min(of("asks")).alias("best_ask"), F.count(of("bids")).alias("bid_levels"), F.count(of("asks")).alias("ask_levels"))
    return out.select("ticker", "best_bid", "best_ask", (F.col("best_ask") - F.col("best_bid")).alias("spread"), "bid_levels", "ask_levels")


def calendar(days: DataFrame) -> DataFrame:
    """Mondays to Fridays from the first to the last day of a table's column day."""
    ends = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("day")).where("weekday(day) < 5")


def sic_group_weights(rows: DataFrame) -> DataFrame:
    """Share of each ticker's market cap in its SIC group, of those with a cap."""
    out = rows.where("market_cap > 0").withColumn("sic_group", sic_group(F.col("sic")))
    return out.withColumn("weight", F.col("market_cap") / F.sum("market_cap").over(Window.partitionBy("sic_group")))


def sector_change(snapshots: DataFrame, groups: DataFrame) -> DataFrame:
    """Each group's tickers with weight and mean change, 0 where there is no snapshot."""
    joined = groups.join(snapshots, "ticker", "left").groupBy("sic_group", "ticker").agg(F.avg(F.coalesce(F.round("change_pct", 2), F.lit(0.0))).alias("change_pct"), F.max("weight").alias("weight"))
    return joined.groupBy("sic_group").agg(F.sort_array(F.collect_list(F.struct("ticker", "weight", "change_pct"))).alias("tickers"))


def related_graph(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with dense ids in order of names, and edges as pairs of ids."""
    names = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    nodes = names.withColumn("id", (F.row_number().over(Window.orderBy("name")) - 1).cast("long"))
    a, b = nodes.toDF("a", "from"), nodes.toDF("b", "to")
    return nodes, pairs.join(a, "a").join(b, "b").select("from", "to")


def universe_stats(days: DataFrame, fundamentals: DataFrame) -> DataFrame:
    stats = days.groupBy("ticker").agg(F.sum(F.col("close") * F.col("volume")).alias("dollar_volume"), F.avg("close").alias("mean_close"))
    return stats.join(fundamentals.select("ticker", "market_cap"), "ticker", "left")


def stale_tickers(days: DataFrame, n: int, whole: DataFrame | None = None) -> DataFrame:
    newest = (whole if whole is not None else days).agg(F.max("day").alias("newest"))
    last = days.groupBy("ticker").agg(F.max("day").alias("last_day"))
    return last.crossJoin(F.broadcast(newest)).where(F.col("last_day") < F.date_sub("newest", n)).drop("newest")


def data_availability(tables: dict[str, DataFrame]) -> DataFrame:
    """has_<table> for every ticker of any table: one union and one aggregation."""
    rows = None
    for n, t in tables.items():
        one = t.select("ticker", F.lit(n).alias("t")).distinct()
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("ticker").agg(*(F.max(F.col("t") == n).alias(f"has_{n}") for n in tables))


def fundamentals_build(ratios: DataFrame, details: DataFrame) -> DataFrame:
    """Market cap of ratios or else details, shares weighted or else by class, book value = price / price to book."""
    j = ratios.join(details, "ticker", "left")
    return j.select("ticker", F.coalesce("ratio_market_cap", "detail_market_cap").alias("market_cap"), F.coalesce("weighted_shares", "class_shares").alias("shares_outstanding"), safe_divide(F.col("price"), F.col("price_to_book")).alias("book_value"))
