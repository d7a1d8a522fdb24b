"""Market event streams: JSON messages to typed rows, and running statistics.

Event time rules. Rows later than the watermark are dropped by Spark, which counts them in the query's
progress.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlight.sources.shared import new_path

WATERMARK = "10 seconds"

#: Items a level of the quantile sketch, and the largest error in rank that they give.
SKETCH, SKETCH_ERROR = 800, 0.005

# Single-letter keys of the messages of all markets, and what they stand for.
MESSAGE = "ev string, sym string, pair string, i string, x int, p double, s double, c array<int>, t long, q long, z int, o double, h double, l double, v double, a double, vw double, bp double, ap double, bs double, `as` double, bx int, ax int, e long, n long, op double, av double"
KINDS = {"T": "trade", "Q": "quote", "A": "second_bar", "AM": "minute_bar", "XT": "crypto_trade", "XQ": "crypto_quote", "XA": "crypto_minute_bar", "C": "forex_quote", "CA": "forex_minute_bar", "V": "index_value", "LULD": "limit_up_down", "NOI": "imbalance", "FMV": "fair_value", "LV": "launch_value", "FT": "futures_trade", "FQ": "futures_quote"}


def parse_events(messages: DataFrame, column: str = "value") -> DataFrame:
    """One row an event of messages that are JSON arrays; kind is null for event types that are not known.

    Status messages go. A message that isn't JSON gives no row.
    """
    kinds = F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv))
    parsed = messages.withColumn("event", F.explode(F.from_json(column, f"array<struct<{', '.join(p.replace(' ', ':', 1) for p in MESSAGE.split(', '))}>>")))
    out = parsed.select(*(c for c in messages.columns if c != column), "event.*").where("ev is not null and ev <> 'status'")
    symbol = F.coalesce("sym", "pair")
    return out.withColumn("kind", kinds[F.col("ev")]).withColumn("symbol", symbol).withColumn("ts", F.timestamp_millis("t"))


def trades_of(events: DataFrame) -> DataFrame:
    return events.where("kind = 'trade'").select("symbol", "ts", F.col("p").alias("price"), F.col("s").alias("size"), F.col("q").alias("sequence"))


def subscription_filter(events: DataFrame, topics: DataFrame) -> DataFrame:
    """Events of the subscribed (ev, symbol) topics; symbol * takes all of an event type. topics is a static table."""
    every = topics.where("symbol = '*'").select(F.col("ev").alias("e")).distinct()
    single = topics.where("symbol <> '*'").join(every, F.col("ev") == F.col("e"), "left_anti").select("ev", "symbol").distinct()
    wanted = single.select("ev", "symbol", F.lit(False).alias("any")).union(every.select("e", F.lit("*"), F.lit(True))).toDF("t_ev", "t_symbol", "any")
    return events.join(wanted, (F.col("ev") == F.col("t_ev")) & (F.col("any") | (F.col("symbol") == F.col("t_symbol"))), "left_semi")


def tumbling_trade_stats(trades: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Trades and cash of each symbol and window of event time."""
    w = trades.withWatermark("ts", WATERMARK).groupBy(F.window("ts", size).alias("w"), "symbol")
    return w.agg(F.count("*").alias("trades"), F.sum(F.col("price") * F.col("size")).alias("cash")).select(F.col("w.start").alias("start"), "symbol", "trades", "cash")


def window_totals(trades: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Symbols, trades and cash of each window, summed up from tumbling_trade_stats(); a row comes when the watermark has passed its window.

    A window over windows: the second aggregation takes a row a symbol and window.
    """
    w = trades.withWatermark("ts", WATERMARK).groupBy(F.window("ts", size).alias("w"), "symbol")
    each = w.agg(F.count("*").alias("trades"), F.sum(F.col("price") * F.col("size")).alias("cash"))
    all_ = each.groupBy(F.window(F.window_time("w"), size).alias("w"))
    return all_.agg(F.count("*").alias("symbols"), F.sum("trades").alias("trades"), F.sum("cash").alias("cash")).select(F.col("w.start").alias("start"), "symbols", "trades", "cash")


def top_symbols(stats: DataFrame, n: int = 25) -> DataFrame:
    """The n symbols with most trades of each window of tumbling_trade_stats() (ties: more cash, then symbol), with their rank.

    For finished windows, in a batch of a stream: each task keeps n rows of a window before they are dealt.
    """
    best = Window.partitionBy("start").orderBy(F.desc("trades"), F.desc_nulls_last("cash"), "symbol")
    return stats.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def running_totals(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(F.count("*").alias("trades"), F.sum(F.col("price") * F.col("size")).alias("cash"))


def event_counter(events: DataFrame) -> DataFrame:
    return events.groupBy("ev").agg(F.count("*").alias("n"))


def stream_latency(events: DataFrame, received: str = "received") -> DataFrame:
    """Mean, largest and a quantile sketch of the milliseconds from event to receipt, a minute and event type.

    The sketch has a fixed size: with SKETCH items a level, the rank of a quantile is off by less than
    SKETCH_ERROR (in 99 of 100 cases), and by nothing for SKETCH rows or fewer. See latency_quantiles().
    """
    ms = F.unix_millis(received) - F.col("t")
    w = events.withColumn("ms", ms).withWatermark("ts", WATERMARK).groupBy(F.window("ts", "1 minute").alias("w"), "ev")
    return w.agg(F.avg("ms").alias("mean_ms"), F.max("ms").alias("max_ms"), F.kll_sketch_agg_bigint("ms", F.lit(SKETCH)).alias("sketch")).select(F.col("w.start").alias("start"), "ev", "mean_ms", "max_ms", "sketch")


def latency_quantiles(rows: DataFrame, *by: str) -> DataFrame:
    """p50, p95, p99 and the number of measurements of each group of stream_latency()'s rows, from their merged sketches."""
    merged = rows.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("s"))
    at = lambda q: F.kll_sketch_get_quantile_bigint("s", F.lit(q)).alias(f"p{round(q * 100)}")
    return merged.select(*by, F.kll_sketch_get_n_bigint("s").alias("n"), *map(at, (0.5, 0.95, 0.99)))


def stream_enrich_contract(trades: DataFrame, contracts: DataFrame) -> DataFrame:
    """Option trades with the underlying of their symbol and their contract's details, a static table."""
    rows = trades.withColumn("underlying", F.regexp_extract("symbol", r"^O:([A-Z]+)\d", 1)).where("underlying <> ''")
    return rows.join(contracts, "symbol", "left")


def stream_quote_bars(quotes: DataFrame, size: str = "1 minute") -> DataFrame:
    spread = F.col("ap") - F.col("bp")
    w = quotes.withWatermark("ts", WATERMARK).groupBy(F.window("ts", size).alias("w"), "symbol")
    return w.agg(F.count("*").alias("quotes"), F.avg(spread).alias("avg_spread"), F.sum("bs").alias("bid_size"), F.sum("as").alias("ask_size")).select(F.col("w.start").alias("start"), "symbol", "quotes", "avg_spread", "bid_size", "ask_size")


def run_available(stream: DataFrame, mode: str = "complete", each: Callable[[DataFrame], DataFrame] = lambda df: df, number: str | None = None) -> DataFrame:
    """What a streaming query gives for all that is there now: the last state in complete mode, else all rows.

    Batches are written to the folder that the cluster shares, after `each` was applied to them; number: a column for the batch's number.
    """
    spark: SparkSession = stream.sparkSession
    path = new_path(spark)
    done: list[str] = []
    schemas: list[StructType] = []
    column = number

    def batch(df: DataFrame, number: int) -> None:
        df = each(df)
        schemas.append(df.schema)
        if column:
            df = df.withColumn(column, F.lit(number))
            schemas[-1] = df.schema
        df.write.mode("overwrite").parquet(f"{path}/rows/{number}")
        done.append(f"{path}/rows/{number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    parts = done[-1:] if mode == "complete" else done
    return spark.read.schema(schemas[-1]).parquet(*parts) if parts else spark.createDataFrame([], stream.schema)
