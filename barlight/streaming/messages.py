"""Typed rows of every market's messages, and what can't be typed beside them.

A message is a JSON array of events. An event's market and type decide its kind; a kind has its own
columns. One stream is written to a table a kind and a table of rejects, each batch to its own folder
by number, so that a batch that runs again leaves what it left before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlight.sources.shared import dropped

# Event types of each market, and column, JSON key and type of each kind's fields.
MARKETS = {
    "stocks": {"A": "equity_bar", "AM": "equity_bar", "T": "equity_trade", "Q": "equity_quote", "LULD": "price_limits", "FMV": "fair_value", "NOI": "imbalance", "LV": "launch_value"},
    "options": {"A": "equity_bar", "AM": "equity_bar", "T": "equity_trade", "Q": "equity_quote", "FMV": "fair_value", "LV": "launch_value"},
    "indices": {"A": "equity_bar", "AM": "equity_bar", "V": "index_value"},
    "futures": {"A": "futures_bar", "AM": "futures_bar", "T": "futures_trade", "Q": "futures_quote"},
    "crypto": {"XA": "currency_bar", "XAS": "currency_bar", "XT": "crypto_trade", "XQ": "crypto_quote", "XL2": "book", "FMV": "fair_value", "AM": "equity_bar", "LV": "launch_value"},
    "forex": {"CA": "currency_bar", "CAS": "currency_bar", "C": "forex_quote", "FMV": "fair_value", "AM": "equity_bar", "LV": "launch_value"},
}
MARKETS |= {f"futures_{x}": MARKETS["futures"] for x in ("cme", "cbot", "nymex", "comex")}
KINDS = {
    "equity_bar": "symbol sym string, volume v double, accumulated_volume av double, official_open_price op double, vwap vw double, open o double, close c double, high h double, low l double, aggregate_vwap a double, average_size z double, start_timestamp s long, end_timestamp e long, otc otc boolean, fractional_volume dv string, fractional_accumulated_volume dav string",
    "currency_bar": "pair pair string, open o double, close c double, high h double, low l double, volume v double, vwap vw double, start_timestamp s long, end_timestamp e long, avg_trade_size z double",
    "equity_trade": "symbol sym string, exchange x int, id i string, tape z int, price p double, size s long, fractional_shares ds string, conditions c array<int>, timestamp t long, sequence_number q long, trf_id trfi int, trf_timestamp trft long",
    "crypto_trade": "pair pair string, exchange x int, id i string, price p double, size s double, conditions c array<int>, timestamp t long, received_timestamp r long",
    "equity_quote": "symbol sym string, bid_exchange_id bx int, bid_price bp double, bid_size bs long, ask_exchange_id ax int, ask_price ap double, ask_size as long, condition c int, indicators i array<int>, timestamp t long, tape z int, sequence_number q long, trf_id trfi int, trf_timestamp trft long",
    "forex_quote": "pair p string, exchange_id x int, ask_price a double, bid_price b double, timestamp t long",
    "crypto_quote": "pair pair string, bid_price bp double, bid_size bs double, ask_price ap double, ask_size as double, timestamp t long, exchange_id x int, received_timestamp r long",
    "imbalance": "symbol T string, time_stamp t long, auction_time at int, auction_type a string, symbol_sequence i long, exchange_id x int, imbalance_quantity o long, paired_quantity p long, book_clearing_price b double",
    "price_limits": "symbol T string, high_price h double, low_price l double, indicators i array<int>, tape z int, timestamp t long, sequence_number q long",
    "book": "pair pair string, bid_prices b array<array<double>>, ask_prices a array<array<double>>, timestamp t long, exchange_id x int, received_timestamp r long",
    "index_value": "value val double, ticker T string, timestamp t long",
    "launch_value": "value val double, symbol sym string, timestamp t long",
    "fair_value": "fmv fmv double, ticker sym string, timestamp t long",
    "futures_trade": "symbol sym string, price p double, size s long, timestamp t long, sequence_number q long",
    "futures_quote": "symbol sym string, bid_price bp double, bid_size bs long, bid_timestamp bt long, ask_price ap double, ask_size as long, ask_timestamp at long, sip_timestamp t long",
    "futures_bar": "symbol sym string, volume v long, total_value dv long, open o double, close c double, high h double, low l double, transactions n long, start_timestamp s long, end_timestamp e long",
}


def fields(kind: str) -> list[tuple[str, str, str]]:
    """(column, JSON key, type) of a kind."""
    return [tuple(f.split(" ")) for f in KINDS[kind].split(", ")]


def _type(event: Column) -> Column:
    """The event type; where it comes first and has no escapes, as servers send it, the text needn't be parsed for it."""
    first = F.substring_index(F.substr(event, F.lit(len('{"ev":"') + 1)), '"', 1)
    return F.when(event.startswith('{"ev":"') & ~first.contains("\\"), first).otherwise(F.get_json_object(event, "$.ev"))


def read_messages(messages: DataFrame, market: str, column: str = "value") -> DataFrame:
    """A row an event of a market's messages: the other columns, ev, event (its JSON text), kind and reason.

    Status events go. reason is null for events of a known kind, else `broken` (the message is null or isn't
    JSON; event is the message), `untyped` (an element without an event type) or `unknown` (a type that
    the market doesn't have). A single event without an array is read as one. Empty arrays give no row.
    """
    text = F.col(column)
    array = F.from_json(F.when(text.rlike(r"^\s*\{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text), "array<string>")
    own = [c for c in messages.columns if c != column]
    element = lambda broken, ev, event: F.struct(F.lit(broken).alias("broken"), ev.alias("ev"), event.alias("event"))
    # All that reads JSON stands inside one generator: what is filtered or chosen afterwards doesn't make the planner read it again.
    elements = F.transform(array, lambda e: element(False, _type(e), e))
    rows = messages.select(*own, F.explode_outer(F.coalesce(elements, F.array(element(True, F.lit(None).cast("string"), text)))).alias("e"))
    rows = rows.where("e is not null").select(*own, "e.*").where("ev is null or ev <> 'status'")
    kinds = F.create_map(*(F.lit(x) for kv in MARKETS[market].items() for x in kv))
    kind = F.when(~F.col("broken") & F.col("ev").isNotNull(), F.try_element_at(kinds, F.col("ev")))
    reason = F.when(F.col("broken"), "broken").when(F.col("ev").isNull(), "untyped").when(F.col("kind").isNull(), "unknown")
    return rows.select(*own, "ev", "event", "broken").withColumn("kind", kind).withColumn("reason", reason).drop("broken")


def typed(events: DataFrame, kind: str) -> DataFrame:
    """The events of one kind with its columns, after those that the messages had; fields that don't fit are null."""
    names = fields(kind)
    schema = "struct<" + ", ".join(f"`{k}`: {t}" for _, k, t in names) + ">"
    own = [c for c in events.columns if c not in ("event", "kind", "reason")]
    rows = events.where(F.col("kind") == kind).withColumn("parsed", F.from_json("event", schema))
    # By place, as keys may differ in case alone.
    return rows.select(*own, "parsed.*").toDF(*own, *(c for c, _, _ in names))


def write_rejects(events: DataFrame, number: int, path: str) -> None:
    """The rejects of one batch of read_messages() to path/rejects (reason, ev, event) and path/counts (reason, ev, n), each below batch=<number>."""
    rejects = events.where("reason is not null").drop("kind")
    rejects.write.mode("overwrite").parquet(f"{path}/rejects/batch={number}")
    rejects = events.sparkSession.read.schema(rejects.schema).parquet(f"{path}/rejects/batch={number}")
    rejects.groupBy("reason", "ev").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")


def write_batch(events: DataFrame, number: int, path: str) -> None:
    """One batch of read_messages() to path/<kind>, path/rejects (reason, ev, event) and path/counts (reason, ev, n), each below batch=<number>.

    A folder is overwritten as a whole, so the batch may run again. Messages are taken apart once: the tables are made
    of their events as written, which are removed afterwards.
    """
    spark, whole = events.sparkSession, f"{path}/events/batch={number}"
    events.write.mode("overwrite").parquet(whole)
    events = spark.read.schema(events.schema).parquet(whole)
    for (kind,) in events.where("kind is not null").select("kind").distinct().collect():  # of KINDS, so a few
        typed(events, kind).write.mode("overwrite").parquet(f"{path}/{kind}/batch={number}")
    write_rejects(events, number, path)
    dropped(spark, whole)


def route(messages: DataFrame, market: str, path: str, column: str = "value", rejects_only: bool = False) -> StreamingQuery:
    """Starts the stream that writes a market's messages by kind below path, or rejects and their counts alone; its checkpoint lies there as well."""
    events, write = read_messages(messages, market, column), write_rejects if rejects_only else write_batch
    return events.writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(lambda df, n: write(df, n, path)).trigger(availableNow=True).start()


def levels(books: DataFrame) -> DataFrame:
    """A row a level of typed book rows: pair, exchange_id, side, price, size, timestamp, received_timestamp, and its other columns but these."""
    side = lambda c, name: F.transform(F.coalesce(c, F.array().cast("array<array<double>>")), lambda l: F.struct(F.lit(name).alias("side"), F.get(l, F.lit(0)).alias("price"), F.get(l, F.lit(1)).alias("size")))
    both = F.concat(side("bid_prices", "bid"), side("ask_prices", "ask"))
    return books.select(*(c for c in books.columns if c not in ("bid_prices", "ask_prices")), F.inline(both)).where("price is not null and size is not null")
