"""Queries on scans and sinks: a given table is written in a stored layout, and read back from there."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.functions import scalars as S
from barlight.operators import joins as J
from barlight.operators import market as M
from barlight.operators import signals as G
from barlight.operators import windows as W
from barlight.plans import fixtures as X
from barlight.plans.book import Book
from barlight.plans.stream_queries import messages
from barlight.sources import tables as T
from barlight.sources.shared import new_path
from barlight.streaming import events as E

BOOK = Book()
add = BOOK.add


def _bars_table(spark, sf):
    """Daily bars as a table by agg and year."""
    path = new_path(spark)
    bars = X.day_bars(spark, sf).withColumn("ts", F.col("day").cast("timestamp_ntz"))
    T.write_parquet(bars.select("ticker", "ts", "open", "high", "low", "close", "volume", "vwap", "transactions", F.lit("1D").alias("agg"), F.year("ts").alias("year")), path, "agg", "year")
    return path


BARS_SQL = "SELECT ticker, CAST(day AS TIMESTAMP) AS ts, open, high, low, close, volume, vwap, transactions FROM day_bars WHERE year(day) = 1996"


@add(BARS_SQL, "day_bars", doubles="open high low close volume vwap", dates="ts")
def scan_bars(spark, sf):
    return T.scan_bars(spark, _bars_table(spark, sf), "1D", 1996).drop("otc")


@add("SELECT year(day) AS year, count(*) AS n, sum(volume) AS volume FROM day_bars GROUP BY 1", "day_bars", doubles="volume")
def write_parquet(spark, sf):
    return spark.read.parquet(_bars_table(spark, sf)).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@add("SELECT ticker, count(*) AS n FROM (SELECT * FROM day_bars UNION ALL SELECT * FROM day_bars WHERE year(day) = 1997) GROUP BY 1", "day_bars")
def append_table(spark, sf):
    path = _bars_table(spark, sf)
    more = spark.read.parquet(path).where("year = 1997")
    again = new_path(spark)
    T.write_parquet(spark.read.parquet(path), again, "agg", "year")
    T.append_table(more, again, "agg", "year")
    return T.scan_parquet(spark, again).groupBy("ticker").agg(F.count("*").alias("n"))


@add("SELECT ticker, CAST(day AS TIMESTAMP) AS ts, close, CAST(NULL AS BOOLEAN) AS otc FROM day_bars", "day_bars", doubles="close", dates="ts")
def scan_parquet(spark, sf):
    return T.scan_parquet(spark, _bars_table(spark, sf), "ticker string, ts timestamp_ntz, close double, otc boolean")


def _csv(spark, rows, zipped: bool = False):
    path = new_path(spark)
    if zipped:
        rows.write.option("header", True).option("compression", "gzip").csv(path)
    else:
        T.write_csv(rows, path)
    return path


@add("SELECT ticker, close, volume FROM day_bars", "day_bars", doubles="close volume")
def write_csv(spark, sf):
    return T.scan_csv(spark, _csv(spark, X.day_bars(spark, sf).select("ticker", "close", "volume")), "ticker string, close double, volume double")


@add("SELECT ticker, max(close) AS close, count(*) AS n FROM day_bars GROUP BY 1", "day_bars", doubles="close")
def scan_gz_csv(spark, sf):
    rows = T.scan_gz_csv(spark, _csv(spark, X.day_bars(spark, sf).select("ticker", "close"), True), "ticker string, close double")
    return rows.groupBy("ticker").agg(F.max("close").alias("close"), F.count("*").alias("n"))


def _by_hour(rows, *aggs):
    return rows.groupBy("ticker", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(*aggs).withColumn("agg", F.lit("1h")).withColumn("year", F.year("ts"))


@add("SELECT ticker, date_trunc('hour', ts) AS ts, count(*) AS trade_count, sum(size) AS volume, max(size) AS max_size FROM ticks GROUP BY 1, 2", "ticks", doubles="volume max_size", dates="ts")
def scan_trade_bars(spark, sf):
    path = new_path(spark)
    T.write_parquet(_by_hour(X.ticks(spark, sf), F.count("*").alias("trade_count"), F.sum("size").alias("volume"), F.max("size").alias("max_size")), path, "agg", "year")
    out = T.scan_trade_bars(spark, path, "1h")
    return out.select("ticker", "ts", "trade_count", "volume", "max_size")


@add("SELECT ticker, date_trunc('hour', ts) AS ts, count(*) AS quote_count, avg(bid_price) AS avg_bid, avg(ask_price) AS avg_ask, avg(ask_price - bid_price) AS avg_spread FROM quotes GROUP BY 1, 2", "quotes", doubles="avg_bid avg_ask avg_spread", dates="ts")
def scan_quote_bars(spark, sf):
    path = new_path(spark)
    T.write_parquet(_by_hour(X.quotes(spark, sf), F.count("*").alias("quote_count"), F.avg("bid_price").alias("avg_bid"), F.avg("ask_price").alias("avg_ask"), F.avg(F.col("ask_price") - F.col("bid_price")).alias("avg_spread")), path, "agg", "year")
    out = T.scan_quote_bars(spark, path, "1h")
    return out.select("ticker", "ts", "quote_count", "avg_bid", "avg_ask", "avg_spread")


def _chain_table(spark, sf, half: bool):
    """Chains by agg: all at 1min, and with half those of calls' tickers also at 1D."""
    path = new_path(spark)
    c = X.chains(spark, sf).select("ticker", "symbol", F.col("day").cast("timestamp_ntz").alias("ts"), "close", "volume")
    rows = c.withColumn("agg", F.lit("1min"))
    if half:
        rows = rows.unionByName(c.where("ticker < 'Brand#3'").withColumn("close", F.col("close") * 2).withColumn("agg", F.lit("1D")))
    T.write_parquet(rows, path, "agg")
    return path


@add("SELECT ticker, CASE WHEN ticker < 'Brand#3' THEN '1D' ELSE '1min' END AS agg, count(*) AS n, sum(CASE WHEN ticker < 'Brand#3' THEN close * 2 ELSE close END) AS close FROM chains GROUP BY 1, 2", "chains", doubles="close")
def scan_chains(spark, sf):
    return T.scan_chains(spark, _chain_table(spark, sf, True), "1D").groupBy("ticker", "agg").agg(F.count("*").alias("n"), F.sum("close").alias("close"))


@add("SELECT ticker, symbol, count(*) AS n, sum(volume) AS volume FROM chains GROUP BY 1, 2", "chains", doubles="volume")
def scan_option_features(spark, sf):
    return T.scan_option_features(spark, _chain_table(spark, sf, False), "1min").groupBy("ticker", "symbol").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@add("SELECT p_partkey % 9 AS root, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS type, count(*) AS n, sum(l_quantity) AS volume, min(CAST(epoch_us(CAST(l_shipdate AS TIMESTAMP)) AS BIGINT) // 60000000) AS first_minute FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_partkey % 5 <> 0 GROUP BY 1, 2", doubles="volume")
def scan_option_flatfile(spark, sf):
    letter = F.element_at(F.array(*map(F.lit, "ABCDEFGHI")), (F.col("p_partkey") % 9 + 1).cast("int"))
    symbol = S.occ_symbol(letter, F.make_date(2000 + F.col("p_size") % 30, F.lit(6), F.lit(15)), F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("P"), F.col("p_retailprice"))
    rows = X.read(spark, sf, "lineitem").join(X.read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("ticker", F.when(F.col("p_partkey") % 5 == 0, "not a symbol").otherwise(symbol))
    at = F.expr("unix_micros(cast(to_date(l_shipdate) as timestamp)) * 1000")
    path = _csv(spark, rows.select("ticker", F.col("l_quantity").cast("long").alias("volume"), *(F.col("l_extendedprice").alias(c) for c in ("open", "close", "high", "low")), at.alias("window_start"), F.lit(1).alias("transactions")), True)
    out = T.scan_option_flatfile(spark, path).withColumn("root", (F.ascii("root") - 65).cast("long"))
    return out.groupBy("root", "type").agg(F.count("*").alias("n"), F.sum("volume").cast("double").alias("volume"), F.min("minute").alias("first_minute"))


@add("SELECT ticker, sip_ns // 60000000000 AS minute, count(*) AS n, max(ask_price - bid_price) AS widest FROM quotes WHERE bid_price > 0 AND ask_price > 0 GROUP BY 1, 2", "quotes", doubles="widest")
def scan_option_quote_flatfile(spark, sf):
    q = X.quotes(spark, sf)
    path = _csv(spark, q.select("ticker", F.lit(1).alias("ask_exchange"), "ask_price", "ask_size", F.lit(2).alias("bid_exchange"), "bid_price", "bid_size", F.lit(0).alias("sequence_number"), F.col("sip_ns").alias("sip_timestamp")), True)
    return T.scan_option_quote_flatfile(spark, path).groupBy("ticker", "minute").agg(F.count("*").alias("n"), F.max(F.col("ask_price") - F.col("bid_price")).alias("widest"))


@add("SELECT ticker, day, close, transactions FROM day_bars", "day_bars", doubles="close", dates="day")
def scan_stock_day_flatfile(spark, sf):
    b = X.day_bars(spark, sf)
    path = _csv(spark, b.select("ticker", "volume", "open", "close", "high", "low", F.expr("unix_micros(cast(day as timestamp)) * 1000").alias("window_start"), "transactions"), True)
    return T.scan_stock_day_flatfile(spark, path).select("ticker", "day", "close", "transactions")


@add("SELECT ticker, exchange, count(*) AS n, sum(size) AS size FROM ticks GROUP BY 1, 2", "ticks", doubles="size")
def scan_trade_flatfile(spark, sf):
    t = X.ticks(spark, sf)
    none = lambda c: F.lit(None).cast("string").alias(c)
    path = _csv(spark, t.select("ticker", none("conditions"), none("correction"), "exchange", none("id"), F.col("sip_ns").alias("participant_timestamp"), "price", F.col("sequence").alias("sequence_number"), F.col("sip_ns").alias("sip_timestamp"), "size", none("tape"), none("trf_id"), none("trf_timestamp")), True)
    return T.scan_trade_flatfile(spark, path).groupBy("ticker", F.col("exchange").cast("long").alias("exchange")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@add("SELECT ticker, open, close, volume, transactions FROM day_bars", "day_bars", doubles="open close volume")
def ingest_json_payloads(spark, sf):
    b = X.day_bars(spark, sf)
    row = F.struct(F.col("ticker").alias("T"), F.col("open").alias("o"), F.col("close").alias("c"), F.col("volume").alias("v"), F.col("transactions").alias("n"))
    path = new_path(spark)
    b.groupBy("ticker", F.year("day")).agg(F.to_json(F.struct(F.lit("OK").alias("status"), F.collect_list(row).alias("results"))).alias("value")).select("value").write.text(path)
    return T.ingest_json_payloads(spark, path, "aggs", "ticker string, open double, close double, volume double, transactions long", page_a_file=False)


@add("SELECT symbol, strike, type, close, volume, underlying, delta, iv AS implied_volatility, open_interest, CAST(NULL AS DOUBLE) AS bid FROM chains", "chains", doubles="strike close volume underlying delta implied_volatility open_interest")
def flatten_chain_snapshot(spark, sf):
    c = X.chains(spark, sf)
    nested = c.select(F.struct(F.col("symbol").alias("ticker"), F.col("strike").alias("strike_price"), F.col("type").alias("contract_type")).alias("details"), F.struct("close", "volume").alias("day"), F.struct("delta", "gamma").alias("greeks"), F.struct("ticker", F.col("underlying").alias("price")).alias("underlying_asset"), F.col("iv").alias("implied_volatility"), "open_interest")
    return T.flatten_chain_snapshot(nested).select("symbol", "strike", "type", "close", "volume", "underlying", "delta", "implied_volatility", "open_interest", "bid")


@add("SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS end_date, o_totalprice AS revenue, CAST(NULL AS DOUBLE) AS assets FROM orders WHERE o_orderkey % 4 <> 0", doubles="revenue", dates="end_date")
def financials_flatten(spark, sf):
    o = X.read(spark, sf, "orders")
    item = F.create_map(F.lit("revenues"), F.struct(F.col("o_totalprice").alias("value")))
    filings = o.select(F.col("o_custkey").cast("string").alias("ticker"), F.when(F.col("o_orderkey") % 4 != 0, F.to_date("o_orderdate")).alias("end_date"), item.alias("income_statement"))
    return T.financials_flatten(filings, {"revenue": "income_statement.revenues", "assets": "income_statement.assets"})


@add("SELECT count(*) AS n, count(DISTINCT ticker) AS tickers FROM day_bars", "day_bars")
def verify_publish(spark, sf):
    """A staged table is read for publishing only if its columns, rows and times are as they should be."""
    path = new_path(spark)
    bars = X.day_bars(spark, sf).withColumn("ts", F.col("day").cast("timestamp_ntz")).drop("day").withColumn("agg", F.lit("1D")).withColumn("year", F.year("ts"))
    rows = T.write_counted(bars, path, "agg", "year")
    staged = spark.read.parquet(path)
    T.verify_publish(staged, staged.schema, rows)
    return staged.agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"))


@add("""WITH s AS (SELECT ticker, sum(close * volume) AS dollar_volume FROM day_bars GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY dollar_volume DESC, ticker) AS n FROM s)
  SELECT name, ticker, CAST(n - a + 1 AS INTEGER) AS "rank" FROM r, (VALUES ('top3', 1, 3), ('next4', 4, 7)) AS l(name, a, b) WHERE n BETWEEN a AND b""", "day_bars")
def write_universe(spark, sf):
    lists = G.build_universes(M.universe_stats(X.day_bars(spark, sf), X.fundamentals(spark, sf)), {"top3": (1, 3), "next4": (4, 7)})
    return T.scan_csv(spark, _csv(spark, lists.select("name", "ticker", "rank")), "name string, ticker string, rank int")


@add("WITH l AS (SELECT ticker, avg(transactions) AS mean, stddev_samp(transactions) AS sd FROM day_bars GROUP BY 1) SELECT b.ticker, b.day, (transactions - mean) / nullif(sd, 0) AS z FROM day_bars b JOIN l ON b.ticker = l.ticker", "day_bars", doubles="z", dates="day")
def lookup_table_build(spark, sf):
    """Means by ticker as a stored table, looked up again for every bar."""
    path, b = new_path(spark), X.day_bars(spark, sf)
    T.write_parquet(b.groupBy("ticker").agg(F.avg("transactions").alias("mean"), F.stddev_samp("transactions").alias("sd")), path)
    found = J.enrich_reference_join(b.select("ticker", "day", "transactions"), T.scan_parquet(spark, path), b.select("ticker").distinct())
    return found.select("ticker", "day", ((F.col("transactions") - F.col("mean")) / F.nullif(F.col("sd"), F.lit(0.0))).alias("z"))


@add("SELECT ticker, exchange, max(sip_ns) AS sip_ns, arg_max(price, sip_ns) AS price FROM ticks GROUP BY 1, 2", "ticks", doubles="price")
def last_crypto_trade(spark, sf):
    return M.latest(X.ticks(spark, sf), ["ticker", "exchange"], "sip_ns", ["price"])


@add("SELECT ticker || '/' || CAST(bid_size AS INTEGER) AS pair, max(sip_ns) AS sip_ns, arg_max((bid_price + ask_price) / 2, sip_ns) AS mid FROM quotes GROUP BY 1", "quotes", doubles="mid")
def last_forex_quote(spark, sf):
    q = X.quotes(spark, sf).withColumn("pair", F.concat_ws("/", "ticker", F.col("bid_size").cast("int"))).withColumn("mid", (F.col("bid_price") + F.col("ask_price")) / 2)
    return M.latest(q, ["pair"], "sip_ns", ["mid"])


@add("SELECT DISTINCT regexp_replace(p_brand, '[^A-Za-z0-9.]', '', 'g') AS brand, p_size % 2 AS odd FROM part")
def ticker_list_distinct(spark, sf):
    p = X.read(spark, sf, "part")
    lists = [p.where(F.col("p_size") % 2 == k).select(F.concat_ws("", F.regexp_replace("p_brand", "[^A-Za-z0-9.]", ""), F.lit(f"-{k}")).alias("ticker")) for k in (0, 1)]
    return J.ticker_list_distinct(lists).select(F.split("ticker", "-")[0].alias("brand"), F.split("ticker", "-")[1].cast(p.schema["p_size"].dataType).alias("odd"))


@add("SELECT e.ev, CAST(count(*) AS BIGINT) AS n, max(e.kind) AS kind FROM events, (VALUES ('T', 'trade'), ('Q', 'quote')) AS e(ev, kind) GROUP BY 1")
def parse_events(spark, sf):
    return E.run_available(E.parse_events(messages(spark, sf)).select("ev", "kind"), "append").groupBy("ev").agg(F.count("*").alias("n"), F.max("kind").alias("kind"))
