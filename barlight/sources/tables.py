"""Scans and sinks of market tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.scalars import naive_ts_to_utc, parse_occ_symbol, to_number

BARS = "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume double, vwap double, transactions long, otc boolean"
TRADE_BARS = "ticker string, ts timestamp_ntz, trade_count long, volume double, vwap double, avg_size double, median_size double, max_size double, size_stdev double, buy_volume double, sell_volume double, delta double, cumulative_delta double, delta_pct double, aggression_ratio double, trade_frequency double, large_trade_count long, large_trade_ratio double, avg_seconds_between_trades double"
QUOTE_BARS = "ticker string, ts timestamp_ntz, quote_count long, avg_bid double, avg_ask double, avg_spread double, avg_bid_size double, avg_ask_size double, bid_ask_imbalance double, quote_frequency double"
OPTION_FLATFILE = "ticker string, volume long, open double, close double, high double, low double, window_start long, transactions long"
QUOTE_FLATFILE = "ticker string, ask_exchange int, ask_price double, ask_size double, bid_exchange int, bid_price double, bid_size double, sequence_number long, sip_timestamp long"
TRADE_FLATFILE = "ticker string, conditions string, correction int, exchange int, id string, participant_timestamp long, price double, sequence_number long, sip_timestamp long, size double, tape int, trf_id long, trf_timestamp long"
STOCK_DAY_FLATFILE = "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions long"

# Short keys of payloads, by dataset.
SHORT_KEYS = {
    "aggs": {"T": "ticker", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "vw": "vwap", "t": "timestamp", "n": "transactions", "otc": "otc"},
    "trades": {"T": "ticker", "t": "sip_timestamp", "y": "participant_timestamp", "f": "trf_timestamp", "q": "sequence_number", "i": "id", "x": "exchange", "s": "size", "c": "conditions", "p": "price", "z": "tape"},
    "quotes": {"T": "ticker", "t": "sip_timestamp", "y": "participant_timestamp", "q": "sequence_number", "X": "ask_exchange", "P": "ask_price", "S": "ask_size", "x": "bid_exchange", "p": "bid_price", "s": "bid_size", "z": "tape"},
}


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The schema's columns; missing ones are null, others go."""
    fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def scan_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(df, schema) if schema else df


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Plain or .gz CSV with header. A .gz file can't be split: convert it to Parquet once."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)


scan_gz_csv = scan_csv


def _of_years(spark: SparkSession, root: str, agg: str, years: int | tuple[int, int] | None) -> DataFrame:
    """Rows of a size of one year, of years from the first to the last, or of all, from a table partitioned by agg and year: only these partitions are read."""
    df = spark.read.parquet(root).where(F.col("agg") == agg)
    if years is None:
        return df
    return df.where(F.col("year") == years if isinstance(years, int) else F.col("year").between(*years))


def scan_bars(spark: SparkSession, root: str, agg: str, years: int | tuple[int, int] | None = None, tickers: list[str] | None = None) -> DataFrame:
    """Bars of a size: of a year, a range of years or all."""
    df = _of_years(spark, root, agg, years)
    return conform(df if tickers is None else df.where(F.col("ticker").isin(tickers)), BARS)


def scan_trade_bars(spark: SparkSession, root: str, agg: str, years: int | tuple[int, int] | None = None) -> DataFrame:
    return conform(_of_years(spark, root, agg, years), TRADE_BARS)


def scan_quote_bars(spark: SparkSession, root: str, agg: str, years: int | tuple[int, int] | None = None) -> DataFrame:
    return conform(_of_years(spark, root, agg, years), QUOTE_BARS)


def scan_option_features(spark: SparkSession, root: str, agg: str, tickers: list[str] | None = None) -> DataFrame:
    """Option features of a size, with all columns of the table but its partition's."""
    df = spark.read.parquet(root).where(F.col("agg") == agg).drop("agg")
    return df if tickers is None else df.where(F.col("ticker").isin(tickers))


def scan_chains(spark: SparkSession, root: str, agg: str, fallback: str = "1min") -> DataFrame:
    """Chains of the wanted size where a ticker has them, else of the fallback."""
    rows = spark.read.parquet(root)
    wanted = rows.where(F.col("agg") == agg)
    if agg == fallback:
        return wanted
    return wanted.unionByName(rows.where(F.col("agg") == fallback).join(wanted.select("ticker").distinct(), "ticker", "left_anti").select(*rows.columns))


def scan_option_flatfile(spark: SparkSession, path: str, roots: list[str] | None = None) -> DataFrame:
    """Option minute bars with the parts of their symbols; rows whose symbol is none go."""
    df = scan_csv(spark, path, OPTION_FLATFILE).withColumn("occ", parse_occ_symbol(F.col("ticker"))).where("occ is not null")
    df = df.select(F.col("ticker").alias("symbol"), "volume", "open", "close", "high", "low", F.expr("window_start div 60000000000").alias("minute"), "occ.*")
    return df if roots is None else df.where(F.col("root").isin(roots))


def scan_option_quote_flatfile(spark: SparkSession, path: str) -> DataFrame:
    """Quotes with a bid and an ask, keyed by the minute of their time."""
    return scan_csv(spark, path, QUOTE_FLATFILE).where("bid_price > 0 and ask_price > 0").withColumn("minute", F.expr("sip_timestamp div 60000000000"))


def scan_stock_day_flatfile(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, STOCK_DAY_FLATFILE).withColumn("day", F.to_date(F.timestamp_micros(F.expr("window_start div 1000"))))


def scan_trade_flatfile(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, TRADE_FLATFILE)


def ingest_json_payloads(spark: SparkSession, path: str, dataset: str, schema: str, page_a_file: bool = True) -> DataFrame:
    """Rows of pages of JSON, each with an array `results`; short keys get their names, missing columns are null.

    A page is a file, or with page_a_file=False a line.
    """
    short = SHORT_KEYS.get(dataset, {})
    fields = T._parse_datatype_string(schema).fields
    back = {v: k for k, v in short.items()}
    raw = T.StructType([T.StructField("results", T.ArrayType(T.StructType([T.StructField(n, f.dataType) for f in fields for n in dict.fromkeys((f.name, back.get(f.name, f.name)))])))])
    rows = spark.read.schema(raw).option("multiLine", page_a_file).option("mode", "PERMISSIVE").json(path).select(F.explode("results").alias("r"))
    value = lambda f: F.coalesce(F.col(f"r.`{f.name}`"), F.col(f"r.`{back.get(f.name, f.name)}`"))
    return rows.select(*(value(f).alias(f.name) for f in fields))


def flatten_chain_snapshot(snapshot: DataFrame) -> DataFrame:
    """Nested contract snapshots as flat columns; missing structs give nulls."""
    def part(struct: str, field: str, name: str) -> Column:
        kind = next((f.dataType for f in snapshot.schema.fields if f.name == struct), None)
        return (F.col(f"{struct}.{field}") if isinstance(kind, T.StructType) and field in kind.names else F.lit(None).cast("double")).alias(name)

    wanted = [("details", "ticker", "symbol"), ("details", "strike_price", "strike"), ("details", "expiration_date", "expiry"), ("details", "contract_type", "type"), ("day", "close", "close"), ("day", "volume", "volume"), ("last_quote", "bid", "bid"), ("last_quote", "ask", "ask"), ("last_trade", "price", "last_price"), ("greeks", "delta", "delta"), ("greeks", "gamma", "gamma"), ("greeks", "theta", "theta"), ("greeks", "vega", "vega"), ("underlying_asset", "ticker", "underlying_ticker"), ("underlying_asset", "price", "underlying")]
    return snapshot.select(*(part(*w) for w in wanted), *(F.col(c) for c in ("implied_volatility", "open_interest", "break_even_price") if c in snapshot.columns))


def corporate_actions_build(events: DataFrame) -> DataFrame:
    """ticker, date, new_ticker from rows with an array of change events."""
    return events.select("ticker", F.explode("events").alias("e")).select("ticker", F.col("e.date").alias("date"), F.col("e.ticker").alias("new_ticker")).where("new_ticker is not null")


def financials_flatten(filings: DataFrame, items: dict[str, str]) -> DataFrame:
    """Values of line items (name to `statement.item` of maps of structs) of filings with an end date."""
    cols = [F.col(p.split(".")[0])[p.split(".")[1]]["value"].cast("double").alias(n) for n, p in items.items()]
    return filings.where("end_date is not null").select("ticker", "end_date", *cols)


def write_parquet(df: DataFrame, path: str, *partitions: str, mode: str = "error") -> None:
    """Files sorted by ticker and time inside their partitions, so that filters on them skip row groups."""
    keys = [c for c in ("ticker", "ts") if c in df.columns]
    (df.sortWithinPartitions(*partitions, *keys) if keys else df).write.mode(mode).partitionBy(*partitions).parquet(path)


def write_counted(df: DataFrame, path: str, *partitions: str, mode: str = "error") -> int:
    """write_parquet that gives the number of rows, which the job that writes them counts."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("n")), path, *partitions, mode=mode)
    return seen.get["n"]


def append_table(df: DataFrame, path: str, *partitions: str) -> None:
    write_parquet(df, path, *partitions, mode="append")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_naive_csv(spark: SparkSession, path: str, schema: str, ts: str = "ts") -> DataFrame:
    """CSV whose naive times are UTC+8, as UTC."""
    return scan_csv(spark, path, schema).withColumn(ts, naive_ts_to_utc(F.col(ts)))


def numbers(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c).cast("string")) for c in columns})


def verify_publish(staged: DataFrame, schema: T.StructType, rows: int, ts: str = "ts") -> None:
    """Raises unless the staged table has the columns and rows it should have and no null time; one job."""
    names = [(f.name, f.dataType) for f in schema.fields]
    if [(f.name, f.dataType) for f in staged.schema.fields] != names:
        raise ValueError(f"columns differ: {staged.schema.simpleString()}")
    n, nulls = staged.agg(F.count("*"), F.count(F.when(F.col(ts).isNull(), 1))).first()
    if n != rows or nulls:
        raise ValueError(f"{n} rows of {rows}, {nulls} without a time")
