"""Market tables derived from the given tables, as DataFrames and as SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

US = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {})"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select(F.col("event_type").alias("ticker"), (F.expr(US.format("ts")) * 1000).alias("sip_ns"), "ts", F.col("value").alias("price"), (1 + k).alias("size"), (F.col("user_id") % 16).alias("exchange"), F.col("event_id").alias("sequence"), "user_id")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v, i = read(spark, sf_dir, "events"), F.col("value"), F.col("event_id")
    return e.select(F.col("event_type").alias("ticker"), (F.expr(US.format("ts")) * 1000).alias("sip_ns"), "ts", (v * (1 - 0.0005 * (1 + i % 5))).alias("bid_price"), (v * (1 + 0.0005 * (1 + i % 3))).alias("ask_price"), (1 + i % 7).cast("double").alias("bid_size"), (1 + F.col("user_id") % 9).cast("double").alias("ask_size"))


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of the five event types; ts is the hour's begin."""
    from barlight.operators.bars import bars_from_ticks

    return bars_from_ticks(ticks(spark, sf_dir), F.date_trunc("hour", "ts").cast("timestamp_ntz"), "ts")


def day_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of ten tickers from order lines."""
    l = read(spark, sf_dir, "lineitem")
    at = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    p, q = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_quantity")
    return l.groupBy((F.col("l_suppkey") % 10).cast("string").alias("ticker"), F.to_date("l_shipdate").alias("day")).agg(F.min_by(p, at).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), F.max_by(p, at).alias("close"), F.sum(q).alias("volume"), (F.sum(p * q) / F.sum(q)).alias("vwap"), F.count("*").alias("transactions"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    kind = F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("P")
    return p.select(F.upper(F.regexp_replace("p_brand", "#.*", "")).alias("root"), F.col("p_brand").alias("ticker"), F.col("p_retailprice").alias("strike"), F.col("p_size").cast("long").alias("dte"), kind.alias("type"), F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("symbol"), "p_partkey")


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, c = read(spark, sf_dir, "lineitem"), contracts(spark, sf_dir)
    rows = l.select(F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("day"), (1 + F.col("l_quantity")).alias("close"), F.col("l_quantity").alias("volume"), (950 + F.col("l_suppkey") % 50).cast("double").alias("underlying"), F.col("l_tax").alias("spread"), F.col("l_orderkey").alias("line_order"), (F.col("l_discount") + 0.1).alias("iv"), (F.col("l_tax") / 100).alias("gamma"), (F.col("l_quantity") * 10).alias("open_interest"))
    rows = rows.join(c, "p_partkey").withColumn("delta", F.when(F.col("type") == "C", F.col("volume") / 51).otherwise(-F.col("volume") / 51))
    return rows.withColumn("vega", F.col("volume") / 100)


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("string").alias("ticker"), (F.col("s_acctbal") * 1e6).alias("market_cap"), F.col("n_name").alias("exchange"), F.col("s_name").alias("sector"))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split of each of ten tickers in each odd year, on the day of its first order in that year."""
    first = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("t"), F.to_date("o_orderdate").alias("d")).where("year(d) % 2 = 1").groupBy("t", F.year("d").alias("y")).agg(F.min("d").alias("execution_date"))
    ratio = F.element_at(F.array(*map(F.lit, (2.0, 3.0, 10.0, 0.5))), ((F.col("t") + F.col("y")) % 4 + 1).cast("int"))
    return first.select(F.col("t").cast("string").alias("ticker"), "execution_date", F.lit(1.0).alias("split_from"), ratio.alias("split_to"), (F.col("y") * 10 + F.col("t")).cast("long").alias("id"))


TENORS = {"y1m": 30, "y3m": 91, "y6m": 182, "y1": 365, "y2": 730, "y5": 1825}


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    n = F.datediff("date", F.lit("1970-01-01"))
    rate = lambda k: (2 + 0.1 * k + (n % 7) / 10)
    return days.where(n % 5 != 0).select("date", *(rate(k).alias(c) if c != "y6m" else F.when(n % 11 == 0, 0.0).otherwise(rate(k)).alias(c) for k, c in enumerate(TENORS)))


def trades_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    result = F.when(F.col("l_returnflag") == "R", "loss").when(F.col("l_returnflag") == "A", "win").otherwise("timeout")
    return l.select((F.col("l_suppkey") % 10).cast("string").alias("ticker"), F.col("l_linestatus").alias("strategy"), (1.5 + 0.5 * (F.col("l_linenumber") % 3)).alias("rr_ratio"), result.alias("result"), (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("pnl"), ((F.col("l_discount") - 0.05) * 100).alias("pnl_pct"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"))


LOG_ORDER = ["day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"]


def hair(places: int) -> float:
    """Less than a hundredth of the last place: values that lie just between two roundings go the same way in both engines."""
    return 1.23 * 10 ** -(places + 2)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded and days and times as text, as in the SQL."""
    out = {"double": lambda c: F.round(F.col(c) + hair(places), places) + 0.0, "date": lambda c: F.col(c).cast("string"), "timestamp_ntz": lambda c: F.col(c).cast("string")}
    return df.select(*(out.get(t, F.col)(c).alias(c) for c, t in df.dtypes))


_K = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE)"""
SQL = {
    "ticks": f"SELECT event_type AS ticker, epoch_us(ts) * 1000 AS sip_ns, ts, value AS price, 1 + {_K} AS size, user_id % 16 AS exchange, event_id AS sequence, user_id FROM events",
    "quotes": "SELECT event_type AS ticker, epoch_us(ts) * 1000 AS sip_ns, ts, value * (1 - 0.0005 * (1 + event_id % 5)) AS bid_price, value * (1 + 0.0005 * (1 + event_id % 3)) AS ask_price, CAST(1 + event_id % 7 AS DOUBLE) AS bid_size, CAST(1 + user_id % 9 AS DOUBLE) AS ask_size FROM events",
    "hour_bars": "SELECT ticker, date_trunc('hour', ts) AS ts, first(price ORDER BY sip_ns, sequence) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY sip_ns, sequence) AS close, sum(size) AS volume, sum(price * size) / sum(size) AS vwap, count(*) AS transactions FROM ticks GROUP BY 1, 2",
    "day_bars": "SELECT CAST(l_suppkey % 10 AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS day, first(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS open, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, last(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS close, sum(l_quantity) AS volume, sum(l_extendedprice) / sum(l_quantity) AS vwap, count(*) AS transactions FROM lineitem GROUP BY 1, 2",
    "contracts": "SELECT p_brand AS ticker, p_retailprice AS strike, CAST(p_size AS BIGINT) AS dte, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS type, 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS symbol, p_partkey FROM part",
    "chains": "SELECT c.*, CAST(l_shipdate AS DATE) AS day, 1 + l_quantity AS close, l_quantity AS volume, CAST(950 + l_suppkey % 50 AS DOUBLE) AS underlying, l_tax AS spread, l_orderkey AS line_order, l_discount + 0.1 AS iv, l_tax / 100 AS gamma, l_quantity * 10 AS open_interest, CASE WHEN type = 'C' THEN l_quantity / 51 ELSE -l_quantity / 51 END AS delta, l_quantity / 100 AS vega FROM lineitem JOIN contracts c ON l_partkey = c.p_partkey",
    "fundamentals": "SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_acctbal * 1e6 AS market_cap, n_name AS exchange, s_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "splits": "SELECT CAST(t AS VARCHAR) AS ticker, execution_date, CAST(1 AS DOUBLE) AS split_from, [2::DOUBLE, 3::DOUBLE, 10::DOUBLE, 0.5::DOUBLE][1 + (t + y) % 4] AS split_to, CAST(y * 10 + t AS BIGINT) AS id FROM (SELECT o_custkey % 10 AS t, year(o_orderdate) AS y, min(CAST(o_orderdate AS DATE)) AS execution_date FROM orders WHERE year(o_orderdate) % 2 = 1 GROUP BY 1, 2)",
    "curve": "SELECT date, 2 + 0.1 * 0 + (n % 7) / 10.0 AS y1m, 2 + 0.1 * 1 + (n % 7) / 10.0 AS y3m, CASE WHEN n % 11 = 0 THEN 0.0 ELSE 2 + 0.1 * 2 + (n % 7) / 10.0 END AS y6m, 2 + 0.1 * 3 + (n % 7) / 10.0 AS y1, 2 + 0.1 * 4 + (n % 7) / 10.0 AS y2, 2 + 0.1 * 5 + (n % 7) / 10.0 AS y5 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS n FROM orders) WHERE n % 5 <> 0",
    "trades_log": "SELECT CAST(l_suppkey % 10 AS VARCHAR) AS ticker, l_linestatus AS strategy, CAST(1.5 + 0.5 * (l_linenumber % 3) AS DOUBLE) AS rr_ratio, CASE l_returnflag WHEN 'R' THEN 'loss' WHEN 'A' THEN 'win' ELSE 'timeout' END AS result, l_extendedprice * (l_discount - 0.05) AS pnl, (l_discount - 0.05) * 100 AS pnl_pct, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, l_quantity AS quantity, l_tax AS tax FROM lineitem",
}
NEEDS = {"hour_bars": ["ticks"], "chains": ["contracts"]}


def sql(query: str, *fixtures: str, places: int = 4, doubles: str = "", dates: str = "") -> str:
    """The query after the fixtures' tables; named columns of the result are rounded or made text."""
    names: list[str] = []
    for f in fixtures:
        names += [n for n in [*NEEDS.get(f, []), f] if n not in names]
    tables = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    body = query.strip()
    if body.upper().startswith("WITH "):
        tables, body = f"{tables}, {body[5:]}" if tables else body[5:], ""
    whole = f"WITH {tables} {body}" if tables else query
    changed = [f"round({c} + {hair(places):.10f}, {places}) + 0.0 AS {c}" for c in doubles.split()] + [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    if changed:
        whole = f"SELECT * REPLACE ({', '.join(changed)}) FROM ({whole})"
    return whole
