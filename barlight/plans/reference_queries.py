"""Queries on reference datasets: pages of JSON made of the given tables' rows, ingested, written and listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.plans import fixtures as X
from barlight.plans.book import Book
from barlight.sources import reference as R
from barlight.sources.shared import new_path

BOOK = Book()
add = BOOK.add

#: Records on a page.
PAGE = 50


def pages(rows: DataFrame, number: str) -> DataFrame:
    """Pages of JSON records of rows; number: a column by which they are dealt. Each page is sent again, later, as it is."""
    fields = [c for c in rows.columns if c != number]
    texts = rows.groupBy(F.floor(F.col(number) / PAGE).alias("page")).agg(F.concat(F.lit('{"status":"OK","results":['), F.concat_ws(",", F.collect_list(F.to_json(F.struct(*fields)))), F.lit("]}")).alias("value"))
    return texts.select("page", "value").union(texts.select(F.col("page") + 1_000_000_000, "value"))


def _stored(spark, rows: DataFrame, number: str, dataset: str) -> str:
    path = new_path(spark)
    R.write_dataset(R.latest_records(R.ingest(pages(rows, number), dataset), dataset, "page").drop("page"), path, dataset)
    return path


def _split_rows(spark, sf):
    s = X.splits(spark, sf)
    return s.select(F.col("id").cast("string").alias("id"), "execution_date", "split_from", "split_to", "ticker", F.when(F.col("id") % 3 == 0, "soon").alias("note"), F.col("id").alias("n"))


@add("SELECT id, ticker, execution_date, split_from, split_to, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'soon' END AS note FROM (SELECT CAST(id AS VARCHAR) AS id, ticker, execution_date, split_from, split_to FROM splits) WHERE execution_date >= DATE '1993-01-01' AND split_to > 1", "splits", dates="execution_date", doubles="split_from split_to")
def reference_splits(spark, sf):
    import datetime

    path = _stored(spark, _split_rows(spark, sf), "n", "splits")
    return R.query(spark, path, "splits", execution_date__gte=datetime.date(1993, 1, 1), split_to__gt=1.0).select("id", "ticker", "execution_date", "split_from", "split_to", F.col("rescued")["note"].alias("note"))


def _dividend_rows(spark, sf):
    o = X.read(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    return o.select(F.col("o_orderkey").cast("string").alias("id"), F.round(F.col("o_totalprice") / 1000 + X.hair(2), 2).alias("cash_amount"), F.lit("USD").alias("currency"), day.alias("declaration_date"), F.lit("CD").alias("dividend_type"), F.date_add(day, 10).alias("ex_dividend_date"), F.when(F.col("o_orderkey") % 2 == 0, "4").otherwise("often").alias("frequency"), F.date_add(day, 30).alias("pay_date"), F.concat(F.lit("T"), F.col("o_custkey") % 50).alias("ticker"), F.col("o_orderkey").alias("n"))


_DIVIDENDS = f"SELECT CAST(o_orderkey AS VARCHAR) AS id, 'T' || (o_custkey % 50) AS ticker, round(o_totalprice / 1000 + {X.hair(2):.10f}, 2) AS cash_amount, CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS ex_dividend_date, CAST(o_orderkey % 2 = 1 AS BOOLEAN) AS odd FROM orders"


@add(f"SELECT id, ticker, cash_amount, ex_dividend_date, CASE WHEN odd THEN 'often' END AS unfit FROM ({_DIVIDENDS}) WHERE ticker IN ('T3', 'T7') ORDER BY cash_amount DESC, ticker, ex_dividend_date, id LIMIT 100", doubles="cash_amount")
def reference_dividends(spark, sf):
    path = _stored(spark, _dividend_rows(spark, sf), "n", "dividends")
    # A frequency given as text of a number doesn't fit either, as in any typed reader: both are kept as they came.
    rows = R.query(spark, path, "dividends", sort="cash_amount", order="desc", limit=100, ticker__any_of=["T3", "T7"])
    return rows.select("id", "ticker", "cash_amount", "ex_dividend_date", F.when(F.col("rescued")["frequency"] == "often", "often").alias("unfit"))


@add("SELECT symbol AS ticker, type AS contract_type, strike AS strike_price, ticker AS underlying_ticker, CAST(dte AS DOUBLE) AS amount FROM contracts WHERE strike >= 901 AND type = 'C'", "contracts", doubles="strike_price amount")
def reference_contracts(spark, sf):
    c = X.contracts(spark, sf)
    rows = c.select(F.array(F.struct(F.col("dte").cast("double").alias("amount"), F.lit("equity").alias("type"), F.col("ticker").alias("underlying"))).alias("additional_underlyings"), F.col("type").alias("contract_type"), F.lit("american").alias("exercise_style"), F.col("strike").alias("strike_price"), F.col("symbol").alias("ticker"), F.col("ticker").alias("underlying_ticker"), F.col("p_partkey").alias("n"))
    path = _stored(spark, rows, "n", "contracts")
    return R.query(spark, path, "contracts", strike_price__gte=901.0, contract_type="C").select("ticker", "contract_type", "strike_price", "underlying_ticker", F.col("additional_underlyings")[0]["amount"].alias("amount"))


@add("SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, p_size > 25 AS high_low, p_brand AS cta FROM part")
def reference_conditions(spark, sf):
    p = X.read(spark, sf, "part")
    rules = F.struct(F.struct((F.col("p_size") > 25).alias("updates_high_low")).alias("consolidated"))
    rows = p.select(F.lit("stocks").alias("asset_class"), F.array(F.lit("trade")).alias("data_types"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("CTA")).alias("sip_mapping"), rules.alias("update_rules"), F.col("p_partkey").alias("n"))
    path = _stored(spark, rows, "n", "conditions")
    return R.query(spark, path, "conditions", asset_class="stocks").select("id", "name", F.col("update_rules.consolidated.updates_high_low").alias("high_low"), F.col("sip_mapping.CTA").alias("cta"))


@add("SELECT CAST(d AS VARCHAR) AS date, 'NYSE' AS exchange, CAST(n AS VARCHAR) AS orders FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) WHERE isodow(d) = 5 ORDER BY date DESC LIMIT 200")
def reference_holidays(spark, sf):
    days = X.read(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders")).where("dayofweek(date) = 6")
    rows = days.select("date", F.lit("NYSE").alias("exchange"), F.lit("closed").alias("status"), "orders", F.datediff("date", F.lit("1970-01-01")).alias("n"))
    path = _stored(spark, rows, "n", "holidays")
    return R.query(spark, path, "holidays", sort="date", order="desc", limit=200, status="closed").select("date", "exchange", F.col("rescued")["orders"].alias("orders"))


@add(
    "SELECT 'splits' AS action, ticker, CAST(execution_date AS VARCHAR) AS date, CAST(split_to AS DOUBLE) AS value FROM splits"
    f" UNION ALL SELECT 'dividends', ticker, ex_dividend_date, cash_amount FROM ({_DIVIDENDS})"
    " UNION ALL SELECT 'changes', t, CAST(d AS VARCHAR), CAST(length(u) AS DOUBLE) FROM (SELECT DISTINCT 'C' || (o_custkey % 10) AS t, CAST(o_orderdate AS DATE) AS d, o_orderstatus || 'X' AS u FROM orders)",
    "splits",
    doubles="value",
)
def corporate_actions_build(spark, sf):
    path = new_path(spark)
    o = X.read(spark, sf, "orders")
    events = o.groupBy(F.concat(F.lit("C"), F.col("o_custkey") % 10).alias("ticker"), F.floor(F.col("o_orderkey") / 1000).alias("part")).agg(F.collect_list(F.struct(F.to_date("o_orderdate").alias("date"), F.concat("o_orderstatus", F.lit("X")).alias("ticker"))).alias("events"))
    R.corporate_actions_build(pages(_split_rows(spark, sf), "n"), pages(_dividend_rows(spark, sf), "n"), events, path)
    out = spark.read.parquet(f"{path}/splits").select(F.lit("splits").alias("action"), "ticker", F.col("execution_date").alias("date"), F.col("split_to").alias("value"))
    out = out.union(spark.read.parquet(f"{path}/dividends").select(F.lit("dividends"), "ticker", "ex_dividend_date", "cash_amount"))
    return out.union(spark.read.parquet(f"{path}/ticker_changes").select(F.lit("changes"), "ticker", "date", F.length("new_ticker").cast("double")))


@add("SELECT CAST(year(execution_date) AS INTEGER) AS year, CASE WHEN split_to > 2 THEN 'large' ELSE 'small' END AS name, s.ticker, f.market_cap FROM splits s JOIN fundamentals f ON CAST(CAST(s.ticker AS BIGINT) + 1 AS VARCHAR) = f.ticker WHERE year(execution_date) >= 1993", "splits", "fundamentals", doubles="market_cap")
def universe_lists(spark, sf):
    path = new_path(spark)
    s = X.splits(spark, sf).withColumn("f_ticker", (F.col("ticker").cast("long") + 1).cast("string"))
    members = s.join(X.fundamentals(spark, sf).select(F.col("ticker").alias("f_ticker"), "market_cap"), "f_ticker").select("ticker", "market_cap", F.year("execution_date").alias("year"), F.when(F.col("split_to") > 2, "large").otherwise("small").alias("name"))
    R.write_universe(members, path)
    return R.read_universe(spark, path, "ticker string, market_cap double, year int, name string").where("year >= 1993")
