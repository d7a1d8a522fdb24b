"""Queries on option chains, curves and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.operators import joins as J
from barlight.operators import options as O
from barlight.operators import splits as S
from barlight.plans import fixtures as X
from barlight.plans.book import Book

BOOK = Book()
add = BOOK.add


@add("WITH r AS (SELECT ticker, (min(underlying) + max(underlying)) / 2 AS mid FROM chains GROUP BY 1) SELECT symbol, c.ticker, strike FROM contracts c JOIN r ON c.ticker = r.ticker WHERE strike >= mid * (1 - 0.02) AND strike <= mid * (1 + 0.02)", "chains", doubles="strike")
def discover_contracts(spark, sf):
    c = X.chains(spark, sf)
    return O.discover_contracts(X.contracts(spark, sf).select("symbol", "ticker", "strike"), c.select("ticker", F.col("underlying").alias("close")), 0.02)


@add("SELECT symbol, day, line_order, close FROM chains WHERE strike IS NOT NULL AND close > 0 AND dte >= 1 AND close > greatest(CASE WHEN type = 'C' THEN underlying - strike ELSE strike - underlying END, 0) AND dte > 0 AND underlying > 0", "chains", doubles="close", dates="day")
def has_time_premium(spark, sf):
    return O.has_time_premium(O.valid_contracts(X.chains(spark, sf))).select("symbol", "day", "line_order", "close")


@add("""WITH e AS (SELECT *, CAST(day + CAST(dte AS INTEGER) AS DATE) AS expiry FROM chains), x AS (SELECT symbol, line_order, close, underlying, strike, expiry, dte, greatest(CASE WHEN type = 'C' THEN underlying - strike ELSE strike - underlying END, 0) AS intrinsic FROM e)
  SELECT symbol, line_order, CAST(dte AS INTEGER) AS dte, CASE WHEN isodow(expiry) = 5 AND extract(day FROM expiry) BETWEEN 15 AND 21 THEN 'Monthly' WHEN isodow(expiry) = 5 OR dte <= 7 THEN 'Weekly' ELSE 'Monthly' END AS expiry_type, underlying / strike AS moneyness, intrinsic, greatest(close - intrinsic, 0) AS extrinsic, close AS mid FROM x""", "chains", doubles="moneyness intrinsic extrinsic mid", places=6)
def chain_enrich(spark, sf):
    c = X.chains(spark, sf).withColumn("expiry", F.date_add("day", F.col("dte").cast("int")))
    return O.chain_enrich(c).select("symbol", "line_order", "dte", "expiry_type", "moneyness", "intrinsic", "extrinsic", "mid")


def _bars(spark, sf):
    """Chain rows of a ticker and month as one bar, with the month's underlying."""
    c = X.chains(spark, sf).withColumn("ts", F.date_trunc("month", "day").cast("date"))
    s = c.groupBy("ticker", "ts").agg(F.max("underlying").alias("s"))
    return c.drop("underlying").join(s, ["ticker", "ts"]).withColumnRenamed("s", "underlying")


MONTH = "cm AS (SELECT c.* EXCLUDE (underlying), CAST(date_trunc('month', day) AS DATE) AS ts FROM chains c), sm AS (SELECT ticker, CAST(date_trunc('month', day) AS DATE) AS ts, max(underlying) AS underlying FROM chains GROUP BY 1, 2), m AS (SELECT cm.*, sm.underlying FROM cm JOIN sm ON cm.ticker = sm.ticker AND cm.ts = sm.ts)"


@add(f"""WITH {MONTH}, d AS (SELECT ticker, ts, symbol, any_value(type) AS type, any_value(strike) AS strike, any_value(dte) AS dte, any_value(underlying) AS underlying, sum(close * volume) / sum(volume) AS close, sum(volume) AS volume FROM m GROUP BY 1, 2, 3), a AS (SELECT *, first(strike) OVER (PARTITION BY ticker, ts ORDER BY abs(strike - underlying), strike) AS atm FROM d),
  g AS (SELECT ticker, ts, any_value(atm) AS atm_strike, last(close ORDER BY dte, symbol) FILTER (strike = atm AND type = 'C') AS call_close, last(close ORDER BY dte, symbol) FILTER (strike = atm AND type = 'P') AS put_close, coalesce(sum(volume) FILTER (type = 'P'), 0) AS put_volume, coalesce(sum(volume) FILTER (type = 'C'), 0) AS call_volume, count(DISTINCT strike) AS contract_count,
    coalesce(last(dte ORDER BY dte, symbol) FILTER (strike = atm AND type = 'C'), last(dte ORDER BY dte, symbol) FILTER (strike = atm AND type = 'P')) AS atm_dte FROM a GROUP BY 1, 2)
  SELECT *, call_close + put_close AS straddle, call_close + put_close AS expected_move, put_volume / nullif(call_volume, 0) AS pcr FROM g""", "chains", doubles="atm_strike call_close put_close put_volume call_volume straddle expected_move pcr", dates="ts")
def option_features(spark, sf):
    return O.option_features(_day_rows(spark, sf))


def _day_rows(spark, sf):
    """One row a contract and month."""
    first = lambda c: F.first(c).alias(c)
    return _bars(spark, sf).groupBy("ticker", "ts", "symbol").agg(*map(first, ("type", "strike", "dte", "underlying")), (F.sum(F.col("close") * F.col("volume")) / F.sum("volume")).alias("close"), F.sum("volume").alias("volume"))


DAYROWS = "d AS (SELECT ticker, ts, symbol, any_value(type) AS type, any_value(strike) AS strike, any_value(dte) AS dte, any_value(underlying) AS underlying FROM m GROUP BY 1, 2, 3)"


@add(f"WITH {MONTH}, {DAYROWS} SELECT ticker, ts, symbol, dte FROM (SELECT *, row_number() OVER (PARTITION BY ticker, ts ORDER BY abs(dte - 30), dte, abs(strike - underlying), symbol) AS n FROM d WHERE dte >= 1 AND abs(strike - underlying) <= 0.02 * underlying) WHERE n = 1", "chains", dates="ts")
def iv30d_contract(spark, sf):
    return O.iv30d_contract(_day_rows(spark, sf)).select("ticker", "ts", "symbol", "dte")


@add(f"WITH {MONTH}, {DAYROWS}, x AS (SELECT *, first(dte) OVER (PARTITION BY ticker, ts ORDER BY abs(dte - 30), dte) AS dd FROM d) SELECT ticker, ts, symbol, dte FROM (SELECT *, row_number() OVER (PARTITION BY ticker, ts ORDER BY CASE WHEN abs(strike - underlying) <= 0.02 * underlying THEN 0 ELSE 1 END, abs(strike - underlying), strike, type, symbol) AS n FROM x WHERE dte = dd) WHERE n = 1", "chains", dates="ts")
def chain_iv30d(spark, sf):
    return O.chain_iv30d(_day_rows(spark, sf)).select("ticker", "ts", "symbol", "dte")


@add("SELECT ticker, day, avg(iv) AS mean_iv, sum(abs(gamma) * volume) AS gamma_exposure, avg(iv) FILTER (type = 'P') - avg(iv) FILTER (type = 'C') AS iv_skew, sum(delta) AS delta_sum, sum(iv * vega) / nullif(sum(vega), 0) AS vega_weighted_iv FROM chains GROUP BY 1, 2", "chains", doubles="mean_iv gamma_exposure iv_skew delta_sum vega_weighted_iv", dates="day", places=6)
def chain_daily_features(spark, sf):
    return O.chain_daily_features(X.chains(spark, sf))


@add("SELECT ticker, day, nullif(sum(gamma * open_interest * underlying * 100), 0) AS gex, nullif(sum(delta * open_interest * underlying * 100), 0) AS dex, coalesce(sum(volume) FILTER (type = 'C'), 0) AS call_volume, coalesce(sum(volume) FILTER (type = 'P'), 0) AS put_volume, coalesce(sum(open_interest) FILTER (type = 'C'), 0) AS call_oi, coalesce(sum(open_interest) FILTER (type = 'P'), 0) AS put_oi, sum(open_interest) AS total_oi, coalesce(sum(volume) FILTER (type = 'P'), 0) / nullif(sum(volume) FILTER (type = 'C'), 0) AS pcr FROM chains GROUP BY 1, 2", "chains", doubles="gex dex call_volume put_volume call_oi put_oi total_oi pcr", dates="day")
def chain_snapshot_features(spark, sf):
    return O.chain_snapshot_features(X.chains(spark, sf))


KEY = "abs(strike - underlying), strike, symbol, line_order"


@add("SELECT ticker, day, " + ", ".join(f"first(iv ORDER BY abs(dte - {t}), dte, abs(strike - underlying), strike, symbol, iv) AS iv_{t}d" for t in (7, 30, 60, 90)) + " FROM (SELECT ticker, day, symbol, any_value(dte) AS dte, any_value(strike) AS strike, avg(iv) AS iv, max(underlying) AS underlying FROM chains GROUP BY 1, 2, 3) GROUP BY 1, 2", "chains", doubles="iv_7d iv_30d iv_60d iv_90d", dates="day", places=6)
def iv_term_structure(spark, sf):
    c = X.chains(spark, sf).groupBy("ticker", "day", "symbol").agg(F.first("dte").alias("dte"), F.first("strike").alias("strike"), F.avg("iv").alias("iv"), F.max("underlying").alias("underlying"))
    return O.iv_term_structure(c)


def _delta_sql(kind: str, target: float, name: str) -> str:
    return f"{name} AS (SELECT ticker, day, coalesce(max(iv) FILTER (n = 1) + (max(iv) FILTER (n = 2) - max(iv) FILTER (n = 1)) / nullif(max(delta) FILTER (n = 2) - max(delta) FILTER (n = 1), 0) * ({target} - max(delta) FILTER (n = 1)), max(iv) FILTER (n = 1)) AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY ticker, day ORDER BY abs(delta - ({target})), symbol) AS n FROM dd WHERE type = '{kind}') WHERE n <= 2 GROUP BY 1, 2)"


@add(f"WITH dd AS (SELECT ticker, day, symbol, any_value(type) AS type, avg(iv) AS iv, avg(delta) AS delta FROM chains GROUP BY 1, 2, 3), {_delta_sql('P', -0.25, 'put_iv')}, {_delta_sql('C', 0.25, 'call_iv')} SELECT coalesce(p.ticker, c.ticker) AS ticker, coalesce(p.day, c.day) AS day, put_iv, call_iv, put_iv - call_iv AS skew FROM put_iv p FULL JOIN call_iv c ON p.ticker = c.ticker AND p.day = c.day", "chains", doubles="put_iv call_iv skew", dates="day")
def skew_25d(spark, sf):
    c = X.chains(spark, sf).groupBy("ticker", "day", "symbol").agg(F.first("type").alias("type"), F.avg("iv").alias("iv"), F.avg("delta").alias("delta"))
    return O.skew_25d(c)


@add("SELECT ticker, sip_ns // 3600000000000 AS bucket, avg(ask_price - bid_price) AS mean_spread, avg(bid_size) AS mean_bid_size, avg(ask_size) AS mean_ask_size, avg((bid_size - ask_size) / (bid_size + ask_size)) AS mean_imbalance FROM quotes GROUP BY 1, 2", "quotes", doubles="mean_spread mean_bid_size mean_ask_size mean_imbalance", places=6)
def option_quote_features(spark, sf):
    return O.option_quote_features(X.quotes(spark, sf).withColumn("bucket", F.expr("sip_ns div 3600000000000")))


@add("WITH c AS (SELECT *, lead(date) OVER (ORDER BY date) AS until, min(date) OVER () AS first FROM curve) SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, c.date AS curve_date, y1m, y2 FROM orders JOIN c ON (CAST(o_orderdate AS DATE) >= date OR date = first) AND (until IS NULL OR CAST(o_orderdate AS DATE) < until)", "curve", doubles="y1m y2", dates="day curve_date")
def asof_yield_join(spark, sf):
    o = X.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return J.asof_yield_join(o, X.curve(spark, sf)).select("o_orderkey", "day", "curve_date", "y1m", "y2")


def _rate_sql() -> str:
    names = sorted(X.TENORS, key=X.TENORS.get)
    parts = [f"WHEN dte <= {X.TENORS[names[0]]} THEN {names[0]}"]
    for a, b in zip(names, names[1:]):
        parts.append(f"WHEN dte <= {X.TENORS[b]} THEN CASE WHEN {a} <= 0 OR {b} <= 0 THEN greatest({a}, {b}) ELSE {a} + ({b} - {a}) * (dte - {X.TENORS[a]}) / {X.TENORS[b] - X.TENORS[a]} END")
    return f"coalesce(CASE {' '.join(parts)} ELSE {names[-1]} END, 4) / 100"


@add(f"WITH c AS (SELECT *, lead(date) OVER (ORDER BY date) AS until, min(date) OVER () AS first FROM curve), o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_custkey % 2000 AS BIGINT) AS dte FROM orders) SELECT o_orderkey, day, dte, {_rate_sql()} AS rate FROM o JOIN c ON (day >= date OR date = first) AND (until IS NULL OR day < until)", "curve", doubles="rate", dates="day", places=6)
def interp_rate(spark, sf):
    o = X.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 2000).alias("dte"))
    return O.interp_rate(o, X.curve(spark, sf), X.TENORS)


@add("SELECT date, y1m, y3m, y6m, y1, y2, y5 FROM curve", "curve", doubles="y1m y3m y6m y1 y2 y5", dates="date")
def yields_build(spark, sf):
    return X.curve(spark, sf).orderBy("date")


def _quoted(spark, sf, add_iv: float, kind):
    """Chain rows near the money, at the price that their volatility gives: solving must give it back."""
    c = X.chains(spark, sf).withColumn("strike", F.col("underlying") * (0.95 + (F.col("line_order") % 7) / 100)).withColumn("dte", F.col("dte") + 30)
    return c.select("symbol", "day", "line_order", "underlying", F.lit(0.04).alias("rate"), "strike", "dte", kind.alias("type"), O.price_of(F.col("iv") + add_iv, F.col("underlying"), F.col("strike"), F.lit(0.04), F.col("dte") / 365, kind == "C").alias("close"))


@add("SELECT symbol, day, line_order, iv, CASE WHEN type = 'C' THEN 1 ELSE -1 END AS side FROM chains", "chains", doubles="iv", dates="day", places=3)
def enrich_greeks(spark, sf):
    return O.enrich_greeks(_quoted(spark, sf, 0.0, F.col("type"))).select("symbol", "day", "line_order", "iv", F.signum("delta").cast("int").alias("side"))


@add("SELECT symbol, day, line_order, iv AS call_iv, iv + 0.05 AS put_iv, 1 AS call_side, -1 AS put_side FROM chains", "chains", doubles="call_iv put_iv", dates="day", places=3)
def enrich_feature_greeks(spark, sf):
    c = X.chains(spark, sf).withColumn("strike", F.col("underlying") * (0.95 + (F.col("line_order") % 7) / 100)).withColumn("dte", F.col("dte") + 30)
    price = lambda more, call: O.price_of(F.col("iv") + more, F.col("underlying"), F.col("strike"), F.lit(0.04), F.col("dte") / 365, F.lit(call))
    sides = [x for p, kind, more in (("call", "C", 0.0), ("put", "P", 0.05)) for x in (F.col("strike").alias(f"{p}_strike"), F.col("dte").alias(f"{p}_dte"), F.lit(kind).alias(f"{p}_type"), price(more, kind == "C").alias(f"{p}_close"))]
    done = O.enrich_feature_greeks(c.select("symbol", "day", "line_order", "underlying", F.lit(0.04).alias("rate"), *sides), ("call", "put"))
    return done.select("symbol", "day", "line_order", "call_iv", "put_iv", F.signum("call_delta").cast("int").alias("call_side"), F.signum("put_delta").cast("int").alias("put_side"))


@add("SELECT b.ticker, b.day, b.close, coalesce((SELECT product(split_to / split_from) FROM splits s WHERE s.ticker = b.ticker AND s.execution_date > b.day), 1) AS factor FROM day_bars b", "day_bars", "splits", doubles="close factor", dates="day", places=6)
def split_factor_join(spark, sf):
    return J.split_factor_join(X.day_bars(spark, sf).select("ticker", "day", "close"), X.splits(spark, sf))


@add("SELECT b.ticker, b.day, close * f AS underlying, open * f AS call_close, low * f AS put_close, CASE WHEN f <> 1 THEN open * f + low * f ELSE open + low END AS straddle FROM (SELECT b.*, coalesce((SELECT product(split_to / split_from) FROM splits s WHERE s.ticker = b.ticker AND s.execution_date > b.day), 1) AS f FROM day_bars b) b", "day_bars", "splits", doubles="underlying call_close put_close straddle", dates="day", places=3)
def adjust_option_splits(spark, sf):
    f = X.day_bars(spark, sf).select("ticker", "day", F.col("close").alias("underlying"), F.col("open").alias("call_close"), F.col("low").alias("put_close"), (F.col("open") + F.col("low")).alias("straddle"), (F.col("open") + F.col("low")).alias("expected_move"))
    return S.adjust_option_splits(f, X.splits(spark, sf)).select("ticker", "day", "underlying", "call_close", "put_close", "straddle")


@add("SELECT ticker, execution_date, split_from, split_to, id FROM (SELECT *, row_number() OVER (PARTITION BY ticker, execution_date ORDER BY id) AS n FROM (SELECT * FROM splits UNION ALL SELECT ticker, execution_date, split_from, split_to + 1, id + 100 FROM splits)) WHERE n = 1", "splits", doubles="split_from split_to", dates="execution_date")
def dedupe_splits(spark, sf):
    s = X.splits(spark, sf)
    again = s.withColumn("split_to", F.col("split_to") + 1).withColumn("id", F.col("id") + 100)
    return S.dedupe_splits(s.unionByName(again)).select("ticker", "execution_date", "split_from", "split_to", "id")


LATER = "(SELECT b.*, coalesce((SELECT product(split_to / split_from) FROM splits s WHERE s.ticker = b.ticker AND s.execution_date > b.day), 1) AS f FROM day_bars b)"


def _records(spark, sf):
    return X.splits(spark, sf).select("ticker", F.col("execution_date").alias("split_date"), (F.col("split_to") / F.col("split_from")).alias("factor"))


@add(f"SELECT ticker, day, close / f AS close, volume * f AS volume FROM {LATER}", "day_bars", "splits", doubles="close volume", dates="day", places=4)
def adjust_trades_quotes(spark, sf):
    return S.adjust_trades_quotes(X.day_bars(spark, sf).select("ticker", "day", "close", "volume"), _records(spark, sf), ("close",), ("volume",))


@add(f"SELECT ticker, day, f AS later_factor FROM {LATER} WHERE f <> 1", "day_bars", "splits", doubles="later_factor", dates="day", places=4)
def split_record_join(spark, sf):
    steps = _records(spark, sf).select("ticker", F.col("split_date").alias("execution_date"), F.col("factor").alias("split_to"), F.lit(1.0).alias("split_from"))
    return J.split_factor_join(X.day_bars(spark, sf).select("ticker", "day"), steps, name="later_factor").where("later_factor <> 1")


STEP = "rt AS (SELECT ticker, day, (CASE WHEN day < DATE '1998-03-0' || (1 + CAST(ticker AS INTEGER) % 9) THEN 1 + CAST(ticker AS INTEGER) % 4 ELSE 1 END) * (1 + (extract(day FROM day) % 5) / 100) AS ratio FROM day_bars)".replace("DATE '1998-03-0' || (1 + CAST(ticker AS INTEGER) % 9)", "make_date(1998, 3, 1 + CAST(ticker AS INTEGER))")


def _ratios(spark, sf):
    t = F.col("ticker").cast("int")
    step = F.when(F.col("day") < F.make_date(F.lit(1998), F.lit(3), 1 + t), 1 + t % 4).otherwise(1)
    return X.day_bars(spark, sf).select("ticker", "day", (step * (1 + (F.dayofmonth("day") % 5) / 100)).alias("ratio"))


@add(f"""WITH {STEP}, o AS (SELECT *, ratio > 1.2 OR ratio < 1 / 1.2 AS off FROM rt), l AS (SELECT ticker, max(day) FILTER (off) AS last_off FROM o GROUP BY 1 HAVING count(*) >= 40), b AS (SELECT o.*, day <= last_off AS pre FROM o JOIN l ON o.ticker = l.ticker WHERE last_off IS NOT NULL),
  g AS (SELECT ticker, min(day) FILTER (NOT pre) AS split_date, count(*) FILTER (pre) AS a, count(*) FILTER (NOT pre) AS z, avg(CAST(off AS INTEGER)) FILTER (pre) AS share, median(ratio) FILTER (pre) / median(ratio) FILTER (NOT pre) AS raw FROM b GROUP BY 1)
  SELECT ticker, split_date, CAST(round(raw) AS DOUBLE) AS factor FROM g WHERE a >= 10 AND z >= 10 AND share >= 0.5 AND raw > 1.25""", "day_bars", doubles="factor", dates="split_date")
def detect_splits(spark, sf):
    return S.detect_splits(_ratios(spark, sf))


@add(f"""WITH {STEP}, r AS (SELECT ticker, make_date(1998, 3, 1 + CAST(ticker AS INTEGER)) AS split_date FROM (SELECT DISTINCT ticker FROM rt) UNION ALL SELECT 'none', DATE '1998-01-01'), g AS (SELECT r.ticker, r.split_date, median(ratio) FILTER (day < split_date) AS pre, median(ratio) FILTER (day >= split_date) AS post FROM r LEFT JOIN rt ON r.ticker = rt.ticker GROUP BY 1, 2)
  SELECT *, CASE WHEN pre / post IS NULL THEN 'MISSING' WHEN pre / post BETWEEN 1 / 1.15 AND 1.15 THEN 'OK' ELSE 'STEP' END AS status FROM g""", "day_bars", doubles="pre post", dates="split_date")
def check_split_consistency(spark, sf):
    ratios = _ratios(spark, sf)
    records = ratios.select("ticker").distinct().withColumn("split_date", F.make_date(F.lit(1998), F.lit(3), 1 + F.col("ticker").cast("int"))).union(spark.sql("select 'none', date'1998-01-01'"))
    return S.check_split_consistency(ratios, records)


@add("SELECT a.ticker, a.day, v / close AS ratio FROM (SELECT ticker, day, avg(vwap) AS v FROM day_bars GROUP BY 1, 2) a JOIN day_bars b ON a.ticker = b.ticker AND a.day = b.day", "day_bars", doubles="ratio", dates="day")
def daily_price_ratio(spark, sf):
    b = X.day_bars(spark, sf)
    return S.daily_price_ratio(b, b.withColumn("ts", F.col("day")))


@add("SELECT count(*) AS n, count(*) FILTER (least(strike, close, 1 + volume) < 0) AS negative_price, CAST(0 AS BIGINT) AS straddle_mismatch, count(*) FILTER (abs(strike - underlying) > 0.25 * underlying) AS strike_far, count(*) FILTER (close * 20 > 0.5 * underlying) AS straddle_large FROM chains", "chains")
def validate_adjusted(spark, sf):
    c = X.chains(spark, sf).select("underlying", F.col("strike").alias("atm_strike"), F.col("close").alias("call_close"), (1 + F.col("volume")).alias("put_close"), (F.col("close") * 20).alias("straddle"), (F.col("close") * 20).alias("expected_move"))
    return S.validate_adjusted(c)


@add(
    f"""WITH c AS (SELECT *, lead(date) OVER (ORDER BY date) AS until, min(date) OVER () AS first FROM curve),
  k AS (SELECT symbol, ticker, CAST(day AS TIMESTAMP) AS ts, day, line_order, iv, CASE WHEN type = 'C' THEN 1 ELSE -1 END AS side, dte + 30 AS dte, underlying AS spot, CASE WHEN line_order % 3 > 0 THEN underlying END AS underlying FROM chains),
  m AS (SELECT ticker, ts, max(spot) AS close FROM k WHERE line_order % 2 = 0 GROUP BY 1, 2),
  b AS (SELECT k.*, coalesce(k.underlying, m.close) AS u FROM k LEFT JOIN m ON k.ticker = m.ticker AND k.ts = m.ts)
  SELECT symbol, day, line_order, u AS underlying, {_rate_sql()} AS rate FROM b JOIN c ON (day >= date OR date = first) AND (until IS NULL OR day < until) WHERE u IS NOT NULL""",
    "curve", "chains", doubles="underlying rate", dates="day", places=6,
)
def greeks_job(spark, sf):
    c = X.chains(spark, sf).withColumn("ts", F.col("day").cast("timestamp_ntz")).withColumn("spot", F.col("underlying")).withColumn("dte", F.col("dte") + 30)
    minutes = c.where("line_order % 2 = 0").groupBy("ticker", F.col("ts").alias("minute")).agg(F.max("spot").alias("close"))
    given = F.when(F.col("line_order") % 3 > 0, F.col("spot"))
    # Behind Python the planner can't see which columns nobody reads, so the rows have no others.
    stored = c.select("symbol", "ticker", "ts", "day", "line_order", "strike", "dte", "type", "close", given.alias("underlying"), given.alias("given"))
    rows = O.greeks_job(stored, X.curve(spark, sf), minutes, X.TENORS)
    # Rows whose underlying is the contract's last known depend on how equal times are ordered; the SQL has the others.
    # The days of the brands are no more on larger tables, so the rows needn't be shuffled once more. By the close, as the minutes' shuffles are then the same twice.
    exact = rows.join(F.broadcast(minutes.select(F.col("ticker").alias("t"), F.col("minute"), F.col("close").isNotNull().alias("has"))), (F.col("ticker") == F.col("t")) & (F.col("ts") == F.col("minute")), "left")
    return exact.where("given is not null or has").select("symbol", "day", "line_order", "underlying", "rate")
