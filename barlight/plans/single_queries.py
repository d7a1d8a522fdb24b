"""Queries of operators that other queries use only in passing: each on tables of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.functions import predicates as P
from barlight.functions import scalars as S
from barlight.operators import joins as J
from barlight.operators import options as O
from barlight.operators import signals as G
from barlight.operators import windows as W
from barlight.plans import fixtures as X
from barlight.plans.book import Book
from barlight.plans.market_queries import MIN
from barlight.plans.option_queries import _delta_sql
from barlight.plans.window_queries import EXTRA, PREPARED, SIG, _bars_with_flow, signal_sql

BOOK = Book()
add = BOOK.add


@add("WITH h AS (SELECT DISTINCT ticker, hour(ts) AS slot, count(*) OVER (PARTITION BY ticker, hour(ts)) AS n FROM ticks) SELECT t.ticker, CAST(s AS INTEGER) AS slot, coalesce(h.n, 0) AS n FROM (SELECT DISTINCT ticker FROM ticks) t CROSS JOIN range(24) AS r(s) LEFT JOIN h ON h.ticker = t.ticker AND h.slot = s", "ticks")
def complete_grid(spark, sf):
    n = X.ticks(spark, sf).groupBy("ticker", F.hour("ts").alias("slot")).agg(F.count("*").alias("n"))
    return J.complete_grid(n, "ticker", 24)


@add("SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 9 <> 0 AND c_acctbal >= 0 AND c_nationkey <= 12", doubles="c_acctbal")
def range_filter(spark, sf):
    c = X.read(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")))
    tests = P.range_filter(F.col("c_acctbal"), low=0) & P.range_filter(F.col("c_nationkey"), high=12) & P.range_filter(F.col("c_acctbal"))
    return c.where(tests).select("c_custkey", "c_acctbal")


SPECIAL = "sd AS (SELECT CAST(ts - INTERVAL 5 HOUR AS DATE) AS date, count(*) % 4 AS k FROM events GROUP BY 1 HAVING count(*) % 4 < 2)"


@add(f"""WITH {SPECIAL}, e AS (SELECT event_id, ts, {MIN} AS m, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date FROM events), x AS (SELECT e.*, coalesce(k = 0, false) OR isodow(e.date) > 5 AS closed, CASE WHEN k = 1 THEN 780 ELSE 960 END AS until FROM e LEFT JOIN sd ON e.date = sd.date)
  SELECT event_id, CASE WHEN closed OR m < 240 OR m >= 1200 THEN 'closed' WHEN m < 570 THEN 'pre-market' WHEN m < until THEN 'regular' ELSE 'after-hours' END AS session FROM x""")
def session_label(spark, sf):
    """The calendar: every fourth number of events a day is a holiday's, and every fourth an early close's."""
    e = X.read(spark, sf, "events")
    k = e.groupBy(F.to_date(S.new_york(F.col("ts"))).alias("date")).agg((F.count("*") % 4).alias("k")).where("k < 2")
    calendar = k.select("date", (F.col("k") == 0).alias("closed"), F.when(F.col("k") == 1, 780).alias("early_close"))
    return J.session_labels(e.select("event_id", "ts"), calendar).select("event_id", "session")


@add(f"SELECT ticker, count(*) AS n, sum(size) AS volume FROM (SELECT *, {MIN} AS m FROM ticks) WHERE m >= 570 AND m < 960 GROUP BY 1", "ticks", doubles="volume")
def session_filter(spark, sf):
    return X.ticks(spark, sf).where(S.in_session(F.col("ts"))).groupBy("ticker").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))


@add("SELECT p_partkey, p_size, p_brand FROM part WHERE p_size >= 10 AND p_size < 40 AND right(p_brand, 2) IN ('11', '12', '23', '34') AND p_retailprice > 950")
def compare_filter(spark, sf):
    brands = [f"Brand#{n}" for n in (11, 12, 23, 34)]
    return X.read(spark, sf, "part").where(P.compare_filter(p_size__gte=10, p_size__lt=40, p_brand__any_of=brands, p_retailprice__gt=950)).select("p_partkey", "p_size", "p_brand")


@add("SELECT ticker, day, close AS price, volume, volume / transactions AS rvol FROM day_bars WHERE volume >= 30 AND volume <= 80 AND volume / transactions <= 35", "day_bars", doubles="price volume rvol", dates="day")
def snapshot_filter(spark, sf):
    d = X.day_bars(spark, sf).select("ticker", "day", F.col("close").alias("price"), "volume", (F.col("volume") / F.col("transactions")).alias("rvol"))
    return d.where(P.snapshot_filter({"volume_min": 30, "volume_max": 80, "rvol_max": 35}))


@add("SELECT symbol, ticker, strike FROM contracts c WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = c.p_partkey AND l_quantity > 45)", "contracts", doubles="strike")
def incremental_anti_join(spark, sf):
    return J.incremental_anti_join(X.contracts(spark, sf).select("symbol", "ticker", "strike"), X.chains(spark, sf).where("volume > 45"), "symbol")


CONFIRMED = ("momentum_breakout", "vwap_reversion", "vwap_delta")


def _confirmed_sql(name: str) -> str:
    at = lambda o: f"EXISTS (SELECT 1 FROM {o} o WHERE o.ticker = s.ticker AND o.ts = s.ts AND o.direction = s.direction)"
    return f"SELECT * FROM {name} s WHERE {' OR '.join(at(o) for o in CONFIRMED if o != name)}"


@add(f"""WITH {PREPARED}, {EXTRA}, {', '.join(f'{n} AS ({signal_sql(n)})' for n in CONFIRMED)} {' UNION ALL '.join(_confirmed_sql(n) for n in CONFIRMED)}
  UNION ALL SELECT ticker, day AS ts, NULL AS bar_no, CASE WHEN close > open THEN 1 ELSE -1 END AS direction, 'day' AS strategy, NULL AS stop_abs, NULL AS stop_offset FROM day_bars WHERE CAST(volume > 50 AS INTEGER) + CAST(transactions >= 2 AS INTEGER) + CAST(close > open AND high > 1.5 * low AS INTEGER) >= 2""", "hour_bars", "day_bars", doubles="stop_abs stop_offset", dates="ts")
def confluence_semi_join(spark, sf):
    """Signals of hours that another strategy confirms, each strategy in turn as the primary one, and directions of days that two of three sets confirm."""
    p = G.prepared(_bars_with_flow(spark, sf))
    base = {n: G.REGISTRY[n](p) for n in CONFIRMED}
    hours = [J.confluence_semi_join(base[n], [base[o] for o in CONFIRMED if o != n]) for n in CONFIRMED]
    d = X.day_bars(spark, sf).withColumn("ts", F.col("day").cast("timestamp_ntz")).withColumn("direction", F.when(F.col("close") > F.col("open"), 1).otherwise(-1))
    others = [d.where("volume > 50"), d.where("transactions >= 2").unionByName(d.where("transactions >= 2")), d.where("high > 1.5 * low").withColumn("direction", F.lit(1))]
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    signals = d.select("ticker", "ts", none("bar_no", "int"), "direction", F.lit("day").alias("strategy"), none("stop_abs", "double"), none("stop_offset", "double"))
    rows = J.confluence_semi_join(signals, others, 2).select(*G.SIGNAL)
    for h in hours:
        rows = rows.unionByName(h)
    return rows.withColumn("bar_no", F.col("bar_no").cast("long"))


@add(f"WITH {PREPARED}, {EXTRA}, s1 AS ({signal_sql('vwap_delta')}), s2 AS ({signal_sql('vwap_reversion')}), s3 AS ({signal_sql('momentum_breakout')}) SELECT s1.* REPLACE ('flow_confirmed' AS strategy) FROM s1 WHERE EXISTS (SELECT 1 FROM s2 WHERE s2.ticker = s1.ticker AND s2.ts = s1.ts AND s2.direction = s1.direction) OR EXISTS (SELECT 1 FROM s3 WHERE s3.ticker = s1.ticker AND s3.ts = s1.ts AND s3.direction = s1.direction)", "hour_bars", doubles="stop_abs stop_offset", dates="ts")
def sig_confluence(spark, sf):
    p = G.prepared(_bars_with_flow(spark, sf))
    base = {n: G.REGISTRY[n](p) for n in ("vwap_delta", "vwap_reversion", "momentum_breakout")}
    return G.sig_confluence(base, "flow_confirmed", "vwap_delta", ["vwap_reversion", "momentum_breakout"], 1).withColumn("bar_no", F.col("bar_no").cast("long"))


BAR = ("open", "high", "low", "close", "volume", "vwap", "transactions")
TRADE_COLUMNS = ", ".join(f"{c} AS tr_{c}" for c in BAR)


@add(f"""WITH t AS (SELECT ticker, date_trunc('hour', ts) AS ts, nullif(count(*) FILTER (size > 50), 0) AS n FROM ticks GROUP BY 1, 2), q AS (SELECT ticker, date_trunc('hour', ts) AS ts, avg(ask_price - bid_price) FILTER (bid_size > 2) AS spread, avg(bid_size) AS bid_size, avg(ask_size) AS ask_size, count(*) AS n FROM quotes GROUP BY 1, 2)
  SELECT b.ticker, b.ts, {TRADE_COLUMNS}, t.n AS tr_n, spread AS qu_spread, bid_size AS qu_bid_size, ask_size AS qu_ask_size, q.n AS qu_n FROM hour_bars b LEFT JOIN t ON b.ticker = t.ticker AND b.ts = t.ts LEFT JOIN q ON b.ticker = q.ticker AND b.ts = q.ts
  UNION ALL SELECT ticker, day, {TRADE_COLUMNS}, NULL, NULL, NULL, NULL, NULL FROM day_bars""", "hour_bars", "day_bars", "quotes", doubles=" ".join(f"tr_{c}" for c in BAR[:-1]) + " qu_spread qu_bid_size qu_ask_size", dates="ts", places=6)
def prefix_columns(spark, sf):
    """Bars of hours and of days with every measure of the trades under tr_, those of hours with the quotes' under qu_ as well."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    on, size, spread = ["ticker", "ts"], F.col("size"), F.col("ask_price") - F.col("bid_price")
    large = X.ticks(spark, sf).groupBy("ticker", hour).agg(F.nullif(F.count(F.when(size > 50, 1)), F.lit(0)).alias("n"))
    quoted = X.quotes(spark, sf).groupBy("ticker", hour).agg(F.avg(F.when(F.col("bid_size") > 2, spread)).alias("spread"), F.avg("bid_size").alias("bid_size"), F.avg("ask_size").alias("ask_size"), F.count("*").alias("n"))
    hours = J.prefix_columns(X.hour_bars(spark, sf).select(*on, *BAR).join(large, on, "left"), "tr_").join(J.prefix_columns(quoted, "qu_"), on, "left")
    days = X.day_bars(spark, sf).withColumn("ts", F.col("day").cast("timestamp_ntz")).select(*on, *BAR)
    return hours.unionByName(J.prefix_columns(days, "tr_"), allowMissingColumns=True)


@add("SELECT symbol, day, line_order, close, strike, dte, close > greatest(CASE WHEN type = 'C' THEN underlying - strike ELSE strike - underlying END, 0) AND underlying > 0 AS premium FROM chains WHERE strike IS NOT NULL AND close > 0 AND dte >= 1", "chains", doubles="close strike", dates="day")
def valid_contracts(spark, sf):
    """All rows of chains that are valid, none made invalid on purpose, with whether they have a time premium."""
    premium = (F.col("close") > O.intrinsic(F.col("type"), F.col("underlying"), F.col("strike"))) & (F.col("underlying") > 0)
    return O.valid_contracts(X.chains(spark, sf)).select("symbol", "day", "line_order", "close", "strike", "dte", premium.alias("premium"))


@add("SELECT b.ticker, b.day, b.close, c.chain_rows, c.chain_volume, c.chain_iv FROM day_bars b LEFT JOIN (SELECT CAST(line_order % 13 AS VARCHAR) AS ticker, day, count(*) AS chain_rows, sum(volume) AS chain_volume, avg(iv) AS chain_iv FROM chains GROUP BY 1, 2) c ON b.ticker = c.ticker AND b.day = c.day", "day_bars", "chains", doubles="close chain_volume chain_iv", dates="day")
def chain_day_join(spark, sf):
    chains = X.chains(spark, sf).withColumn("ticker", (F.col("line_order") % 13).cast("string"))
    return J.chain_day_join(X.day_bars(spark, sf).select("ticker", "day", "close"), chains)


#: Kind, delta and name of the volatilities of iv_at_delta.
AT_DELTA = (("P", -0.25, "put_iv"), ("C", 0.25, "call_iv"), ("P", -0.5, "put_iv_50"), ("C", 0.5, "iv_50"))


@add(f"WITH dd AS (SELECT ticker, day, symbol, any_value(type) AS type, avg(iv) AS iv, round(avg(delta), 9) AS delta FROM chains GROUP BY 1, 2, 3), {', '.join(_delta_sql(*x) for x in AT_DELTA)} SELECT * FROM put_iv FULL JOIN call_iv USING (ticker, day) FULL JOIN put_iv_50 USING (ticker, day) FULL JOIN iv_50 USING (ticker, day)", "chains", doubles="put_iv call_iv put_iv_50 iv_50", dates="day")
def iv_at_delta(spark, sf):
    """Both kinds at a quarter's and at a half's delta, of every ticker and day that has either kind. Means of delta that are equal but for their last bits are one."""
    c = X.chains(spark, sf).groupBy("ticker", "day", "symbol").agg(F.first("type").alias("type"), F.avg("iv").alias("iv"), F.round(F.avg("delta"), 9).alias("delta"))
    out, *more = (O.iv_at_delta(c, *x) for x in AT_DELTA)
    for side in more:
        out = out.join(side, ["ticker", "day"], "full")
    return out


@add("WITH a AS (SELECT l_partkey % 50 AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_partkey % 50 AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS n FROM a FULL JOIN b ON a.k = b.k WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)")
def symmetric_difference(spark, sf):
    l = X.read(spark, sf, "lineitem").withColumn("k", F.col("l_partkey") % 50)
    rows = J.symmetric_difference(l.where("l_returnflag = 'R'").select("k"), l.where("l_returnflag = 'A'").select("k"))
    return rows.groupBy("k").agg(F.count("*").alias("n"))


@add("WITH a AS (SELECT l_partkey % 50 AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_partkey % 50 AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) SELECT a.k, least(a.n, b.n) AS n FROM a JOIN b ON a.k = b.k")
def intersect_all(spark, sf):
    l = X.read(spark, sf, "lineitem").withColumn("k", F.col("l_partkey") % 50)
    return l.where("l_returnflag = 'R'").select("k").intersectAll(l.where("l_returnflag = 'A'").select("k")).groupBy("k").agg(F.count("*").alias("n"))


def _spike_close(p):
    """A strategy of a user's: a close beyond the prior range on twice the usual volume."""
    up, down = F.col("close") > F.col("prior_high"), F.col("close") < F.col("prior_low")
    loud = (F.col("bar_no") >= 10) & (F.col("volume") > 1.5 * F.col("prior_avg_volume"))
    rows = p.withColumn("direction", F.when(loud & up, 1).when(loud & down, -1).otherwise(0)).where("direction <> 0")
    stop = F.when(F.col("direction") > 0, F.col("low")).otherwise(F.col("high"))
    return rows.select("ticker", "ts", "bar_no", "direction", F.lit("spike_close").alias("strategy"), stop.alias("stop_abs"), F.lit(None).cast("double").alias("stop_offset"))


@add(f"WITH {PREPARED} {SIG.format(name='spike_close', direction='CASE WHEN bar_no >= 10 AND volume > 1.5 * prior_avg_volume AND close > prior_high THEN 1 WHEN bar_no >= 10 AND volume > 1.5 * prior_avg_volume AND close < prior_low THEN -1 ELSE 0 END', stop_abs='CASE WHEN close > prior_high THEN low ELSE high END', stop_offset='NULL', source='p')}", "hour_bars", doubles="stop_abs stop_offset", dates="ts")
def register_signal(spark, sf):
    G.register_signal("spike_close", _spike_close)
    return G.generate_signals(X.hour_bars(spark, sf), ["spike_close"]).withColumn("bar_no", F.col("bar_no").cast("long"))


@add("SELECT ticker, day, lag(close, 1) OVER w - lag(close, 5) OVER w AS price_move, CASE WHEN count(volume) OVER v = 20 THEN volume / avg(volume) OVER v END AS volume_spike FROM day_bars WINDOW w AS (PARTITION BY ticker ORDER BY day), v AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", "day_bars", doubles="price_move volume_spike", dates="day")
def daily_moves(spark, sf):
    b = X.day_bars(spark, sf).withColumn("ts", F.col("day"))
    return b.select("ticker", "day", W.price_move().alias("price_move"), W.volume_spike(20).alias("volume_spike"))
