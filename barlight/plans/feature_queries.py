"""Queries on daily features, scores, screens, fills and helpers of other operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.functions import scalars as S
from barlight.operators import bars as B
from barlight.operators import features as D
from barlight.operators import joins as J
from barlight.operators import market as M
from barlight.operators import outcomes as T
from barlight.operators import signals as G
from barlight.operators import windows as W
from barlight.plans import fixtures as X
from barlight.plans.book import Book
from barlight.plans.trade_queries import metrics_sql, streak_sql

BOOK = Book()
add = BOOK.add
QUOTE_HOURS = """qh AS (SELECT ticker, date_trunc('hour', ts) AS ts, avg(ask_price - bid_price) AS s, sum(bid_size) AS b, sum(ask_size) AS a, avg(bid_price) AS ab, avg(ask_price) AS aa FROM quotes GROUP BY 1, 2),
  al AS (SELECT h.*, q.s, q.b, q.a, (q.b - q.a) / (q.b + q.a) AS imb, (q.ab + q.aa) / 2 AS mid, (q.ab * q.a + q.aa * q.b) / (q.a + q.b) AS mic FROM hour_bars h LEFT JOIN qh q ON h.ticker = q.ticker AND h.ts = q.ts),
  nb AS (SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts) AS up, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts DESC) AS down FROM al),
  df AS (SELECT ticker, day, count(*) AS n_bars, avg(close * volume) AS dollar_volume, sum(volume) AS total_volume, avg((high - low) / close * 100) AS range_pct, last(close ORDER BY ts) AS last_close, (max(high) FILTER (up <= 5) - min(low) FILTER (up <= 5)) / first(open ORDER BY ts) * 100 AS first_range,
    CASE WHEN count(*) >= 10 THEN avg(s) FILTER (up <= 5) - avg(s) FILTER (down <= 5) END AS contraction, avg(s) AS spread, avg(abs(imb)) AS imbalance_abs, avg(abs(mic - mid) / nullif(mid, 0) * 100) AS micro_mid_abs, avg(b + a) AS depth FROM nb GROUP BY 1, 2 HAVING count(*) >= 10)"""
FEATURES = "n_bars dollar_volume total_volume range_pct last_close first_range contraction spread imbalance_abs micro_mid_abs depth".split()


def _features(spark, sf):
    q = X.quotes(spark, sf).groupBy("ticker", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg(F.col("ask_price") - F.col("bid_price")).alias("avg_spread"), F.sum("bid_size").alias("bid_size"), F.sum("ask_size").alias("ask_size"), F.avg("bid_price").alias("ab"), F.avg("ask_price").alias("aa"))
    b, a = F.col("bid_size"), F.col("ask_size")
    q = q.withColumn("imbalance", (b - a) / (b + a)).withColumn("mid", (F.col("ab") + F.col("aa")) / 2).withColumn("microprice", (F.col("ab") * a + F.col("aa") * b) / (a + b)).drop("ab", "aa")
    return D.daily_features(J.align_feature_bars(X.hour_bars(spark, sf), quote_bars=q), 10, 5)


@add(f"WITH {QUOTE_HOURS} SELECT * FROM df", "hour_bars", "quotes", doubles=" ".join(FEATURES[1:]), dates="day")
def daily_features(spark, sf):
    return _features(spark, sf).select("ticker", "day", *FEATURES)


Z = "(greatest(least(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0), 3), -3) + 3) / 6 * 100"
z = lambda c: Z.format(c=f"coalesce({c}, 0)")
SCORES = f"sc AS (SELECT ticker, day, 0.3 * {z('imbalance_abs')} + 0.25 * {z('micro_mid_abs')} + 0.25 * {z('contraction')} + 0.2 * (100 - {z('spread')}) AS score_quotes, 0.25 * {z('dollar_volume')} + 0.25 * 50 + 0.25 * (100 - {z('spread')}) + 0.25 * {z('depth')} AS score_liquidity, 0.3 * {z('range_pct')} + 0.25 * {z('total_volume')} + 0.2 * {z('last_close')} + 0.25 * {z('first_range')} AS score_volatility FROM df)"


def _scores(spark, sf):
    days = _features(spark, sf).withColumn("atr_pct", F.col("range_pct")).withColumn("rel_vol", F.col("total_volume")).withColumn("return_stdev", F.col("last_close"))
    return G.score(days, ("score_quotes", "score_liquidity", "score_volatility")).select("ticker", "day", "score_quotes", "score_liquidity", "score_volatility")


@add(f"WITH {QUOTE_HOURS}, {SCORES} SELECT * FROM sc", "hour_bars", "quotes", doubles="score_quotes score_liquidity score_volatility", dates="day")
def score_liquidity(spark, sf):
    return _scores(spark, sf)


@add(f"WITH o AS (SELECT ticker, day, close AS delta_abs, open AS aggression, high AS large_ratio, low AS delta_pct_abs, CAST(transactions AS DOUBLE) AS trade_count, volume AS option_volume, vwap AS pcr FROM day_bars) SELECT ticker, day, 0.2 * ({z('delta_abs')}) + 0.2 * ({z('aggression')}) + 0.2 * ({z('large_ratio')}) + 0.2 * ({z('delta_pct_abs')}) + 0.2 * ({z('trade_count')}) AS score_orderflow, 0.15 * ({z('pcr')}) + 0.15 * ({z('option_volume')}) + 0.1 * ({z('delta_abs')}) + 0.15 * ({z('aggression')}) + 0.15 * ({z('large_ratio')}) + 0.15 * ({z('delta_pct_abs')}) AS score_options FROM o", "day_bars", doubles="score_orderflow score_options", dates="day")
def score_orderflow(spark, sf):
    d = X.day_bars(spark, sf).select("ticker", "day", F.col("close").alias("delta_abs"), F.col("open").alias("aggression"), F.col("high").alias("large_ratio"), F.col("low").alias("delta_pct_abs"), F.col("transactions").alias("trade_count"), F.col("volume").alias("option_volume"), F.col("vwap").alias("pcr"), F.col("close").alias("expected_move"), F.col("open").alias("straddle"), F.col("high").alias("gamma_exposure"), F.col("low").alias("iv_skew"))
    return G.score(d, ("score_orderflow", "score_options")).select("ticker", "day", "score_orderflow", "score_options")


@add(f"WITH {QUOTE_HOURS}, {SCORES} SELECT ticker, day, 0.15 * score_liquidity + 0.2 * score_volatility + 0.15 * score_quotes AS opportunity FROM sc", "hour_bars", "quotes", doubles="opportunity", dates="day", places=1)
def opportunity_score(spark, sf):
    s = _scores(spark, sf)
    return s.select("ticker", "day", sum(F.lit(k) * F.col(n) for n, k in G.OPPORTUNITY.items() if n in s.columns).alias("opportunity"))


@add("SELECT ticker, day, (CAST(close > open AS INTEGER) + CAST(high > 1.5 * low AS INTEGER) + CAST(volume > 50 AS INTEGER)) / 3.0 * 100 AS score_cross_market FROM day_bars", "day_bars", doubles="score_cross_market", dates="day")
def score_cross_market(spark, sf):
    return X.day_bars(spark, sf).select("ticker", "day", G.score_cross_market([F.col("close") > F.col("open"), F.col("high") > 1.5 * F.col("low"), F.col("volume") > 50]).alias("score_cross_market"))


@add(f"WITH {QUOTE_HOURS}, {SCORES}, m AS (SELECT ticker, avg(score_quotes) AS q, avg(score_liquidity) AS l, avg(score_volatility) AS v FROM sc GROUP BY 1) SELECT ticker, strategy FROM m, (VALUES ('momentum_breakout', 50, 45, 0), ('vwap_reversion', 0, 50, 0), ('rsi_scalp', 45, 0, 0), ('ema_pullback', 40, 40, 0), ('orb', 55, 0, 0), ('quote_imbalance_breakout', 0, 0, 50), ('liquidity_vacuum', 0, 0, 45)) AS r(strategy, a, b, c) WHERE v >= a AND l >= b AND q >= c", "hour_bars", "quotes")
def select_strategies(spark, sf):
    return D.select_strategies(_scores(spark, sf))


@add("WITH r AS (SELECT *, CAST(ts - INTERVAL 5 HOUR AS DATE) AS day, close / lag(close) OVER (PARTITION BY ticker ORDER BY ts) - 1 AS ret FROM hour_bars) SELECT ticker, day, count(*) AS n_bars, avg(close * volume) AS dollar_volume, sum(volume) AS total_volume, avg((high - low) / close * 100) AS range_pct, stddev_samp(ret) * 100 AS return_stdev, last(close ORDER BY ts) AS last_close FROM r GROUP BY 1, 2 HAVING count(*) >= 10", "hour_bars", doubles="dollar_volume total_volume range_pct return_stdev last_close", dates="day")
def daily_features_et(spark, sf):
    return D.daily_features_et(X.hour_bars(spark, sf))


@add("SELECT coalesce(f.ticker, r.ticker) AS ticker, market_cap, sector, r.exchange FROM (SELECT ticker, market_cap, sector FROM fundamentals) f FULL JOIN (SELECT ticker, exchange FROM fundamentals WHERE market_cap < 8e9) r ON f.ticker = r.ticker WHERE market_cap >= 5e8 AND lower(r.exchange) = lower('Nation_7') OR (market_cap >= 5e8 AND lower(r.exchange) = 'nation_7')", "fundamentals", doubles="market_cap", name="screen_stocks_base")
def screen_stocks_base(spark, sf):
    f = X.fundamentals(spark, sf)
    ref = f.where("market_cap < 8e9").select("ticker", "exchange", F.lit(None).cast("string").alias("sector_industry"))
    return D.screen_stocks(f.select("ticker", "market_cap", "sector"), ref, {"market_cap_min": 5e8, "exchange": "NATION_7"}).select("ticker", "market_cap", "sector", "exchange")


BOOK.queries["screen_stocks"], BOOK.sql["screen_stocks"] = BOOK.queries.pop("screen_stocks_base"), BOOK.sql.pop("screen_stocks_base")


@add("WITH d AS (SELECT *, lag(close) OVER w AS prev_close, lag(volume) OVER w AS prev_volume FROM day_bars WINDOW w AS (PARTITION BY ticker ORDER BY day)) SELECT ticker, day, close AS price, volume, volume / prev_volume AS rvol FROM d WHERE close BETWEEN 100 AND 3000 AND volume / prev_volume >= 1.5", "day_bars", doubles="price volume rvol", dates="day")
def screen_snapshot(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("ticker").orderBy("day")
    d = X.day_bars(spark, sf).withColumn("prev_close", F.lag("close").over(w)).withColumn("prev_volume", F.lag("volume").over(w))
    d = d.select(F.struct("ticker", "day").alias("ticker"), F.col("close").alias("last_price"), "prev_close", F.col("close").alias("day_close"), F.col("volume").alias("day_volume"), "prev_volume")
    return D.screen_snapshot(d, {"price_min": 100, "price_max": 3000, "rvol_min": 1.5}).select("ticker.ticker", "ticker.day", "price", "volume", "rvol")


@add("SELECT c.symbol, c.line_order, c.close, b.close AS underlying FROM (SELECT symbol, line_order, close, CAST(line_order % 10 AS VARCHAR) AS ticker, day FROM chains) c JOIN day_bars b ON c.ticker = b.ticker AND c.day = b.day", "chains", "day_bars", doubles="close underlying", places=6)
def option_underlying_join(spark, sf):
    c = X.chains(spark, sf).select("symbol", "line_order", "close", (F.col("line_order") % 10).cast("string").alias("ticker"), F.col("day").alias("minute"))
    return D.option_underlying_join(c, X.day_bars(spark, sf).withColumnRenamed("day", "minute")).select("symbol", "line_order", "close", "underlying")


@add("WITH b AS (SELECT symbol, day - DATE '1970-01-01' AS minute, max(close) AS high, min(close) AS low, sum(close) AS op, avg(close) AS cl, sum(volume) AS volume FROM chains GROUP BY 1, 2) SELECT symbol, CAST(minute // 30 AS BIGINT) AS bucket, first(op ORDER BY minute) AS open, max(high) AS high, min(low) AS low, last(cl ORDER BY minute) AS close, sum(volume) AS volume FROM b GROUP BY 1, 2", "chains", doubles="open high low close volume")
def option_bars_resample(spark, sf):
    b = X.chains(spark, sf).groupBy("symbol", F.datediff("day", F.lit("1970-01-01")).cast("long").alias("minute")).agg(F.max("close").alias("high"), F.min("close").alias("low"), F.sum("close").alias("open"), F.avg("close").alias("close"), F.sum("volume").alias("volume"))
    return D.option_bars_resample(b, 30)


@add("SELECT s_suppkey, EXISTS (SELECT 1 FROM part WHERE p_size * 2 = s_suppkey) AS found FROM supplier")
def option_ticker_coverage(spark, sf):
    options = X.read(spark, sf, "part").select((F.col("p_size") * 2).cast("string").alias("root"))
    return D.option_ticker_coverage(options, X.fundamentals(spark, sf)).select(F.col("ticker").cast("long").alias("s_suppkey"), "found")


@add("SELECT ticker FROM (SELECT ticker FROM fundamentals WHERE market_cap > 1e9 UNION SELECT ticker FROM fundamentals WHERE exchange LIKE '%3') EXCEPT SELECT ticker FROM day_bars", "fundamentals", "day_bars")
def combined_universe(spark, sf):
    f = X.fundamentals(spark, sf)
    return D.combined_universe([f.where("market_cap > 1e9"), f.where("exchange like '%3'")], X.day_bars(spark, sf))


@add("SELECT ticker, day, close FROM day_bars WHERE CAST(ticker AS INTEGER) % 2 = 1", "day_bars", doubles="close", dates="day")
def exclude_tickers(spark, sf):
    b = X.day_bars(spark, sf).select("ticker", "day", "close")
    return J.exclude_tickers(b, b.where(F.col("ticker").cast("int") % 2 == 0))


@add("SELECT t.ticker, t.day, count(*) AS n FROM trades_log t SEMI JOIN (SELECT ticker, day FROM day_bars WHERE volume > 60) u ON t.ticker = u.ticker AND t.day = u.day GROUP BY 1, 2", "trades_log", "day_bars", dates="day")
def universe_semi_join(spark, sf):
    return J.universe_semi_join(X.trades_log(spark, sf), X.day_bars(spark, sf).where("volume > 60")).groupBy("ticker", "day").agg(F.count("*").alias("n"))


@add("WITH q AS (SELECT quantile_cont(volume, [0.2, 0.4, 0.6, 0.8]) AS c FROM day_bars), d AS (SELECT ticker, day, 1 + len(list_filter(list_distinct(c), lambda e: e < volume)) AS quintile FROM day_bars, q) SELECT CAST(quintile AS INTEGER) AS quintile, count(*) AS n, avg(pnl) AS mean_pnl FROM trades_log t JOIN d ON t.ticker = d.ticker AND t.day = d.day GROUP BY 1", "trades_log", "day_bars", doubles="mean_pnl")
def trades_by_ticker_quantile(spark, sf):
    return J.trades_by_ticker_quantile(X.trades_log(spark, sf), W.quintile(X.day_bars(spark, sf), "volume")).groupBy("quintile").agg(F.count("*").alias("n"), F.avg("pnl").alias("mean_pnl"))


@add("SELECT a.ticker, a.ts, coalesce(b.open, a.open) AS open, coalesce(b.close, a.close) AS close FROM hour_bars a LEFT JOIN (SELECT ticker, ts, vwap AS open, high AS close FROM hour_bars WHERE transactions > 4) b ON a.ticker = b.ticker AND a.ts = b.ts", "hour_bars", doubles="open close", dates="ts")
def bar_override_join(spark, sf):
    b = X.hour_bars(spark, sf)
    return J.bar_override_join(b.where("transactions > 4").select("ticker", "ts", F.col("vwap").alias("open"), F.col("high").alias("close")), b, ("open", "close")).select("ticker", "ts", "open", "close")


@add("SELECT t.ticker, t.sip_ns, coalesce(CASE WHEN t.sequence % 4 = 0 THEN t.price END, m.close) AS underlying FROM ticks t LEFT JOIN (SELECT ticker, date_trunc('minute', ts) AS minute, max(price) AS close FROM ticks GROUP BY 1, 2) m ON t.ticker = m.ticker AND date_trunc('minute', t.ts) = m.minute", "ticks", doubles="underlying")
def minute_backfill_join(spark, sf):
    t = X.ticks(spark, sf)
    m = t.groupBy("ticker", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")).agg(F.max("price").alias("close"))
    rows = t.withColumn("underlying", F.when(F.col("sequence") % 4 == 0, F.col("price")))
    return J.minute_backfill_join(rows, m).select("ticker", "sip_ns", "underlying")


@add("WITH u AS (SELECT t.ticker, t.ts, t.sip_ns, t.exchange, CASE WHEN sequence % 3 = 0 THEN price END AS u FROM ticks t) SELECT ticker, sip_ns, exchange, last_value(u IGNORE NULLS) OVER (PARTITION BY ticker, exchange ORDER BY ts ROWS UNBOUNDED PRECEDING) AS underlying FROM u", "ticks", doubles="underlying")
def contract_underlying_ffill(spark, sf):
    t = X.ticks(spark, sf)
    minutes = t.where("sequence % 3 = 0").select("ticker", "ts", F.col("price").alias("close"))
    rows = t.withColumn("contract", F.concat_ws("-", "ticker", "exchange"))
    return J.contract_underlying_ffill(rows, minutes).select("ticker", "sip_ns", "exchange", "underlying")


@add("WITH t AS (SELECT ticker, ts AS entry_ts, ts + INTERVAL 3 HOUR AS exit_ts, close - open AS pnl FROM hour_bars) SELECT t.ticker, t.entry_ts, t.pnl - coalesce((a.ask_price - a.bid_price) / 2, 0) - coalesce((b.ask_price - b.bid_price) / 2, 0) AS adjusted_pnl FROM t ASOF LEFT JOIN quotes a ON t.ticker = a.ticker AND t.entry_ts >= a.ts ASOF LEFT JOIN quotes b ON t.ticker = b.ticker AND t.exit_ts >= b.ts", "hour_bars", "quotes", doubles="adjusted_pnl", dates="entry_ts", places=6)
def spread_adjusted_pnl(spark, sf):
    t = X.hour_bars(spark, sf).select("ticker", F.col("ts").alias("entry_ts"), F.expr("ts + interval 3 hour").alias("exit_ts"), (F.col("close") - F.col("open")).alias("pnl"))
    return D.spread_adjusted_pnl(t, X.quotes(spark, sf)).select("ticker", "entry_ts", "adjusted_pnl")


@add("SELECT sip_ns, ticker FROM ticks WHERE size >= 50 AND price IS NOT NULL", "ticks")
def valid_trades(spark, sf):
    t = X.ticks(spark, sf)
    return B.valid_trades(t.withColumn("size", F.when(F.col("size") >= 50, F.col("size")))).select("sip_ns", "ticker")


@add("SELECT sip_ns, ticker FROM quotes WHERE bid_size > 3", "quotes")
def valid_quotes(spark, sf):
    return B.valid_quotes(X.quotes(spark, sf).withColumn("bid_size", F.when(F.col("bid_size") > 3, F.col("bid_size")))).select("sip_ns", "ticker")


@add("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS x, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS n FROM events", doubles="x")
def to_number(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, F.element_at(F.array(*map(F.lit, ("", "NaN", "Infinity", "bad"))), (F.col("event_id") % 4 + 1).cast("int"))).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return X.read(spark, sf, "events").select("event_id", S.to_number(text).alias("x"), S.to_int(text).alias("n"))


@add("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE epoch_us(ts) // 1000000 - 28800 END AS s FROM events")
def naive_ts_to_utc(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return X.read(spark, sf, "events").select("event_id", F.unix_seconds(S.naive_ts_to_utc(F.when(F.col("event_id") % 2 == 0, F.concat(text, F.lit("+00:00"))).otherwise(text))).alias("s"))


@add("SELECT CASE WHEN m < 240 THEN 'Other' WHEN m < 570 THEN 'Pre-Market' WHEN m < 600 THEN 'Open' WHEN m < 690 THEN 'Mid-Morning' WHEN m < 720 THEN 'Late Morning' WHEN m < 810 THEN 'Lunch' WHEN m < 900 THEN 'Early Afternoon' WHEN m < 930 THEN 'Late Afternoon' WHEN m < 960 THEN 'Close' ELSE 'Other' END AS part, count(*) AS n, avg(price) AS mean_price, stddev_pop(price) AS sd FROM (SELECT *, extract(hour FROM ts - INTERVAL 5 HOUR) * 60 + extract(minute FROM ts) AS m FROM ticks) GROUP BY 1 HAVING count(*) >= 3", "ticks", doubles="mean_price sd")
def by_time_of_day(spark, sf):
    return X.ticks(spark, sf).groupBy(S.time_zone_bucket(F.col("ts")).alias("part")).agg(F.count("*").alias("n"), F.avg("price").alias("mean_price"), F.stddev_pop("price").alias("sd")).where("n >= 3")


@add("SELECT strategy, count(*) AS n, count(DISTINCT ticker) AS tickers, sum(pnl) AS total, max(pnl) AS best, min(pnl) AS worst FROM trades_log GROUP BY 1", "trades_log", doubles="total best worst", places=2)
def performance_summary(spark, sf):
    return X.trades_log(spark, sf).groupBy("strategy").agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"), F.sum("pnl").alias("total"), F.max("pnl").alias("best"), F.min("pnl").alias("worst"))


@add("WITH e AS (SELECT strategy, day, sum(pnl) AS pnl FROM trades_log GROUP BY 1, 2), c AS (SELECT *, 1e8 + sum(pnl) OVER (PARTITION BY strategy ORDER BY day) AS eq FROM e), h AS (SELECT *, greatest(max(eq) OVER (PARTITION BY strategy ORDER BY day), 1e8) AS top FROM c) SELECT strategy, max((top - eq) / top * 100) AS max_drawdown, avg((top - eq) / top * 100) AS mean_drawdown FROM h GROUP BY 1", "trades_log", doubles="max_drawdown mean_drawdown")
def drawdown_summary(spark, sf):
    days = X.trades_log(spark, sf).groupBy("strategy", "day").agg(F.sum("pnl").alias("pnl"))
    return W.equity(days, ["strategy"], ["day"], "pnl", 1e8).groupBy("strategy").agg(F.max("drawdown").alias("max_drawdown"), F.avg("drawdown").alias("mean_drawdown"))


@add("SELECT p_partkey, p_name, p_brand, coalesce(p_type, '') AS p_type, p_size FROM part")
def reference_extract(spark, sf):
    return X.read(spark, sf, "part").select("p_partkey", "p_name", "p_brand", F.coalesce("p_type", F.lit("")).alias("p_type"), "p_size")


@add("SELECT CAST(s_suppkey AS VARCHAR) AS ticker, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal * 2 ELSE s_acctbal END AS market_cap, CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 1 ELSE s_suppkey + 2 END AS DOUBLE) AS shares_outstanding, CASE WHEN s_nationkey = 0 THEN NULL ELSE s_acctbal / s_nationkey END AS book_value FROM supplier", doubles="market_cap shares_outstanding book_value")
def fundamentals_build(spark, sf):
    s = X.read(spark, sf, "supplier").withColumn("ticker", F.col("s_suppkey").cast("string"))
    k = F.col("s_suppkey")
    ratios = s.select("ticker", F.when(k % 3 != 0, F.col("s_acctbal")).alias("ratio_market_cap"), F.col("s_acctbal").alias("price"), F.col("s_nationkey").cast("double").alias("price_to_book"))
    details = s.select("ticker", (F.col("s_acctbal") * 2).alias("detail_market_cap"), F.when(k % 2 == 0, k + 1.0).alias("weighted_shares"), (k + 2.0).alias("class_shares"))
    return M.fundamentals_build(ratios, details)


@add("SELECT g, ticker, weight, CASE WHEN c IS NULL THEN 0 ELSE c END AS change_pct FROM (SELECT f.ticker, f.exchange AS g, market_cap / 1e9 AS weight, round((close - open) / open * 100, 2) AS c FROM fundamentals f LEFT JOIN (SELECT * FROM day_bars WHERE day = DATE '1998-06-01') b ON f.ticker = b.ticker)", "fundamentals", "day_bars", doubles="weight change_pct")
def sector_change(spark, sf):
    groups = X.fundamentals(spark, sf).select("ticker", F.col("exchange").alias("sic_group"), (F.col("market_cap") / 1e9).alias("weight"))
    snaps = M.grouped_daily(X.day_bars(spark, sf), "1998-06-01").select("ticker", ((F.col("close") - F.col("open")) / F.col("open") * 100).alias("change_pct"))
    return M.sector_change(snaps, groups).select(F.col("sic_group").alias("g"), F.explode("tickers").alias("t")).select("g", "t.*")


@add("SELECT event_type AS ticker, max(value * 0.99) AS best_bid, min(value * 1.01 + 500) AS best_ask, min(value * 1.01 + 500) - max(value * 0.99) AS spread, count(*) AS bid_levels, count(*) AS ask_levels FROM events GROUP BY 1", doubles="best_bid best_ask spread")
def order_book_l2(spark, sf):
    level = lambda p: F.array(F.struct(p.alias("price"), F.create_map(F.col("user_id").cast("string"), F.col("value")).alias("x")))
    books = X.read(spark, sf, "events").select(F.col("event_type").alias("ticker"), level(F.col("value") * 0.99).alias("bids"), level(F.col("value") * 1.01 + 500).alias("asks"))
    return M.order_book_l2(M.order_book_levels(books))


@add("SELECT symbol, strike, type, max(day) AS day, last(close ORDER BY day, line_order, close) AS close, last(CASE WHEN type = 'C' THEN strike + close ELSE strike - close END ORDER BY day, line_order, close) AS break_even FROM chains WHERE ticker = 'Brand#1' AND strike BETWEEN 920 AND 980 GROUP BY 1, 2, 3", "chains", doubles="strike close break_even", dates="day")
def option_chain(spark, sf):
    c = X.chains(spark, sf).where((F.col("ticker") == "Brand#1") & F.col("strike").between(920, 980)).withColumn("at", F.struct("day", "line_order", "close"))
    last = M.latest(c, ["symbol", "strike", "type"], "at", ["close"]).withColumn("day", F.col("at.day")).drop("at")
    return last.withColumn("break_even", F.when(F.col("type") == "C", F.col("strike") + F.col("close")).otherwise(F.col("strike") - F.col("close")))


@add("WITH t AS (SELECT strategy, count(*) AS n, sum(pnl) AS a, sum(pnl - tax * price) AS b FROM trades_log GROUP BY 1) SELECT strategy, n, a AS before_pnl, b AS after_pnl, b - a AS change FROM t", "trades_log", doubles="before_pnl after_pnl change", places=2)
def before_after(spark, sf):
    t = X.trades_log(spark, sf)
    a = t.groupBy("strategy").agg(F.count("*").alias("n"), F.sum("pnl").alias("before_pnl"))
    b = t.groupBy("strategy").agg(F.sum(F.col("pnl") - F.col("tax") * F.col("price")).alias("after_pnl"))
    return a.join(b, "strategy").withColumn("change", F.col("after_pnl") - F.col("before_pnl"))


def _stock_metrics(spark, sf):
    return T.trade_metrics(X.trades_log(spark, sf), ["ticker", "strategy", "rr_ratio"], X.LOG_ORDER)


@add(f"""WITH {streak_sql("ticker, strategy, rr_ratio")}, g AS (SELECT ticker, strategy, rr_ratio, {metrics_sql()} FROM trades_log GROUP BY ALL), m AS (SELECT g.*, 3 * profit_factor + 2 * coalesce(sharpe, 0) - 0.1 * coalesce(max_losing_streak, 0) + coalesce(win_rate, 0) / 50 AS composite, row_number() OVER (PARTITION BY ticker ORDER BY profit_factor DESC, strategy, rr_ratio) AS k FROM g LEFT JOIN st USING (ticker, strategy, rr_ratio)),
  v AS (SELECT ticker, avg(volume / 10) AS score_liquidity FROM day_bars GROUP BY 1) SELECT m.ticker, strategy, rr_ratio, profit_factor, composite, score_liquidity FROM m LEFT JOIN v ON m.ticker = v.ticker WHERE k = 1""", "trades_log", "day_bars", doubles="rr_ratio profit_factor composite score_liquidity", places=3)
def stock_leaderboard(spark, sf):
    scores = X.day_bars(spark, sf).select("ticker", (F.col("volume") / 10).alias("score_liquidity"))
    return D.stock_leaderboard(_stock_metrics(spark, sf), scores).select("ticker", "strategy", "rr_ratio", "profit_factor", "composite", "score_liquidity")


@add("SELECT ticker, day AS date, next AS new_ticker FROM (SELECT ticker, execution_date AS day, ticker || '-' || id AS next FROM splits)", "splits", dates="date")
def ticker_history(spark, sf):
    from barlight.sources.tables import corporate_actions_build

    s = X.splits(spark, sf).groupBy("ticker").agg(F.collect_list(F.struct(F.col("execution_date").alias("date"), F.concat_ws("-", "ticker", "id").alias("ticker"))).alias("events"))
    return corporate_actions_build(s).orderBy("ticker", "date")
