"""Queries on rolling measures, signals and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.operators import joins as J
from barlight.operators import scans
from barlight.operators import signals as G
from barlight.operators import windows as W
from barlight.plans import fixtures as X
from barlight.plans.book import Book

BOOK = Book()
add = BOOK.add
W_ = "OVER (PARTITION BY ticker ORDER BY ts"
PLAIN = f"""b AS (SELECT *, row_number() {W_}) - 1 AS bar_no, lag(close) {W_}) AS pc FROM hour_bars)"""


def gate(agg: str, x: str, first: int, last: int, n: int) -> str:
    frame = f"{W_} ROWS BETWEEN {-first} PRECEDING AND {f'{-last} PRECEDING' if last else 'CURRENT ROW'})"
    return f"CASE WHEN count({x}) {frame} = {n} THEN {agg}({x}) {frame} END"


@add(f"WITH {PLAIN} SELECT ticker, ts, bar_no, close / pc - 1 AS ret, ln(close / pc) AS log_ret, high - low AS bar_range FROM b", "hour_bars", doubles="ret log_ret bar_range", dates="ts")
def returns(spark, sf):
    return X.hour_bars(spark, sf).select("ticker", "ts", W.bar_number().cast("long").alias("bar_no"), W.returns().alias("ret"), W.log_returns().alias("log_ret"), W.bar_range().alias("bar_range"))


@add(f"WITH {PLAIN}, t AS (SELECT *, coalesce(greatest(high - low, abs(high - pc), abs(low - pc)), high - low) AS tr FROM b) SELECT ticker, ts, tr AS true_range, {gate('avg', 'tr', -13, 0, 14)} AS atr FROM t", "hour_bars", doubles="true_range atr", dates="ts")
def atr(spark, sf):
    return W.with_atr(X.hour_bars(spark, sf)).select("ticker", "ts", "true_range", "atr")


CHANGE = "t AS (SELECT *, coalesce(close - pc, 0) AS ch FROM b), g AS (SELECT *, greatest(ch, 0) AS up, greatest(-ch, 0) AS down FROM t)"


def rsi_sql(n: int) -> str:
    return f"r AS (SELECT *, {gate('avg', 'up', -(n - 1), 0, n)} AS g, {gate('avg', 'down', -(n - 1), 0, n)} AS l FROM g), rs AS (SELECT *, CASE WHEN g IS NOT NULL THEN 100 - 100 / (1 + CASE WHEN l > 0 THEN g / l ELSE 0 END) END AS rsi FROM r)"


@add(f"WITH {PLAIN}, {CHANGE}, {rsi_sql(14)} SELECT ticker, ts, rsi FROM rs", "hour_bars", doubles="rsi", dates="ts")
def rsi(spark, sf):
    return W.with_rsi(X.hour_bars(spark, sf)).select("ticker", "ts", "rsi")


@add(f"WITH {PLAIN}, v AS (SELECT ticker, ts, volume, {gate('avg', 'volume', -19, 0, 20)} AS volume_ma, close / pc - 1 AS r FROM b) SELECT ticker, ts, volume_ma, volume / volume_ma AS rel_vol, {gate('stddev_samp', 'r', -19, 0, 20)} AS return_stdev FROM v", "hour_bars", doubles="volume_ma rel_vol return_stdev", dates="ts")
def rel_vol(spark, sf):
    return W.with_return_stdev(W.with_volume_ma(X.hour_bars(spark, sf))).select("ticker", "ts", "volume_ma", "rel_vol", "return_stdev")


@add("WITH s AS (SELECT ticker, ts, close, sum(close * volume) OVER w / sum(volume) OVER w AS session_vwap FROM hour_bars WINDOW w AS (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts)) SELECT ticker, ts, session_vwap, (close - session_vwap) / session_vwap * 100 AS vwap_dist_pct FROM s", "hour_bars", doubles="session_vwap vwap_dist_pct", dates="ts", places=6)
def session_vwap(spark, sf):
    return W.with_session_vwap(X.hour_bars(spark, sf)).select("ticker", "ts", "session_vwap", "vwap_dist_pct")


ROLL = f"CASE WHEN count(close) {W_} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) = 20 THEN sum(close * volume) {W_} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) / (sum(volume) {W_} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) + 1e-9) END"
PREPARED = f"""{PLAIN}, {CHANGE}, {rsi_sql(5)}, m AS (SELECT *, abs(close - pc) AS mv FROM rs),
  p0 AS (SELECT *, {gate('max', 'high', -5, -1, 5)} AS prior_high, {gate('min', 'low', -5, -1, 5)} AS prior_low, {gate('avg', 'volume', -5, -1, 5)} AS prior_avg_volume, {gate('avg', 'mv', -9, -1, 9).replace('9 PRECEDING AND', '10 PRECEDING AND').replace('10 PRECEDING AND 1', '9 PRECEDING AND 1')} AS atr10, {ROLL} AS vwap20,
    volume / {gate('avg', 'volume', -49, 0, 50)} AS spike, lag(close, 1) {W_}) - lag(close, 5) {W_}) AS move, {gate('avg', '(high - low)', -19, 0, 20)} AS range20, lag(rsi) {W_}) AS rsi_before FROM m),
  p AS (SELECT *, (close - vwap20) / vwap20 * 100 AS dev FROM p0)"""


@add(f"WITH {PREPARED} SELECT ticker, ts, prior_high, prior_low, prior_avg_volume, atr10 AS local_atr, vwap20 AS rolling_vwap, spike AS volume_spike, move AS price_move FROM p", "hour_bars", doubles="prior_high prior_low prior_avg_volume local_atr rolling_vwap volume_spike price_move", dates="ts")
def rolling_vwap(spark, sf):
    return G.prepared(X.hour_bars(spark, sf)).select("ticker", "ts", "prior_high", "prior_low", "prior_avg_volume", F.col("atr10").alias("local_atr"), F.col("vwap20").alias("rolling_vwap"), F.col("spike").alias("volume_spike"), F.col("move").alias("price_move"))


@add(f"SELECT ticker, ts, {gate('avg', 'close', -19, 0, 20)} AS sma FROM hour_bars", "hour_bars", doubles="sma", dates="ts")
def sma(spark, sf):
    return X.hour_bars(spark, sf).select("ticker", "ts", W.sma().alias("sma"))


def ema_cte(name: str, source: str, column: str, span: int) -> str:
    a = 2 / (span + 1)
    return f"{name} AS (SELECT ticker, ts, n, CAST({column} AS DOUBLE) AS e FROM {source} WHERE n = 1 UNION ALL SELECT s.ticker, s.ts, s.n, {a!r} * s.{column} + (1 - {a!r}) * e FROM {name} x JOIN {source} s ON s.ticker = x.ticker AND s.n = x.n + 1)"


NUMBERED = "num AS (SELECT ticker, ts, close, row_number() OVER (PARTITION BY ticker ORDER BY ts) AS n FROM hour_bars)"


@add(f"WITH RECURSIVE_MARK {NUMBERED}, {ema_cte('ex', 'num', 'close', 20)} SELECT ticker, ts, e AS ema FROM ex", "hour_bars", doubles="ema", dates="ts")
def ema(spark, sf):
    return W.with_ema(X.hour_bars(spark, sf), {"ema": 20}).select("ticker", "ts", "ema")


@add(f"WITH RECURSIVE_MARK {NUMBERED}, {ema_cte('xs', 'num', 'close', 12)}, {ema_cte('xl', 'num', 'close', 26)}, md AS (SELECT xs.ticker, xs.ts, xs.n, xs.e - xl.e AS v FROM xs JOIN xl ON xs.ticker = xl.ticker AND xs.n = xl.n), {ema_cte('xg', 'md', 'v', 9)} SELECT md.ticker, md.ts, v AS macd, e AS macd_signal, v - e AS macd_histogram FROM md JOIN xg ON md.ticker = xg.ticker AND md.n = xg.n", "hour_bars", doubles="macd macd_signal macd_histogram", dates="ts")
def macd(spark, sf):
    return W.with_macd(X.hour_bars(spark, sf)).select("ticker", "ts", "macd", "macd_signal", "macd_histogram")


@add("SELECT ticker, CAST(ts AS DATE) AS day, max(high) AS or_high, min(low) AS or_low, max(ts) AS or_end FROM (SELECT *, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts) AS n FROM hour_bars) WHERE n <= 5 GROUP BY 1, 2", "hour_bars", doubles="or_high or_low", dates="day or_end")
def opening_range(spark, sf):
    return W.opening_range(X.hour_bars(spark, sf), 5)


@add("SELECT ticker, ts, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts DESC) AS n FROM hour_bars) WHERE n <= 3", "hour_bars", doubles="close", dates="ts")
def last_n_of_day(spark, sf):
    return W.of_day(X.hour_bars(spark, sf), last=3).select("ticker", "ts", "close")


@add("SELECT ticker, ts, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts) AS n FROM hour_bars) WHERE n <= 3", "hour_bars", doubles="close", dates="ts")
def first_n_of_day(spark, sf):
    return W.of_day(X.hour_bars(spark, sf), first=3).select("ticker", "ts", "close")


@add("SELECT ticker, sip_ns, sum(size * side) OVER (PARTITION BY ticker ORDER BY sip_ns, sequence) AS cumulative_delta FROM (SELECT *, coalesce(sign(price - lag(price) OVER (PARTITION BY ticker ORDER BY sip_ns, sequence)), 0) AS side FROM ticks)", "ticks", doubles="cumulative_delta")
def cumulative_delta(spark, sf):
    return scans.cumulative_delta(X.ticks(spark, sf)).select("ticker", "sip_ns", "cumulative_delta")


@add("WITH s AS (SELECT avg(close) AS m, stddev_samp(close) AS d, avg(volume) AS mv, stddev_samp(volume) AS dv FROM day_bars) SELECT ticker, day, (greatest(least((close - m) / d, 3), -3) + 3) / 6 * 100 AS z_close, (greatest(least((volume - mv) / dv, 3), -3) + 3) / 6 * 100 AS z_volume FROM day_bars, s", "day_bars", doubles="z_close z_volume", dates="day")
def zscore_0_100(spark, sf):
    return W.zscore_0_100(X.day_bars(spark, sf), {"z_close": "close", "z_volume": "volume"}).select("ticker", "day", "z_close", "z_volume")


@add("SELECT ticker, day, greatest(least(coalesce((close - avg(close) OVER w) / nullif(stddev_samp(close) OVER w, 0), 0), 3), -3) AS z FROM day_bars WINDOW w AS (PARTITION BY day)", "day_bars", doubles="z", dates="day")
def zscore_clip(spark, sf):
    return X.day_bars(spark, sf).select("ticker", "day", W.zscore_clip("close", "day").alias("z"))


@add("""WITH a AS (SELECT ticker, day, transactions, close, CASE WHEN count(*) OVER w = 5 THEN avg(transactions) OVER w END AS avg_trades, CASE WHEN count(*) OVER w = 5 THEN stddev_samp(transactions) OVER w END AS std_trades, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS before FROM day_bars WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
  z AS (SELECT ticker, day, transactions, close, avg_trades, std_trades, (close - before) / before * 100 AS price_diff, (transactions - avg_trades) / nullif(std_trades, 0) AS z FROM a) SELECT * FROM z WHERE z > 3.03""", "day_bars", doubles="close avg_trades std_trades price_diff z", dates="day", places=6)
def trade_count_anomaly(spark, sf):
    return W.trade_count_anomaly(X.day_bars(spark, sf), above=3.03)


@add("SELECT ticker, day, CASE WHEN count(close) OVER w >= 5 THEN avg(close) OVER w END AS m FROM day_bars WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)", "day_bars", doubles="m", dates="day")
def lookback_mean(spark, sf):
    days = X.day_bars(spark, sf)
    return days.select("ticker", "day", W.lookback_mean(days, "close").alias("m"))


@add("""WITH l AS (SELECT ticker, day, CASE WHEN count(dv) OVER w >= 5 THEN avg(dv) OVER w END AS dv, CASE WHEN count(volume) OVER w >= 5 THEN avg(volume) OVER w END AS v, CASE WHEN count(rp) OVER w >= 5 THEN avg(rp) OVER w END AS rp FROM (SELECT *, close * volume AS dv, (high - low) / close * 100 AS rp FROM day_bars) WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
  s AS (SELECT ticker, day, 0.4 * greatest(least(coalesce((dv - avg(dv) OVER d) / nullif(stddev_samp(dv) OVER d, 0), 0), 3), -3) + 0.3 * greatest(least(coalesce((v - avg(v) OVER d) / nullif(stddev_samp(v) OVER d, 0), 0), 3), -3) + 0.3 * greatest(least(coalesce((rp - avg(rp) OVER d) / nullif(stddev_samp(rp) OVER d, 0), 0), 3), -3) AS score FROM l WHERE dv IS NOT NULL WINDOW d AS (PARTITION BY day))
  SELECT ticker, day, score, CAST("rank" AS INTEGER) AS "rank" FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, ticker) AS "rank" FROM s) WHERE "rank" <= 3""", "day_bars", doubles="score", dates="day")
def rank_universe(spark, sf):
    days = X.day_bars(spark, sf).withColumn("dollar_volume", F.col("close") * F.col("volume")).withColumn("total_volume", F.col("volume")).withColumn("range_pct", (F.col("high") - F.col("low")) / F.col("close") * 100)
    return G.rank_universe(days, 3)


@add("""WITH q AS (SELECT quantile_cont(volume, [0.2, 0.4, 0.6, 0.8]) AS c FROM day_bars) SELECT ticker, day, 1 + len(list_filter(list_distinct(c), lambda e: e < volume)) AS quintile FROM day_bars, q""", "day_bars", dates="day")
def quintile(spark, sf):
    return W.quintile(X.day_bars(spark, sf), "volume").select("ticker", "day", F.col("quintile").cast("long").alias("quintile"))


@add("""WITH t AS (SELECT *, l.result <> 'win' AS flag, row_number() OVER (PARTITION BY strategy, rr_ratio ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_suppkey, price) AS n FROM trades_log l),
  i AS (SELECT *, n - row_number() OVER (PARTITION BY strategy, rr_ratio, flag ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_suppkey, price) AS island FROM t), r AS (SELECT strategy, rr_ratio, island, count(*) AS run FROM i WHERE flag GROUP BY 1, 2, 3)
  SELECT strategy, rr_ratio, max(run) AS longest FROM r GROUP BY 1, 2""", "trades_log", doubles="rr_ratio")
def streaks(spark, sf):
    return W.streaks(X.trades_log(spark, sf), ["strategy", "rr_ratio"], X.LOG_ORDER, F.col("result") != "win", "longest")


@add("""WITH e AS (SELECT ticker, day, sum(pnl) AS pnl FROM trades_log GROUP BY 1, 2), c AS (SELECT *, sum(pnl) OVER (PARTITION BY ticker ORDER BY day) AS running_pnl FROM e)
  SELECT ticker, day, running_pnl, 1e6 + running_pnl AS equity, (greatest(max(1e6 + running_pnl) OVER (PARTITION BY ticker ORDER BY day), 1e6) - (1e6 + running_pnl)) / greatest(max(1e6 + running_pnl) OVER (PARTITION BY ticker ORDER BY day), 1e6) * 100 AS drawdown FROM c""", "trades_log", doubles="running_pnl equity drawdown", dates="day", places=4)
def equity_curve(spark, sf):
    days = X.trades_log(spark, sf).groupBy("ticker", "day").agg(F.sum("pnl").alias("pnl"))
    return W.equity(days, ["ticker"], ["day"], "pnl", 1e6).drop("pnl")

SIG = "SELECT ticker, ts, bar_no, CAST(direction AS INTEGER) AS direction, strategy, stop_abs, stop_offset FROM (SELECT ticker, ts, bar_no, {direction} AS direction, '{name}' AS strategy, CAST({stop_abs} AS DOUBLE) AS stop_abs, CAST({stop_offset} AS DOUBLE) AS stop_offset FROM {source}) WHERE direction <> 0"
HIT = "bar_no >= 10 AND high > prior_high AND volume > 1.2 * prior_avg_volume"
SIGNALS = {
    "momentum_breakout": dict(direction=f"CASE WHEN {HIT} THEN 1 ELSE 0 END", stop_abs="prior_low", stop_offset="NULL", source="p"),
    "vwap_reversion": dict(direction="CASE WHEN bar_no >= 25 AND dev > 0.3 THEN -1 WHEN bar_no >= 25 AND dev < -0.3 THEN 1 ELSE 0 END", stop_abs="NULL", stop_offset="2 * atr10", source="p"),
    "rsi_scalp": dict(direction="CASE WHEN bar_no >= 15 AND rsi_before < 30 AND rsi >= 30 THEN 1 WHEN bar_no >= 15 AND rsi_before > 70 AND rsi <= 70 THEN -1 ELSE 0 END", stop_abs="NULL", stop_offset="2 * atr10", source="p"),
    "liquidity_vacuum": dict(direction="CASE WHEN bar_no >= 55 AND spike >= 2.5 AND high - low < 0.7 * range20 THEN -sign(move) ELSE 0 END", stop_abs="NULL", stop_offset="1.5 * atr10", source="p"),
    "delta_breakout": dict(direction=f"CASE WHEN {HIT} AND (delta IS NULL OR delta > 0) THEN 1 ELSE 0 END", stop_abs="prior_low", stop_offset="NULL", source="pd"),
    "quote_imbalance_breakout": dict(direction=f"CASE WHEN {HIT} AND (imbalance IS NULL OR imbalance > 0) THEN 1 ELSE 0 END", stop_abs="prior_low", stop_offset="NULL", source="pd"),
    "vwap_delta": dict(direction="CASE WHEN bar_no >= 25 AND dev > 0.3 AND delta < 0 THEN -1 WHEN bar_no >= 25 AND dev < -0.3 AND delta > 0 THEN 1 ELSE 0 END", stop_abs="NULL", stop_offset="2 * atr10", source="pd"),
}
EXTRA = "fl AS (SELECT ticker, date_trunc('hour', ts) AS ts, sum(CASE WHEN sequence % 3 = 0 THEN size ELSE -size / 2 END) AS delta, CASE WHEN sum(exchange) % 5 = 0 THEN NULL ELSE avg(exchange) - 7.5 END AS imbalance FROM ticks GROUP BY 1, 2), pd AS (SELECT p.*, fl.delta, fl.imbalance FROM p LEFT JOIN fl ON p.ticker = fl.ticker AND p.ts = fl.ts)"


def signal_sql(name: str) -> str:
    return SIG.format(name=name, **SIGNALS[name])


def _bars_with_flow(spark, sf):
    """Hourly bars with a made-up delta and imbalance from the ticks of the hour."""
    i = F.col("sequence")
    flow = X.ticks(spark, sf).groupBy("ticker", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.sum(F.when(i % 3 == 0, F.col("size")).otherwise(-F.col("size") / 2)).alias("delta"), F.when(F.sum("exchange") % 5 != 0, F.avg("exchange") - 7.5).alias("imbalance"))
    return X.hour_bars(spark, sf).join(flow, ["ticker", "ts"], "left")


def _signal(name: str):
    def run(spark, sf):
        return G.REGISTRY[name](G.prepared(_bars_with_flow(spark, sf))).withColumn("bar_no", F.col("bar_no").cast("long"))

    return run


for _n in SIGNALS:
    add(f"WITH {PREPARED}, {EXTRA} {signal_sql(_n)}", "hour_bars", doubles="stop_abs stop_offset", dates="ts", name=f"sig_{_n}")(_signal(_n))

add(f"""WITH {PREPARED}, orr AS (SELECT ticker, CAST(ts AS DATE) AS day, max(high) AS or_high, min(low) AS or_low, max(ts) AS or_end FROM (SELECT *, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts) AS n FROM hour_bars) WHERE n <= 5 GROUP BY 1, 2),
  o AS (SELECT p.*, or_high, or_low FROM p JOIN orr r ON p.ticker = r.ticker AND CAST(p.ts AS DATE) = r.day AND p.ts > or_end) {SIG.format(name='orb', direction='CASE WHEN high > or_high THEN 1 WHEN low < or_low THEN -1 ELSE 0 END', stop_abs='CASE WHEN high > or_high THEN or_low ELSE or_high END', stop_offset='NULL', source='o')}""", "hour_bars", doubles="stop_abs stop_offset", dates="ts", name="sig_orb")(_signal("orb"))

add(f"""WITH RECURSIVE_MARK {PREPARED}, {NUMBERED}, {ema_cte('ex', 'num', 'close', 20)}, q AS (SELECT p.*, {gate('avg', 'mv', -13, -1, 13)} AS atr14, e, e - lag(e, 5) OVER (PARTITION BY p.ticker ORDER BY p.ts) AS trend, (close - e) / e * 100 AS near, min(low) OVER (PARTITION BY p.ticker ORDER BY p.ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS low3, max(high) OVER (PARTITION BY p.ticker ORDER BY p.ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS high3 FROM p JOIN ex USING (ticker, ts))
  {SIG.format(name='ema_pullback', direction='CASE WHEN bar_no >= 40 AND trend > 0 AND near > -0.2 AND near < 0.15 THEN 1 WHEN bar_no >= 40 AND trend < 0 AND near > -0.15 AND near < 0.2 THEN -1 ELSE 0 END', stop_abs='CASE WHEN trend > 0 THEN low3 - 0.5 * atr14 ELSE high3 + 0.5 * atr14 END', stop_offset='NULL', source='q')}""", "hour_bars", doubles="stop_abs stop_offset", dates="ts", name="sig_ema_pullback")(_signal("ema_pullback"))


@add(f"WITH {PREPARED}, {EXTRA}, s1 AS ({signal_sql('momentum_breakout')}), s2 AS ({signal_sql('vwap_reversion')}), s3 AS ({signal_sql('vwap_delta')}), k AS (SELECT ticker, ts, direction FROM (SELECT DISTINCT ticker, ts, direction, 1 AS s FROM s2 UNION ALL SELECT DISTINCT ticker, ts, direction, 2 FROM s3) GROUP BY 1, 2, 3 HAVING count(*) >= 1) SELECT s1.* REPLACE ('momentum_confirmed' AS strategy) FROM s1 SEMI JOIN k ON s1.ticker = k.ticker AND s1.ts = k.ts AND s1.direction = k.direction UNION ALL SELECT * FROM s3", "hour_bars", doubles="stop_abs stop_offset", dates="ts")
def generate_signals(spark, sf):
    out = G.generate_signals(_bars_with_flow(spark, sf), ["momentum_confirmed", "vwap_delta"], {"momentum_confirmed": ("momentum_breakout", ["vwap_reversion", "vwap_delta"], 1)})
    return out.withColumn("bar_no", F.col("bar_no").cast("long"))


@add("SELECT ticker, ts, 0 AS bar_no FROM hour_bars WHERE false", "hour_bars", dates="ts")
def lookahead_check(spark, sf):
    return G.lookahead_check(X.hour_bars(spark, sf), "momentum_breakout", 300).select("ticker", "ts", F.col("bar_no").cast("int").alias("bar_no"))


@add("SELECT b.ticker, b.ts, b.close, q.bid_price, q.ask_price FROM hour_bars b ASOF LEFT JOIN quotes q ON b.ticker = q.ticker AND b.ts >= q.ts", "hour_bars", "quotes", doubles="close bid_price ask_price", dates="ts", places=6)
def asof_ffill_join(spark, sf):
    return J.asof_ffill_join(X.hour_bars(spark, sf).select("ticker", "ts", "close"), X.quotes(spark, sf), ["bid_price", "ask_price"])


@add("SELECT b.ticker, b.ts, b.close, t.n AS tr_n, q.spread AS qu_spread FROM hour_bars b LEFT JOIN (SELECT ticker, date_trunc('hour', ts) AS ts, count(*) AS n FROM ticks WHERE size > 50 GROUP BY 1, 2) t ON b.ticker = t.ticker AND b.ts = t.ts LEFT JOIN (SELECT ticker, date_trunc('hour', ts) AS ts, avg(ask_price - bid_price) AS spread FROM quotes WHERE bid_size > 2 GROUP BY 1, 2) q ON b.ticker = q.ticker AND b.ts = q.ts", "hour_bars", "quotes", doubles="close qu_spread", dates="ts", places=6)
def align_feature_bars(spark, sf):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    t = X.ticks(spark, sf).where("size > 50").groupBy("ticker", hour).agg(F.count("*").alias("n"))
    q = X.quotes(spark, sf).where("bid_size > 2").groupBy("ticker", hour).agg(F.avg(F.col("ask_price") - F.col("bid_price")).alias("spread"))
    return J.align_feature_bars(X.hour_bars(spark, sf).select("ticker", "ts", "close"), t, q)


@add("WITH b AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts) - 1 AS bar_no FROM hour_bars) SELECT a.ticker, a.bar_no, CAST(b.bar_no AS BIGINT) AS at, b.open AS b_open, b.close AS b_close FROM b a JOIN b ON a.ticker = b.ticker AND b.bar_no BETWEEN a.bar_no + 1 AND a.bar_no + 4", "hour_bars", doubles="b_open b_close")
def forward_range_join(spark, sf):
    bars = X.hour_bars(spark, sf).withColumn("bar_no", W.bar_number().cast("long"))
    return J.forward_range_join(bars.select("ticker", "bar_no"), bars, 1, 4).select("ticker", "bar_no", "at", "b_open", "b_close")


@add("SELECT CAST(ticker AS VARCHAR) AS ticker, day, CAST(n AS INTEGER) AS \"rank\" FROM (SELECT ticker, day, row_number() OVER (PARTITION BY day ORDER BY volume DESC, ticker) AS n FROM day_bars)", "day_bars", dates="day")
def daily_rank(spark, sf):
    return G.daily_rank(X.day_bars(spark, sf), "volume").select("ticker", "day", "rank")


for _k, _v in list(BOOK.sql.items()):
    if "RECURSIVE_MARK" in _v:  # the fixtures come first, so the word belongs at the front
        BOOK.sql[_k] = _v.replace("RECURSIVE_MARK ", "").replace("WITH ticks AS", "WITH RECURSIVE ticks AS", 1)
