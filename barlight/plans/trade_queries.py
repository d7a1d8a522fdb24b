"""Queries on trade tables and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlight.operators import outcomes as T
from barlight.operators import windows as W
from barlight.plans import fixtures as X
from barlight.plans.book import Book

BOOK = Book()
add = BOOK.add
ORDER = "ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_suppkey, price"


def metrics_sql(pnl: str = "pnl", sharpe: float = 252.0) -> str:
    return f"""count(*) AS n, count(*) FILTER (result = 'win') AS wins, count(*) FILTER (result = 'loss') AS losses, count(*) FILTER (result = 'win') / nullif(count(*) FILTER (result = 'win' OR result = 'loss'), 0) * 100 AS win_rate,
  CASE WHEN -coalesce(sum({pnl}) FILTER ({pnl} < 0), 0) > 0 THEN coalesce(sum({pnl}) FILTER ({pnl} > 0), 0) / -sum({pnl}) FILTER ({pnl} < 0) ELSE 999 END AS profit_factor, sum({pnl}) AS total_pnl, avg({pnl}) AS mean_pnl, median({pnl}) AS median_pnl, stddev_samp({pnl}) AS stdev_pnl, avg({pnl}) FILTER ({pnl} > 0) AS average_win, avg({pnl}) FILTER ({pnl} < 0) AS average_loss,
  max({pnl}) AS largest_win, min({pnl}) AS largest_loss, avg({pnl}) / nullif(stddev_samp({pnl}), 0) * sqrt({sharpe}) AS sharpe, stddev_samp({pnl}) * 1.96 / sqrt(count(*)) AS ci95, avg({pnl}) FILTER ({pnl} > 0) / nullif(-avg({pnl}) FILTER ({pnl} < 0), 0) AS win_loss_ratio"""


METRICS = "win_rate profit_factor total_pnl mean_pnl median_pnl stdev_pnl average_win average_loss largest_win largest_loss sharpe ci95 win_loss_ratio"


def streak_sql(keys: str) -> str:
    return f"""t AS (SELECT *, result <> 'win' AS flag, row_number() OVER (PARTITION BY {keys} {ORDER}) AS n FROM trades_log), i AS (SELECT *, n - row_number() OVER (PARTITION BY {keys}, flag {ORDER}) AS island FROM t),
  st AS (SELECT {keys}, max(run) AS max_losing_streak FROM (SELECT {keys}, island, count(*) AS run FROM i WHERE flag GROUP BY ALL) GROUP BY ALL)"""


def grouped_sql(keys: str, pnl: str = "pnl", sharpe: float = 252.0) -> str:
    return f"WITH {streak_sql(keys)}, g AS (SELECT {keys}, {metrics_sql(pnl, sharpe)} FROM trades_log GROUP BY ALL) SELECT g.*, coalesce(max_losing_streak, 0) AS max_losing_streak FROM g LEFT JOIN st USING ({keys})"


@add(grouped_sql("strategy, rr_ratio"), "trades_log", doubles=f"rr_ratio {METRICS}", places=3)
def trade_metrics(spark, sf):
    return T.trade_metrics(X.trades_log(spark, sf), ["strategy", "rr_ratio"], X.LOG_ORDER)


@add(grouped_sql("ticker, strategy, rr_ratio", "pnl_pct", 252 / 20), "trades_log", doubles=f"rr_ratio {METRICS}")
def trade_summary(spark, sf):
    return T.trade_summary(X.trades_log(spark, sf), X.LOG_ORDER)


@add("""WITH d AS (SELECT day, sum(pnl) AS p FROM trades_log GROUP BY 1), w AS (SELECT count(*) AS n, 100.0 * count(*) FILTER (result = 'win') / count(*) AS win_pct, 100.0 * count(*) FILTER (result = 'loss') / count(*) AS loss_pct, 100.0 * count(*) FILTER (result = 'timeout') / count(*) AS timeout_pct, 100.0 * count(*) FILTER (result = 'win') / count(*) FILTER (result <> 'timeout') AS win_rate, avg(pnl) AS expectancy, sum(pnl) AS total_pnl FROM trades_log)
  SELECT w.*, k.* FROM w, (SELECT count(*) AS days, avg(p) AS mean_day, max(p) AS best_day, min(p) AS worst_day, avg(p) / stddev_pop(p) * sqrt(252) AS sharpe, avg(p) / sqrt(avg(pow(least(p, 0), 2))) * sqrt(252) AS sortino FROM d) k""", "trades_log", doubles="win_pct loss_pct timeout_pct win_rate expectancy total_pnl mean_day best_day worst_day sharpe sortino", places=3)
def portfolio_diagnostics(spark, sf):
    return T.portfolio_diagnostics(X.trades_log(spark, sf))


@add("SELECT CASE WHEN r < -1 THEN '<-1R' WHEN r < 0 THEN '-1R..0' WHEN r < 1 THEN '0..1R' WHEN r < 2 THEN '1R..2R' WHEN r < 3 THEN '2R..3R' ELSE '>=3R' END AS bin, count(*) AS n FROM (SELECT pnl / 1000 AS r FROM trades_log) GROUP BY 1", "trades_log")
def r_multiple_histogram(spark, sf):
    return T.r_multiple_histogram(X.trades_log(spark, sf).withColumn("r", F.col("pnl") / 1000))


@add("SELECT result AS reason, count(*) AS n FROM trades_log GROUP BY 1", "trades_log")
def skip_reason_counts(spark, sf):
    return T.skip_reason_counts(X.trades_log(spark, sf).withColumnRenamed("result", "reason"))


@add(f"""WITH {streak_sql("strategy, rr_ratio")}, g AS (SELECT strategy, rr_ratio, {metrics_sql()} FROM trades_log GROUP BY ALL), c AS (SELECT *, 1e9 + sum(pnl) OVER (PARTITION BY strategy, rr_ratio {ORDER} ROWS UNBOUNDED PRECEDING) AS eq FROM trades_log),
  h AS (SELECT *, greatest(max(eq) OVER (PARTITION BY strategy, rr_ratio {ORDER} ROWS UNBOUNDED PRECEDING), 1e9) AS top FROM c), dd AS (SELECT strategy, rr_ratio, avg((top - eq) / top * 100) AS mean_drawdown FROM h GROUP BY ALL)
  SELECT g.*, coalesce(max_losing_streak, 0) AS max_losing_streak, mean_drawdown, 3 * profit_factor + 2 * coalesce(sharpe, 0) + coalesce(win_rate, 0) / 10 AS score, CASE WHEN n < 20 THEN 'LOW' ELSE 'OK' END AS confidence FROM g LEFT JOIN st USING (strategy, rr_ratio) JOIN dd USING (strategy, rr_ratio)""", "trades_log", doubles=f"rr_ratio {METRICS} mean_drawdown score", places=3)
def leaderboard(spark, sf):
    return T.leaderboard(X.trades_log(spark, sf), X.LOG_ORDER, start=1e9)


@add("SELECT strategy, rr_ratio, n, mean_pnl FROM (SELECT strategy, rr_ratio, count(*) AS n, avg(pnl) AS mean_pnl, row_number() OVER (PARTITION BY strategy ORDER BY avg(pnl) DESC, rr_ratio) AS k FROM trades_log GROUP BY 1, 2) WHERE k = 1", "trades_log", doubles="rr_ratio mean_pnl", places=3)
def strategy_best(spark, sf):
    g = X.trades_log(spark, sf).groupBy("strategy", "rr_ratio").agg(F.count("*").alias("n"), F.avg("pnl").alias("mean_pnl"))
    return T.best_of(g, ["strategy"], [F.desc("mean_pnl"), F.col("rr_ratio")])


for _name, _keys, _least in (("rr_comparison", "rr_ratio", 1), ("strategy_summary", "strategy", 1), ("yearly_summary", "year", 1), ("by_day_of_week", "weekday", 3)):
    _expr = {"year": "extract(year FROM day)", "weekday": "isodow(day)"}.get(_keys, _keys)
    _cast = f"CAST({_expr} AS INTEGER)" if _expr != _keys else _expr

    def _grouped(spark, sf, keys=_keys, least=_least):
        t = X.trades_log(spark, sf).withColumn("year", F.year("day")).withColumn("weekday", F.weekday("day") + 1)
        return t.groupBy(keys).agg(*T.metrics()).where(F.col("n") >= least)

    add(f"SELECT {_cast} AS {_keys}, {metrics_sql()} FROM trades_log GROUP BY 1 HAVING count(*) >= {_least}", "trades_log", doubles=METRICS + (" rr_ratio" if _keys == "rr_ratio" else ""), places=3, name=_name)(_grouped)


@add(f"""WITH q AS (SELECT quantile_cont(quantity, [0.2, 0.4, 0.6, 0.8]) AS a, quantile_cont(price, [0.2, 0.4, 0.6, 0.8]) AS b FROM trades_log), m AS (SELECT 'quantity' AS metric, 1 + len(list_filter(list_distinct(a), lambda e: e < quantity)) AS quintile, t.* FROM trades_log t, q UNION ALL SELECT 'price', 1 + len(list_filter(list_distinct(b), lambda e: e < price)), t.* FROM trades_log t, q)
  SELECT metric, CAST(quintile AS INTEGER) AS quintile, {metrics_sql()} FROM m GROUP BY ALL""", "trades_log", doubles=METRICS, places=3)
def by_quintile(spark, sf):
    return T.by_quintile(X.trades_log(spark, sf), ["quantity", "price"])


NUMBERED = "b AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts) - 1 AS bar_no FROM hour_bars)"
ENTRY = "s AS (SELECT ticker, bar_no, CASE WHEN bar_no % 2 = 0 THEN 1 ELSE -1 END AS direction, close AS entry, close - (CASE WHEN bar_no % 2 = 0 THEN 1 ELSE -1 END) * close * 0.3 AS stop, close + (CASE WHEN bar_no % 2 = 0 THEN 1 ELSE -1 END) * close * 0.6 AS target, ticker || bar_no AS id FROM b)"


def _walk(spark, sf):
    bars = X.hour_bars(spark, sf).withColumn("bar_no", W.bar_number().cast("long"))
    d = F.when(F.col("bar_no") % 2 == 0, 1).otherwise(-1)
    c = F.col("close")
    s = bars.select("ticker", "bar_no", d.alias("direction"), c.alias("entry"), (c - d * c * 0.3).alias("stop"), (c + d * c * 0.6).alias("target"), F.concat("ticker", F.col("bar_no").cast("string")).alias("id"), (c - d * c * 0.3).alias("stop_abs"), F.lit(None).cast("double").alias("stop_offset"))
    return s, bars


HITS = "h AS (SELECT s.*, b.bar_no AS xat, b.open AS bo, b.high AS bh, b.low AS bl, b.close AS bc FROM s JOIN b ON s.ticker = b.ticker AND b.bar_no BETWEEN s.bar_no + {first} AND s.bar_no + {last})"
FIRST = """f AS (SELECT id, ticker, bar_no, direction, entry, stop, target, min(xat) FILTER ((direction = 1 AND bh >= target) OR (direction = -1 AND bl <= target)) AS t, min(xat) FILTER ((direction = 1 AND bl <= stop) OR (direction = -1 AND bh >= stop)) AS k, max(xat) AS last, arg_max(bc, xat) AS c FROM h GROUP BY ALL)"""


@add(f"""WITH {NUMBERED}, {ENTRY}, {HITS.format(first=1, last=19)}, {FIRST}, r AS (SELECT *, CASE WHEN t IS NOT NULL AND (k IS NULL OR t <= k) THEN 'win' WHEN k IS NOT NULL THEN 'loss' ELSE 'timeout' END AS result FROM f)
  SELECT id, ticker, bar_no, direction, entry, stop, target, result, CASE result WHEN 'win' THEN target WHEN 'loss' THEN stop ELSE c END AS exit, CASE result WHEN 'win' THEN t WHEN 'loss' THEN k ELSE last END - bar_no AS bars_held, ((CASE result WHEN 'win' THEN target WHEN 'loss' THEN stop ELSE c END) - entry) * direction / entry * 100 AS pnl_pct FROM r""", "hour_bars", doubles="entry stop target exit pnl_pct")
def barrier_outcome_v2(spark, sf):
    s, bars = _walk(spark, sf)
    return T.barrier_outcome_v2(s.drop("stop_abs", "stop_offset"), bars, 20)


# Bars with the hour's mean quotes, some of them without.
QUOTED = "qq AS (SELECT ticker, date_trunc('hour', ts) AS ts, avg(bid_price) AS bid, avg(ask_price) AS ask FROM quotes GROUP BY 1, 2), qb AS (SELECT b.*, CASE WHEN bar_no % 11 <> 0 THEN bid END AS bid, CASE WHEN bar_no % 13 <> 0 THEN ask END AS ask FROM b LEFT JOIN qq ON b.ticker = qq.ticker AND b.ts = qq.ts)"
EXECUTED = f"""WITH {NUMBERED}, {QUOTED}, {ENTRY}, x AS (SELECT *, CASE WHEN execution = 'bid_ask_slippage' THEN 5 / 1e4 ELSE 0 END AS slip FROM (VALUES ('mid'), ('bid_ask'), ('bid_ask_slippage')) AS x(execution)),
  e AS (SELECT x.*, s.id, s.ticker, s.bar_no, s.direction, s.stop, (CASE WHEN execution = 'mid' THEN n.open ELSE coalesce(CASE WHEN direction = 1 THEN n.ask ELSE n.bid END, n.open) END) * (1 + direction * slip) AS entry FROM x, s JOIN qb n ON n.ticker = s.ticker AND n.bar_no = s.bar_no + 1),
  p AS (SELECT e.*, abs(entry - stop) AS risk, rr, timeout, entry + direction * abs(entry - stop) * rr AS target FROM e, {{grid}} WHERE abs(entry - stop) > 0),
  h AS (SELECT p.*, b.bar_no AS xat, b.high AS bh, b.low AS bl, (CASE WHEN execution = 'mid' THEN b.close ELSE coalesce(CASE WHEN direction = 1 THEN b.bid ELSE b.ask END, b.close) END) * (1 - direction * slip) AS mx,
    CASE WHEN direction = 1 THEN b.high >= target ELSE b.low <= target END AS t, CASE WHEN direction = 1 THEN b.low <= stop ELSE b.high >= stop END AS k FROM p JOIN qb b ON p.ticker = b.ticker AND b.bar_no BETWEEN p.bar_no + 1 AND p.bar_no + 1 + timeout),
  f AS (SELECT execution, rr, timeout, id, coalesce(min(xat) FILTER (t OR k), max(xat)) AS xb FROM h GROUP BY ALL),
  r AS (SELECT h.*, CASE WHEN k THEN 'loss' WHEN t THEN 'win' ELSE 'timeout' END AS result FROM h JOIN f USING (execution, rr, timeout, id) WHERE h.xat = f.xb),
  o AS (SELECT *, CASE result WHEN 'win' THEN target WHEN 'loss' THEN (CASE WHEN direction = 1 THEN least(mx, stop) ELSE greatest(mx, stop) END) ELSE mx END AS exit FROM r)"""


def _quoted(spark, sf):
    s, bars = _walk(spark, sf)
    q = X.quotes(spark, sf).groupBy("ticker", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("bid_price").alias("bid"), F.avg("ask_price").alias("ask"))
    bars = bars.join(q, ["ticker", "ts"], "left").withColumn("bid", F.when(F.col("bar_no") % 11 != 0, F.col("bid"))).withColumn("ask", F.when(F.col("bar_no") % 13 != 0, F.col("ask")))
    return s.select("ticker", "bar_no", "direction", "stop_abs", "stop_offset", "id"), bars


@add(EXECUTED.format(grid="(VALUES (2::DOUBLE, 20)) AS g(rr, timeout)") + """, m AS (SELECT execution, id, max(bh) AS hi, min(bl) AS lo FROM h JOIN f USING (execution, rr, timeout, id) WHERE xat <= xb GROUP BY ALL)
  SELECT execution, id, ticker, bar_no, direction, entry, stop, target, risk, exit, result, greatest(CASE WHEN direction = 1 THEN hi - entry ELSE entry - lo END, 0) AS mfe, least(CASE WHEN direction = 1 THEN lo - entry ELSE entry - hi END, 0) AS mae, (exit - entry) * direction AS pnl, xat - bar_no - 1 AS duration FROM o JOIN m USING (execution, id)""", "hour_bars", "quotes", doubles="entry stop target risk exit mfe mae pnl", places=6)
def barrier_outcome_v3(spark, sf):
    s, bars = _quoted(spark, sf)
    outcomes = [T.barrier_outcome_v3(s, bars, 2.0, 20, execution=e).withColumn("execution", F.lit(e)) for e in T.EXECUTIONS]
    return outcomes[0].union(outcomes[1]).union(outcomes[2])


@add(EXECUTED.format(grid="(VALUES (1.5::DOUBLE), (2::DOUBLE), (2.5::DOUBLE)) AS r(rr), (VALUES (15), (30), (60), (120)) AS o(timeout)") + f", pp AS (SELECT execution, rr, timeout, result, (exit - entry) * direction AS pnl FROM o) SELECT execution, rr, timeout, {metrics_sql()} FROM pp GROUP BY ALL", "hour_bars", "quotes", doubles=f"rr {METRICS}")
def robustness_grid(spark, sf):
    s, bars = _quoted(spark, sf)
    return T.robustness_grid(s, bars, (1.5, 2.0, 2.5), (15, 30, 60, 120))


@add(f"""WITH {NUMBERED}, {ENTRY}, {HITS.format(first=1, last=19)}, {FIRST}, r AS (SELECT *, CASE WHEN t IS NOT NULL AND (k IS NULL OR t <= k) THEN 'win' WHEN k IS NOT NULL THEN 'loss' ELSE 'timeout' END AS result FROM f),
  tr AS (SELECT r.*, entry * (1 + bar_no % 3 * 0.02) AS paid, CASE result WHEN 'win' THEN target WHEN 'loss' THEN stop ELSE c END AS exit, CASE result WHEN 'win' THEN t WHEN 'loss' THEN k ELSE last END - bar_no AS held FROM r),
  w AS (SELECT tr.*, b.bar_no - tr.bar_no AS n, b.high AS bh, b.low AS bl, CASE WHEN direction = 1 THEN b.high >= target ELSE b.low <= target END AS ht, CASE WHEN direction = 1 THEN b.low <= stop ELSE b.high >= stop END AS hs FROM tr JOIN b ON b.ticker = tr.ticker AND b.bar_no BETWEEN tr.bar_no AND tr.bar_no + 19),
  g AS (SELECT id, result, min(n) FILTER (n > 0 AND ht) AS t, min(n) FILTER (n > 0 AND hs) AS s, bool_or(n > 0 AND ht AND hs) AS both_, bool_or(n = 0 AND hs) AS es, bool_or(n = 0 AND CASE WHEN direction = 1 THEN bh < paid ELSE bl > paid END) AS ph,
    bool_or(n = held AND ((result = 'win' AND NOT ht) OR (result = 'loss' AND NOT hs))) AS un FROM w GROUP BY ALL),
  l AS (SELECT *, CASE WHEN s IS NOT NULL AND (t IS NULL OR s <= t) THEN 'loss' WHEN t IS NOT NULL THEN 'win' ELSE 'timeout' END AS sf FROM g)
  SELECT count(*) AS n, count(*) FILTER (both_) AS ambiguous, count(*) FILTER (sf = 'loss') AS losses_stop_first, count(*) FILTER (sf = 'win') AS wins_stop_first, count(*) FILTER (sf = 'timeout') AS timeouts_stop_first, count(*) FILTER (sf <> result) AS relabelled,
    count(*) FILTER (t IS NOT NULL AND (s IS NULL OR t <= s)) AS wins_target_first, count(*) FILTER (es) AS entry_bar_stop, count(*) FILTER (ph) AS phantom_entry, count(*) FILTER (un) AS unreachable_exit FROM l""", "hour_bars")
def audit_ambiguous_bars(spark, sf):
    s, bars = _walk(spark, sf)
    trades = T.barrier_outcome_v2(s.drop("stop_abs", "stop_offset"), bars, 20)
    # What is said to have been paid is off for some, so that some entries were never to be had.
    trades = trades.withColumn("entry", F.col("entry") * (1 + F.col("bar_no") % 3 * 0.02))
    return T.audit_ambiguous_bars(trades, bars, 20)


@add(f"WITH {NUMBERED}, {ENTRY}, z AS (SELECT id, entry, stop, least(floor(500 / nullif(abs(entry - stop), 0)), floor(10000 / (entry * 0.25))) AS shares FROM s) SELECT id, entry, stop, CAST(shares AS BIGINT) AS shares, shares * entry AS notional, shares * entry * 0.25 AS margin, greatest(0.35, shares * 0.0001) AS commission FROM z WHERE shares > 0", "hour_bars", doubles="entry stop notional margin commission", places=6)
def position_size(spark, sf):
    s, _ = _walk(spark, sf)
    return T.position_size(s.select("id", "entry", "stop"), 500, 10000)


@add("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ask ELSE bid END * CASE WHEN event_id % 2 = 0 THEN 1 + 5 / 1e4 ELSE 1 - 5 / 1e4 END AS fill FROM (SELECT event_id, value * 1.01 AS ask, value * 0.99 AS bid FROM events)", doubles="fill", places=6)
def fill_price(spark, sf):
    e = X.read(spark, sf, "events")
    side = F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)
    return e.select("event_id", T.fill_price(side, "bid_ask_slippage", F.col("value"), F.col("value") * 0.99, F.col("value") * 1.01).alias("fill"))
