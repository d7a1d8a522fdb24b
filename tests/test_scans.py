"""Measures in slices of time, exact quantiles and correlations in blocks, against going through all rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlight.operators import outcomes
from barlight.operators import scans as C
from barlight.operators import windows as W

T0 = 1_700_000_000


def hot_rows(n=3000):
    """One ticker has 90 % of the rows; values have gaps, some tickers begin with nulls, and one has no value."""
    rng = random.Random(11)
    rows = []
    for k in range(n):
        t = "hot" if rng.random() < 0.9 else rng.choice(["b", "c", None])
        x = None if rng.random() < 0.1 or (t == "b" and k < n // 3) else round(rng.uniform(-5, 5), 3)
        rows.append((t, T0 + 97 * k, x, rng.randrange(1, 9), k))
    return rows + [("none", T0 + 5 * k, None, 1, 10**6 + k) for k in range(20)]


@pytest.fixture(scope="module")
def bars(spark):
    df = spark.createDataFrame(hot_rows(), "ticker string, s long, close double, size long, sequence long")
    return df.select("ticker", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), (F.col("s") * 10**9).alias("sip_ns"), "close", "size", "sequence", F.lit("x").alias("slice")).repartition(7)


def by_ticker(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seconds", [1000, 20_000, 10**9])
@pytest.mark.parametrize("batch", [7, 10_000])
def test_ema(spark, bars, seconds, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = {(r.ticker, r.sequence): (r.e3, r.e20) for r in C.with_ema(bars, {"e3": 3, "e20": 20}, seconds=seconds).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == bars.count()
    for ticker, rows in by_ticker(hot_rows()).items():
        state = [None, None]
        for _, _, x, _, k in rows:
            if x is not None:
                state = [x if e is None else e + 2 / (n + 1) * (x - e) for e, n in zip(state, (3, 20), strict=True)]
            for a, b in zip(found[ticker, k], state, strict=True):
                assert (a is None) == (b is None) and (b is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("seconds", [1000, 10**9])
def test_last_known_and_cumulative_delta(bars, seconds):
    known = {(r.ticker, r.sequence): (r.known_close, r.before) for r in C.last_known(C.last_known(bars, ["close"], "ticker", ["ts", "sequence"], seconds).withColumn("before_", F.col("close")), ["before_"], "ticker", ["ts", "sequence"], seconds, inclusive=False).withColumnRenamed("known_before_", "before").collect()}
    ticks = bars.where("close is not null").withColumnRenamed("close", "price")
    delta = {(r.ticker, r.sequence): (r.side, r.cumulative_delta) for r in C.cumulative_delta(ticks, seconds=seconds).collect()}
    for ticker, rows in by_ticker(hot_rows()).items():
        last, total = None, 0
        for _, _, x, size, k in rows:
            assert known[ticker, k] == (x if x is not None else last, last)
            if x is not None:
                side = 0 if last is None else (x > last) - (x < last)
                total += size * side
                assert delta[ticker, k] == (side, total)
                last = x
    assert C.last_known(bars.where("false"), ["close"], "ticker", ["ts"]).count() == 0


def test_no_task_has_a_whole_ticker(spark, bars):
    """The rows of the hot ticker are dealt by slice: the largest task has not much more than the median."""
    cut = bars.withColumn("slice_no", C.slice_number(bars, "ts", 3000)).repartition(16, "ticker", "slice_no")
    sizes = sorted(r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]
    plan = W.with_macd(bars)._jdf.queryExecution().executedPlan().toString()
    assert "slice_no" in plan


VALUES = {
    "few": [1.0, 2.0, 2.0, 2.0, 7.5],
    "one": [3.25] * 50,
    "any size": [s * 10.0**e for e in range(-300, 301, 7) for s in (-1, 1, 3)],
    "close": [1.0 + k * 2**-52 for k in range(300)],
    "ends": [float("-inf"), -1.7e308, 0.0, 5e-324, 1e-320, 1.7976931348623157e308, float("inf"), 1.0],
    "halves": [k / 2 for k in range(1001)] + [None, float("nan")] * 20,
}


@pytest.mark.parametrize("name", VALUES)
def test_exact_quantiles(spark, name):
    values = VALUES[name][:]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, None if v is None or v != v or math.isinf(v) or abs(v) > 1e15 else int(v)) for v in values], "x double, whole long").repartition(3)
    shares = [0, 0.2, 0.4, 0.5, 0.6, 0.8, 0.99, 1]
    found = C.exact_quantiles(df, ["x", "whole"], shares)
    x = sorted(v for v in values if v is not None and v == v)
    for p, got in zip(shares, found["x"], strict=True):
        at = p * (len(x) - 1)
        low, high = math.floor(at), math.ceil(at)
        want = x[low] if low == high else (high - at) * x[low] + (at - low) * x[high]
        assert got == want
    whole = sorted(r.whole for r in df.where("whole is not null").collect())
    assert found["whole"][0] == whole[0] and found["whole"][-1] == whole[-1]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert C.exact_quantiles(df, ["x"], [0.5]) == {"x": []}
    assert [r.quintile for r in W.quintile(df, "x").collect()] == [None]
    assert W.quintile(df.where("false"), "x").count() == 0


def test_quintiles_are_those_of_the_built_in_percentile(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 613).cast("double").alias("x"))
    edges = sorted(set(df.agg(F.percentile("x", F.array(*(F.lit(k / 5) for k in range(6))))).first()[0]))[1:-1]
    assert all(r.quintile == 1 + sum(e < r.x for e in edges) for r in W.quintile(df, "x").collect())


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_correlation_blocks(spark, blocks):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(120, 9)) @ rng.normal(size=(9, 9))
    names = ["k%d" % i for i in range(9)]
    rows = [(names[j], T0 + 86_400 * t, float(m[t, j])) for t in range(120) for j in range(9)]
    df = spark.createDataFrame(rows, "ticker string, s long, r double").withColumn("ts", F.timestamp_seconds("s"))
    found = {(r.a, r.b): r.corr for r in C.correlation_blocks(df, blocks=blocks).collect()}
    want = np.corrcoef(m.T)
    assert set(found) == {(a, b) for a in names for b in names if a < b}
    assert all(math.isclose(v, want[names.index(a), names.index(b)], abs_tol=1e-9) for (a, b), v in found.items())
    assert C.correlation_blocks(df.where("false"), blocks=blocks).count() == 0


def _trades(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), None if k == 3 else (k // rng.choice((1, 40))) % 30, k, rng.random() < 0.9, None if rng.random() < 0.1 else rng.uniform(-50, 50)) for k in range(1500)]
    df = spark.createDataFrame([*rows, ("c", 1, 1, False, 1.0), *(("d", k, k, True, -1.0) for k in range(6))], "g string, d int, n int, flag boolean, pnl double")
    return df.withColumn("day", F.date_from_unix_date("d"))


def test_streaks_and_drawdowns_run_on_over_days(spark):
    """As a walk in order gives them, also over days without a break, without a day and without a number."""
    df = _trades(spark)
    runs, means = {}, {}
    for g in "abcd":
        rows = sorted((r for r in df.collect() if r.g == g), key=lambda r: (r.d is not None, r.d or 0, r.n))
        run, total, top, drawdowns = 0, None, 1000.0, []
        for r in rows:
            run = run + 1 if r.flag else 0
            runs[g] = max(runs.get(g, 0), run)
            if r.pnl is not None:
                total = (total or 0.0) + r.pnl
            if total is not None:
                top = max(top, 1000 + total)
                drawdowns.append((top - 1000 - total) / top * 100)
        means[g] = sum(drawdowns) / len(drawdowns)
    for first in ("day", "d"):
        got = {r.g: r.longest for r in W.streaks(df, ["g"], [first, "n"], F.col("flag"), "longest").collect()}
        assert got == {g: n for g, n in runs.items() if n} and got["d"] == 6
        mean = {r.g: r.mean_drawdown for r in W.mean_drawdown(df, ["g"], [first, "n"], "pnl", 1000.0).collect()}
        assert mean == pytest.approx(means)


def test_no_task_takes_a_whole_group_of_trades(spark):
    """Windows over trades are dealt by day as well."""
    df = _trades(spark).withColumnRenamed("g", "strategy").withColumn("rr_ratio", F.lit(1.0)).withColumn("result", F.when(F.col("flag"), "loss").otherwise("win"))
    for rows in (outcomes.trade_metrics(df, ["strategy", "rr_ratio"], ["day", "n"]), outcomes.leaderboard(df, ["day", "n"])):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        dealt = [by for by, order in re.findall(r"Window .*\], \[([^\]]*)\], \[([^\]]*)\]\n", plan) if "day#" in order]
        assert dealt and all("slice_no" in by for by in dealt)
