"""Streams over several batches: order, restarts, reruns and rejects."""

import bisect
import json
import random

import pytest
from pyspark.sql import functions as F

from barlight.streaming import events as E
from barlight.streaming import messages as M
from barlight.streaming import state as S


def put(spark, folder, number, rows, schema):
    """A batch's file, which the source takes in order of its name's time."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/part={number}")


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def run(stream, path, mode="update"):
    """Rows of each batch."""
    out = {}
    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(lambda df, n: out.__setitem__(n, [r.asDict() for r in df.collect()])).trigger(availableNow=True).start().awaitTermination()
    return [out[n] for n in sorted(out)]


# Messages as a server sends them: typed rows that they must give.
STOCKS = [
    '[{"ev":"status","status":"connected","message":"Connected"}]',
    '[{"ev":"T","sym":"AAPL","i":"5096","x":10,"p":161.87,"s":300,"c":[14,41],"t":1651684192462,"q":4009402,"z":3}]',
    '[{"ev":"T","sym":"AMZN","i":"72815","x":12,"p":161.8,"s":1,"t":1651684192536,"q":4009407,"z":1},{"ev":"LULD","T":"MSFT","h":218.8,"l":198.0,"i":[21],"z":3,"t":1601318039223013600,"q":7}]',
    '[{"ev":"NOI","T":"NTEST.Q","t":1601318039223013600,"at":930,"a":"M","i":44,"x":10,"o":480,"p":440,"b":25.03},{"ev":"XT","pair":"BTC-USD","p":1.5}]',
    '{"ev":"Q","sym":"MSFT","bx":4,"bp":114.125,"bs":100,"ax":7,"ap":114.128,"as":160,"c":0,"t":1536036818784,"z":3,"q":50385480}',
    '[{"ev":"A","sym":"SPCE","v":200,"av":8642007,"op":25.66,"vw":25.3981,"o":25.39,"c":25.39,"h":25.39,"l":25.38,"a":25.3714,"z":50,"s":1610144868000,"e":1610144869000,"otc":true}, {"sym":"X"}, 5]',
    '[{"ev":"T","sym":"HALF"',
    "no json",
    None,
    "[]",
]


def test_typed_rows_and_rejects(spark, tmp_path):
    for n, m in enumerate(STOCKS):
        put(spark, tmp_path / "in", n, [(m,)], "value string")
    out = str(tmp_path / "out")
    M.route(source(spark, tmp_path / "in", "value string"), "stocks", out).awaitTermination()
    of = lambda kind: {r.symbol: r.asDict() for r in spark.read.parquet(f"{out}/{kind}").drop("batch").collect()}
    trades = of("equity_trade")
    assert set(trades) == {"AAPL", "AMZN"}
    assert trades["AAPL"]["price"] == 161.87 and trades["AAPL"]["conditions"] == [14, 41] and trades["AAPL"]["tape"] == 3 and trades["AAPL"]["timestamp"] == 1651684192462
    assert trades["AMZN"]["conditions"] is None
    limits = of("price_limits")["MSFT"]
    assert (limits["high_price"], limits["low_price"], limits["indicators"], limits["timestamp"]) == (218.8, 198.0, [21], 1601318039223013600)
    auction = of("imbalance")["NTEST.Q"]
    assert (auction["time_stamp"], auction["auction_time"], auction["auction_type"], auction["imbalance_quantity"], auction["paired_quantity"], auction["book_clearing_price"]) == (1601318039223013600, 930, "M", 480, 440, 25.03)
    assert of("equity_quote")["MSFT"]["ask_size"] == 160 and of("equity_bar")["SPCE"]["otc"] is True
    counts = {(r.reason, r.ev): r.n for r in spark.read.parquet(f"{out}/counts").groupBy("reason", "ev").agg(F.sum("n").alias("n")).collect()}
    assert counts == {("unknown", "XT"): 1, ("untyped", None): 2, ("broken", None): 3}
    kept = {r.event for r in spark.read.parquet(f"{out}/rejects").where("reason = 'broken'").collect()}
    assert kept == {'[{"ev":"T","sym":"HALF"', "no json", None}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(m,) for m in STOCKS], "value string")
    events = M.read_messages(rows, "stocks")
    seen = []
    for _ in range(2):
        M.write_batch(events, 0, str(tmp_path))
        M.write_batch(events, 1, str(tmp_path))
        seen.append({k: sorted(map(str, spark.read.parquet(f"{tmp_path}/{k}").collect())) for k in ("equity_trade", "equity_quote", "rejects", "counts")})
        assert len(seen[-1]["equity_trade"]) == 4
    assert seen[0] == seen[1]


def test_messages_are_parsed_once(spark):
    """Also where the message is computed: no filter or column behind makes the planner parse or make it again."""
    rows = spark.range(3).select(F.to_json(F.array(F.struct(F.lit("T").alias("ev"), F.col("id").alias("q")))).alias("value"))
    events = M.read_messages(rows, "stocks")
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("StructsToJsonEvaluator") + plan.count("to_json(") == 1
    assert [(r.ev, r.kind, r.reason) for r in events.collect()] == [("T", "equity_trade", None)] * 3


def test_types_of_events_however_written(spark):
    text = r"""[{"ev":"T"},{"ev":""},{"ev":"a\"b"},{"ev":"a\\"},{"ev":"\u0054"},{ "ev" : "T"},{"x":1,"ev":"Q"},{"ev":null},{"ev":5},5,null,{"ev":"T","ev":"Q"},{"ev":"status"}]"""
    got = [(r.ev, r.reason) for r in M.read_messages(spark.createDataFrame([(text,)], "value string"), "stocks").collect()]
    known, unknown, none = (lambda e: (e, None)), (lambda e: (e, "unknown")), (None, "untyped")
    assert got == [known("T"), unknown(""), unknown('a"b'), unknown("a\\"), known("T"), known("T"), known("Q"), none, unknown("5"), none, none, known("T")]


def test_rejects_alone(spark, tmp_path):
    """Without typed tables, which nobody reads then, rejects and counts are the same; no table of events is left."""
    for n, m in enumerate(STOCKS):
        put(spark, tmp_path / "in", n, [(m,)], "value string")
    for out, alone in (("a", True), ("b", False)):
        M.route(source(spark, tmp_path / "in", "value string"), "stocks", str(tmp_path / out), rejects_only=alone).awaitTermination()
    for t in ("rejects", "counts"):
        a, b = (sorted(map(str, spark.read.parquet(f"{tmp_path}/{x}/{t}").collect())) for x in "ab")
        assert a == b and a
    assert not (tmp_path / "a" / "equity_trade").exists() and (tmp_path / "b" / "equity_trade").exists()
    assert not list((tmp_path / "b" / "events").glob("batch=*"))


def test_every_kind_has_a_market():
    assert {k for kinds in M.MARKETS.values() for k in kinds.values()} == set(M.KINDS)


def test_books_in_any_order(spark, tmp_path):
    """Updates shuffled over batches give the books of the last update of each level."""
    rng = random.Random(6)
    updates = [("B-%d" % rng.randrange(3), 1_700_000_000_000 + k, rng.choice("ba"), float(rng.randrange(5)), float(rng.randrange(3))) for k in range(300)]
    updates = [(p, t, s, price + (10 if s == "a" else 0), size) for p, t, s, price, size in updates]
    updates.append(("B-0", 1_700_000_000_000 - 3 * 86_400_000, "b", 9.0, 1.0))  # too old to be kept
    shuffled = updates[:]
    rng.shuffle(shuffled)
    schema = "value string"
    for n in range(3):
        lines = [json.dumps([{"ev": "XL2", "pair": p, "b": [[price, size]] if s == "b" else [], "a": [[price, size]] if s == "a" else None, "t": t, "x": 1, "r": t + 5}]) for p, t, s, price, size in shuffled[n::3]]
        put(spark, tmp_path / "in", n, [(x,) for x in lines], schema)
    levels = M.levels(M.typed(M.read_messages(source(spark, tmp_path / "in", schema), "crypto"), "book"))
    batches = run(S.live_books(levels), tmp_path)
    assert len(batches) == 3
    last = {r["pair"]: r for b in batches for r in b}
    for pair in ("B-0", "B-1", "B-2"):
        held = {}
        for p, t, s, price, size in sorted(updates, key=lambda u: u[1]):
            if p == pair and t > 1_699_999_999_999:
                held[s, price] = size
        bids = [p for (s, p), z in held.items() if s == "b" and z]
        asks = [p for (s, p), z in held.items() if s == "a" and z]
        r = last[pair]
        assert (r["best_bid"], r["best_ask"], r["bid_levels"], r["ask_levels"]) == (max(bids, default=None), min(asks, default=None), len(bids), len(asks))
        assert r["bid_size"] == (held["b", max(bids)] if bids else None)


TRADE = "symbol string, at long, price double, size long, sequence long"


def trades(spark, folder):
    return source(spark, folder, TRADE).withColumn("ts", F.timestamp_millis("at")).drop("at")


def test_totals_after_batches_and_a_restart(spark, tmp_path):
    stream = lambda: S.live_totals(trades(spark, tmp_path / "in"), 4)
    given = [[("A", 1, 2.0, 3, 1), ("B", 2, 1.0, 1, 2)], [("A", 3, 1.0, 1, 3), ("A", 3, 1.0, 1, 4), (None, 3, 1.0, 1, 4)], [("C", 4, 5.0, 2, 5), ("B", 4, None, 2, 6)]]
    updates, want = [], [(2, 7.0, 2), (4, 9.0, 2), (6, 19.0, 3)]
    for n, rows in enumerate(given):
        put(spark, tmp_path / "in", n, rows, TRADE)
        for batch in run(stream(), tmp_path):  # a new query each time: what it knows is in the checkpoint
            updates += [(n, r["shard"], r["trades"], r["cash"], r["tickers"]) for r in batch]
        table = spark.createDataFrame(updates, "batch int, shard long, trades long, cash double, tickers long")
        for b in range(n + 1):
            assert tuple(S.totals_after(table, b).first()) == want[b]
    assert tuple(S.totals_after(table).first()) == want[-1]


def bars(rows, size):
    """Bars by going through all rows in order."""
    out = {}
    for symbol, at, price, n, _ in sorted(rows, key=lambda r: (r[0], r[1], r[4])):
        b = out.setdefault((symbol, at - at % size), [None, 0, 0.0, 0.0, 0.0])
        b[3] += n if b[0] is not None and price > b[0] else 0
        b[4] += n if b[0] is not None and price < b[0] else 0
        b[0], b[1], b[2] = price, b[1] + 1, b[2] + n
    return {k: tuple(v[1:]) for k, v in out.items()}


def test_trade_bars_in_order_of_events(spark, tmp_path):
    """Rows that come in a later batch, within the watermark, count where they belong."""
    t0 = 1_700_000_040_000
    rows = [("S", t0 + 1000 * k, float(p), 1, k) for k, p in enumerate((10, 11, 12, 13))]
    late = [rows[0], rows[2], rows[3]], [rows[1]]
    rng = random.Random(3)
    many = [(rng.choice("XY"), t0 + 700 * k + rng.randrange(3), float(rng.randrange(5)), rng.randrange(1, 9), 100 + k) for k in range(400)]
    # Rows of a batch are at most nine seconds older than the newest before.
    many_in = sorted(many, key=lambda r: r[1] + rng.randrange(9000))
    for n, part in enumerate([*late, *(many_in[k : k + 50] for k in range(0, 400, 50))]):
        put(spark, tmp_path / "in", n, part, TRADE)
    batches = run(S.stream_trade_bars(trades(spark, tmp_path / "in")), tmp_path)
    last = {(r["symbol"], r["bucket"]): r for b in batches for r in b}
    want = bars(rows + many, 60_000)
    assert want["S", t0 - t0 % 60_000] == (4, 4.0, 3.0, 0.0)
    assert {k: (r["trades"], r["volume"], r["buy_volume"], r["sell_volume"]) for k, r in last.items()} == want
    finals = [(r["symbol"], r["bucket"]) for b in batches for r in b if r["final"]]
    assert len(finals) == len(set(finals)) > 3


def test_windows_over_windows(spark, tmp_path):
    t0 = 1_700_000_000_000
    rng = random.Random(4)
    rows = [("S%d" % rng.randrange(40), t0 + 40 * k, float(1 + k % 7), 1 + k % 3, k) for k in range(1500)]
    for n in range(3):
        put(spark, tmp_path / "in", n, rows[n * 500 : n * 500 + 500], TRADE)
    found = [r for b in run(E.window_totals(trades(spark, tmp_path / "in")), tmp_path / "a", "append") for r in b]
    stats = E.tumbling_trade_stats(trades(spark, tmp_path / "in"))
    top = []
    stats.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "b")).foreachBatch(lambda df, _: top.extend(E.top_symbols(df, 5).collect())).trigger(availableNow=True).start().awaitTermination()
    by = {}
    for s, at, p, z, _ in rows:
        w = by.setdefault(at - at % 5000, {}).setdefault(s, [0, 0.0])
        w[0], w[1] = w[0] + 1, w[1] + p * z
    closed = {k: v for k, v in by.items() if k + 5000 <= rows[-1][1] - 10_000}
    ms = lambda ts: round(ts.timestamp() * 1000)
    assert {ms(r["start"]): (r["symbols"], r["trades"], r["cash"]) for r in found} == {k: (len(v), sum(x[0] for x in v.values()), sum(x[1] for x in v.values())) for k, v in closed.items()}
    for start, v in closed.items():
        want = sorted(v, key=lambda s: (-v[s][0], -v[s][1], s))[:5]
        assert [r.symbol for r in sorted(top, key=lambda r: r["rank"]) if ms(r.start) == start] == want


@pytest.mark.parametrize("n", [500, 200_000])
def test_latency_quantiles(spark, tmp_path, n):
    """Merged sketches of minutes are within the stated error in rank, and exact for few rows."""
    base = spark.range(n).select(F.lit("T").alias("ev"), (F.lit(1_700_000_000_000) + F.col("id") % 300_000).alias("t"), (F.abs(F.hash("id")) % 5000).cast("long").alias("ms"))
    rows = base.withColumn("ts", F.timestamp_millis("t")).withColumn("received", F.timestamp_millis(F.col("t") + F.col("ms")))
    found = E.latency_quantiles(E.stream_latency(rows), "ev").first()
    values = sorted(r.ms for r in base.select("ms").collect())
    assert found.n == n

    for q, v in ((0.5, found.p50), (0.95, found.p95), (0.99, found.p99)):
        if n <= E.SKETCH:
            assert v == values[max(0, -int(-q * n // 1) - 1)]
        low, high = bisect.bisect_left(values, v) / n, bisect.bisect_right(values, v) / n
        assert low - E.SKETCH_ERROR <= q <= high + E.SKETCH_ERROR
