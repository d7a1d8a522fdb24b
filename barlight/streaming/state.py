"""Streams with state of their own: books by level, totals with different tickers, bars in order of events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WATERMARK = "10 seconds"

#: Keyed state needs this store, whose state lies on disk and not in the heap.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> None:
    """The session's streams keep their state in the store that maps and lists need. To be called before they start."""
    spark.conf.set(STORE, ROCKS)


class _Book(StatefulProcessor):
    """A map of a pair's levels; the last update of each counts, and one not updated for `keep_ms` goes."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "side string, price double", "size double, at long, received long")
        self.newest = handle.getValueState("newest", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        order = ["timestamp", "received_timestamp", "size"]
        new = pd.concat([f.sort_values(order).groupby(["side", "price"], as_index=False).last() for f in rows])
        new = new.sort_values(order).groupby(["side", "price"], as_index=False).last()
        for side, price, size, at, received in zip(new["side"], new["price"], new["size"], new["timestamp"], new["received_timestamp"], strict=True):
            level, update = (side, float(price)), (float(size), int(at), int(received))
            held = self.levels.getValue(level) if self.levels.containsKey(level) else None
            if held is None or (held[1], held[2], held[0]) <= (update[1], update[2], update[0]):
                self.levels.updateValue(level, update)
        newest = max(int(new["timestamp"].max()), self.newest.get()[0] if self.newest.exists() else 0)
        self.newest.update((newest,))
        best = {"bid": (None, None, 0), "ask": (None, None, 0)}
        gone = []
        for (side, price), (size, at, _) in self.levels.iterator():
            if at < newest - self.keep_ms:
                gone.append((side, price))
            elif size > 0:
                p, s, n = best[side]
                better = p is None or (price > p if side == "bid" else price < p)
                best[side] = (price if better else p, size if better else s, n + 1)
        for level in gone:
            self.levels.removeKey(level)
        bid, ask = best["bid"], best["ask"]
        yield pd.DataFrame({"pair": [key[0]], "at": [newest], "best_bid": [bid[0]], "bid_size": [bid[1]], "best_ask": [ask[0]], "ask_size": [ask[1]], "bid_levels": [bid[2]], "ask_levels": [ask[2]]}).astype({"best_bid": float, "bid_size": float, "best_ask": float, "ask_size": float})

    def close(self) -> None:
        pass


def live_books(levels: DataFrame, keep: str = "1 day") -> DataFrame:
    """Best bid and ask of each pair and the numbers of its levels after each batch, from a stream of levels().

    The last update of a level counts, by timestamp, then receipt, then size; size 0 takes it away (the zero is
    kept, so that an older update that comes later doesn't bring it back). Levels not updated for `keep`
    before the pair's newest update are forgotten. A pair's levels are one key's state, on disk.
    """
    with_state_store(levels.sparkSession)
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    rows = levels.select("pair", "side", "price", "size", "timestamp", F.coalesce("received_timestamp", "timestamp").alias("received_timestamp")).where("pair is not null and timestamp is not null")
    schema = "pair string, at long, best_bid double, bid_size double, best_ask double, ask_size double, bid_levels long, ask_levels long"
    return rows.groupBy("pair").transformWithStateInPandas(_Book(keep_ms), schema, "update", "None")


class _Totals(StatefulProcessor):
    """Trades, cash and the set of symbols of a shard."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "trades long, cash double, tickers long")
        self.seen = handle.getMapState("seen", "symbol string", "since long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        trades, cash, tickers = self.sums.get() if self.sums.exists() else (0, 0.0, 0)
        for f in rows:
            trades, cash = trades + len(f), cash + float((f["price"] * f["size"]).sum())
            for symbol in f["symbol"].unique():
                if not self.seen.containsKey((symbol,)):
                    self.seen.updateValue((symbol,), (trades,))
                    tickers += 1
        self.sums.update((trades, cash, tickers))
        yield pd.DataFrame({"shard": [key[0]], "trades": [trades], "cash": [cash], "tickers": [tickers]})

    def close(self) -> None:
        pass


def live_totals(trades: DataFrame, shards: int = 64) -> DataFrame:
    """Trades, cash and different tickers so far of each shard of symbols that a batch changed; see totals_after().

    A symbol has one shard, so different tickers add up. The state survives restarts in the checkpoint.
    Trades without a symbol are counted in no shard; those without price or size add no cash.
    """
    with_state_store(trades.sparkSession)
    rows = trades.where("symbol is not null").select(F.pmod(F.xxhash64("symbol"), F.lit(shards)).alias("shard"), "symbol", F.coalesce("price", F.lit(0.0)).alias("price"), F.coalesce("size", F.lit(0.0)).cast("double").alias("size"))
    return rows.groupBy("shard").transformWithStateInPandas(_Totals(), "shard long, trades long, cash double, tickers long", "update", "None")


def totals_after(updates: DataFrame, batch: int | None = None) -> DataFrame:
    """Totals after a batch (the last one, if None) from the written updates of live_totals(), each with its batch."""
    so_far = updates if batch is None else updates.where(F.col("batch") <= batch)
    last = so_far.groupBy("shard").agg(F.max_by(F.struct("trades", "cash", "tickers"), "batch").alias("l"))
    return last.agg(F.coalesce(F.sum("l.trades"), F.lit(0)).alias("trades"), F.coalesce(F.sum("l.cash"), F.lit(0.0)).alias("cash"), F.coalesce(F.sum("l.tickers"), F.lit(0)).alias("tickers"))


_BAR = "symbol string, bucket long, trades long, volume double, buy_volume double, sell_volume double, final boolean"
_HELD = "price double, n long, volume double, buy double, sell double, at array<long>, sequence array<long>, prices array<double>, sizes array<double>"


def stream_trade_bars(trades: DataFrame, minutes: int = 1) -> DataFrame:
    """Count, volume and tick-rule volumes of each symbol and bucket, in order of time and sequence whatever batch a row comes in.

    Rows wait in the bucket's state until the watermark has passed them, as rows before them may still come;
    then they go, in order, against the last price that went. So the state holds little more than the
    watermark's delay of rows. An update after each batch takes the rows that wait into account as well;
    it is `final` when the watermark has passed the bucket, whose state then goes. Later rows are dropped by
    Spark, which counts them in the query's progress.
    """
    size = minutes * 60_000

    def gone(last: tuple, at: np.ndarray, sequence: np.ndarray, prices: np.ndarray, sizes: np.ndarray) -> tuple:
        """(price, n, volume, buy, sell) after the rows in order."""
        if not len(at):
            return last
        order = np.lexsort((sequence, at))
        prices, sizes = prices[order], sizes[order]
        price, n, volume, buy, sell = last
        step = np.diff(prices, prepend=prices[0] if price is None else price)
        return float(prices[-1]), n + len(at), volume + float(sizes.sum()), buy + float(sizes[step > 0].sum()), sell + float(sizes[step < 0].sum())

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        if state.exists:
            *last, at, sequence, prices, sizes = state.get
        else:
            last, at, sequence, prices, sizes = [None, 0, 0.0, 0.0, 0.0], [], [], [], []
        held = [np.array(at, np.int64), np.array(sequence, np.int64), np.array(prices, float), np.array(sizes, float)]
        timed_out = state.hasTimedOut
        if not timed_out:
            new = pd.concat(frames)
            held = [np.concatenate([h, new[c].to_numpy(h.dtype)]) for h, c in zip(held, ("at", "sequence", "price", "size"), strict=True)]
        whole = gone(tuple(last), *held)
        if timed_out:
            state.remove()
        else:
            passed = held[0] < watermark * 1000  # micros
            last = gone(tuple(last), *(h[passed] for h in held))
            state.update((*last, *(h[~passed].tolist() for h in held)))
            state.setTimeoutTimestamp(max(int(key[1]) + size, watermark + 1))
        _, n, volume, buy, sell = whole
        yield pd.DataFrame({"symbol": [key[0]], "bucket": [key[1]], "trades": [n], "volume": [volume], "buy_volume": [buy], "sell_volume": [sell], "final": [timed_out]})

    bucket = (F.unix_millis("ts") - F.pmod(F.unix_millis("ts"), F.lit(size))).alias("bucket")
    keyed = trades.withWatermark("ts", WATERMARK).where("symbol is not null and price is not null")
    keyed = keyed.select("symbol", "ts", F.unix_micros("ts").alias("at"), "price", F.coalesce("size", F.lit(0)).cast("double").alias("size"), F.coalesce("sequence", F.lit(0)).cast("long").alias("sequence"), bucket)
    return keyed.groupBy("symbol", "bucket").applyInPandasWithState(step, _BAR, _HELD, "update", "EventTimeTimeout")
