"""Measures that run through a ticker's rows in order, without a task for the whole ticker.

A ticker's rows are cut into slices of time. Each slice is one piece of work: it gives a summary (a last
value, a sum, or factor and offset of a recurrence). The summaries, a row a slice, are put together in
order of the slices, and what a slice takes over from those before is joined to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seconds of a slice. A slice's rows are sorted in one task; each costs a row among the summaries.
SLICE_SECONDS = 86_400


def slice_number(rows: DataFrame, ts: str, seconds: int = SLICE_SECONDS) -> Column:
    """The slice of a time: of a timestamp, with or without zone, or of a number of nanoseconds."""
    kind = rows.schema[ts].dataType
    if isinstance(kind, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")
    elif isinstance(kind, T.TimestampType):
        micros = F.unix_micros(ts)
    else:
        micros = (F.col(ts) / 1000).cast("long")
    return F.floor(micros / (seconds * 1_000_000)).cast("long")


def _joined(rows: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """rows with what their slice takes over; both have slice_no."""
    names = {key: "of_key", "slice_no": "of_slice"}
    side = before.select(*(F.col(c).alias(names.get(c, c)) for c in before.columns))
    return rows.join(side, F.col(key).eqNullSafe(F.col("of_key")) & F.col("slice_no").eqNullSafe(F.col("of_slice")), "left").drop("of_key", "of_slice")


def last_known(rows: DataFrame, columns: list[str], key: str, order: list[str], seconds: int = SLICE_SECONDS, inclusive: bool = True) -> DataFrame:
    """rows with the last non-null value so far of each of columns, as known_<column>, in order of `order`, whose first is a time.

    inclusive: whether a row's own value counts. Rows that are equal in order come in any.
    """
    cut = rows.withColumn("slice_no", slice_number(rows, order[0], seconds))
    at = F.struct(*(F.col(c) for c in order))
    ends = cut.groupBy(key, "slice_no").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"end_{c}") for c in columns))
    slices = Window.partitionBy(key).orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(key, "slice_no", *(F.last(f"end_{c}", ignorenulls=True).over(slices).alias(f"before_{c}") for c in columns))
    inside = Window.partitionBy(key, "slice_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = _joined(cut, before, key)
    for c in columns:
        out = out.withColumn(f"known_{c}", F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"before_{c}")))
    return out.drop("slice_no", *(f"before_{c}" for c in columns))


def running_sum(rows: DataFrame, column: str, out: str, key: str, order: list[str], seconds: int = SLICE_SECONDS) -> DataFrame:
    """rows with the sum so far of a column, in order of `order`, whose first is a time; null until it has a value."""
    cut = rows.withColumn("slice_no", slice_number(rows, order[0], seconds))
    sums = cut.groupBy(key, "slice_no").agg(F.sum(column).alias("slice_sum"))
    slices = Window.partitionBy(key).orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(key, "slice_no", F.sum("slice_sum").over(slices).alias("sum_before"))
    inside = F.sum(column).over(Window.partitionBy(key, "slice_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    total = F.when(inside.isNull(), F.col("sum_before")).otherwise(inside + F.coalesce("sum_before", F.lit(0)))
    return _joined(cut, before, key).withColumn(out, total).drop("slice_no", "sum_before")


def cumulative_delta(ticks: DataFrame, key: str = "ticker", order: tuple[str, ...] = ("sip_ns", "sequence"), seconds: int = 3600) -> DataFrame:
    """ticks with side (1 where the price is above the trade before, -1 below, else 0) and the sum so far of size * side."""
    sided = last_known(ticks, ["price"], key, list(order), seconds, inclusive=False)
    sided = sided.withColumn("side", F.coalesce(F.signum(F.col("price") - F.col("known_price")), F.lit(0.0))).drop("known_price")
    return running_sum(sided.withColumn("signed", F.col("size") * F.col("side")), "signed", "cumulative_delta", key, list(order), seconds).drop("signed")


def decayed(values: np.ndarray, place: np.ndarray, keep: float) -> np.ndarray:
    """y[i] = values[i] + keep * y[i - 1] inside runs; place: 0, 1, ... from each run's begin. By doubling, until what is kept is nothing."""
    y, step, power = values.copy(), 1, keep
    while step < len(y) and power > 1e-19:
        y[step:] += np.where(place[step:] >= step, power * y[:-step], 0.0)
        step, power = step * 2, power * power
    return y


def _local(batches: Iterator[pa.RecordBatch], spans: dict[str, int], column: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the decayed sum of each span in their slice. row_no and values_so_far count from the slice's begin."""
    count, carried = 0, dict.fromkeys(spans, 0.0)  # of the slice that goes on from the batch before
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).cast(pa.float64())
        has = values.is_valid().to_numpy(zero_copy_only=False)
        x = values.to_numpy(zero_copy_only=False)[has]
        number = batch.column("values_so_far").to_numpy()
        goes_on = np.cumsum(batch.column("row_no").to_numpy() == 1) == 0
        last = np.cumsum(has) - 1  # place of the last value, in this batch
        out = {}
        for name, span in spans.items():
            keep = 1 - 2 / (span + 1)
            y = decayed(x * (1 - keep), number[has] - 1, keep)
            y += np.where(goes_on[has], carried[name] * keep ** (number[has] - count), 0.0)
            here = number > np.where(goes_on, count, 0)
            out[name] = np.where(here, y[last] if len(y) else 0.0, np.where(goes_on, carried[name], 0.0))
            carried[name] = float(out[name][-1])
        count = int(number[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[f], pa.float64()) for f in spans)], [*batch.schema.names, *(f"local_{f}" for f in spans)])


def with_ema(bars: DataFrame, spans: dict[str, int], column: str = "close", key: str = "ticker", ts: str = "ts", seconds: int = SLICE_SECONDS) -> DataFrame:
    """Exponential means that begin at a ticker's first value: e = a * x + (1 - a) * e, a = 2 / (span + 1). Nulls leave the mean as it is.

    A slice's rows give the decayed sum y of its own m values; with the mean e before the slice, the mean is
    y + (1 - a) ** m * e. So a slice's end is known from (m, y), and slices follow each other from the
    ticker's first value.
    """
    cut = bars.withColumn("slice_no", slice_number(bars, ts, seconds))
    inside = Window.partitionBy(key, "slice_no").orderBy(ts)
    counted = cut.withColumn("row_no", F.row_number().over(inside)).withColumn("values_so_far", F.count(column).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    extra = [T.StructField(f"local_{f}", T.DoubleType()) for f in spans]
    # A window's rows come sorted by its keys and order.
    local = counted.mapInArrow(lambda b: _local(b, spans, column), T.StructType([*counted.schema.fields, *extra]))
    end = F.col("row_no")
    ends = local.groupBy(key, "slice_no").agg(F.max("values_so_far").alias("m"), *(F.max_by(f"local_{f}", end).alias(f"y_{f}") for f in spans), F.min_by(column, F.when(F.col(column).isNotNull(), F.col(ts))).cast("double").alias("first"))
    kind = bars.schema[key].dataType.simpleString()
    carried = ", ".join(f"before_{f} double" for f in spans)

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slice_no", na_position="first")
        known = rows["first"].dropna()
        out = {key: rows[key], "slice_no": rows["slice_no"]}
        for f, span in spans.items():
            keep, e = 1 - 2 / (span + 1), known.iloc[0] if len(known) else np.nan
            before = []
            for m, y in zip(rows["m"].to_numpy(), rows[f"y_{f}"].to_numpy(), strict=True):
                before.append(e)
                e = y + keep**m * e if m else e
            out[f"before_{f}"] = before
        return pd.DataFrame(out)

    before = ends.groupBy(key).applyInPandas(follow, f"`{key}` {kind}, slice_no long, {carried}")
    # Before a ticker's first value there is no mean; the first slice with one begins from it.
    values = Window.partitionBy(key).orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    started = ends.select(F.col(key).alias("s_key"), F.col("slice_no").alias("s_slice"), (F.coalesce(F.sum("m").over(values), F.lit(0)) > 0).alias("started"))
    before = before.join(started, F.col(key).eqNullSafe(F.col("s_key")) & F.col("slice_no").eqNullSafe(F.col("s_slice"))).drop("s_key", "s_slice")
    out = _joined(local, before, key)
    for f, span in spans.items():
        mean = F.col(f"local_{f}") + F.pow(F.lit(1 - 2 / (span + 1)), F.col("values_so_far")) * F.col(f"before_{f}")
        out = out.withColumn(f, F.when(F.col("values_so_far") > 0, mean).when(F.col("started"), F.col(f"before_{f}")))
    return out.select(*bars.columns, *spans)


#: Bins of a histogram that quantiles are narrowed down by.
BINS = 4096

#: The largest finite number.
MOST = float(np.finfo(float).max)


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of numeric columns, exactly, by histograms of BINS bins narrowed down until a bin has one value.

    Nulls and NaN don't count; a column without values has no quantiles. Each pass counts the values of
    the bins inside the ranges that still matter, a partial aggregation to BINS rows a range, which come to the
    driver with the least and largest value of each bin. The first pass is by sign and logarithm, so that
    values of any magnitude are near their bin's others after it. The rows are read once for each pass, a
    few in all, so df should be a table, and not the result of much work.
    """
    usable = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    x = lambda c: F.when(usable(c), F.col(c).cast("double"))
    first = df.agg(*(f(x(c)).alias(f"{n}{k}") for k, c in enumerate(columns) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max)))).first()
    found: dict[tuple[int, int], float] = {}
    # (column, lowest, highest): ranks wanted of the values inside, from 0, and those of the column.
    open_: dict[tuple[int, float, float], list[tuple[int, int]]] = {}
    for k in range(len(columns)):
        n = first[f"n{k}"]
        ranks = sorted({r for p in shares for r in (int(np.floor(p * (n - 1))), int(np.ceil(p * (n - 1))))}) if n else []
        if n:
            open_[k, first[f"lo{k}"], first[f"hi{k}"]] = [(r, r) for r in ranks]
    logarithm = True
    while open_:
        for (k, lo, hi), ranks in list(open_.items()):
            if lo == hi:
                found |= {(k, r): lo for _, r in ranks}
                del open_[k, lo, hi]
        if not open_:
            break
        finite = lambda v: F.greatest(F.least(v, F.lit(MOST)), F.lit(-MOST))
        scale = (lambda v: F.signum(v) * F.log1p(F.abs(finite(v)))) if logarithm else finite
        ranges = list(open_)
        parts = []
        for number, (k, lo, hi) in enumerate(ranges):
            v = F.col(columns[k]).cast("double")
            low, high = scale(F.lit(lo)), scale(F.lit(hi))
            # Halves keep the width of the widest range finite. The ends have bins of their own, so a pass always narrows.
            at = F.when(high > low, (scale(v) / 2 - low / 2) / (high / 2 - low / 2) * BINS).otherwise(0.0)
            bin_ = F.when(v == lo, 0).when(v == hi, BINS - 1).otherwise(F.least(F.floor(at), F.lit(BINS - 1)))
            parts.append(F.when(usable(columns[k]) & v.between(lo, hi), F.struct(F.lit(number).alias("range"), bin_.cast("int").alias("bin"), v.alias("v"))))
        rows = df.select(F.explode(F.filter(F.array(*parts), lambda s: s.isNotNull())).alias("s")).select("s.*")
        bins = rows.groupBy("range", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).toPandas().sort_values(["range", "lo"])
        narrowed: dict[tuple[int, float, float], list[tuple[int, int]]] = {}
        for number, (k, lo, hi) in enumerate(ranges):
            mine = bins[bins["range"] == number]
            ends = mine["n"].to_numpy().cumsum()
            for inside, r in open_[k, lo, hi]:
                b = int(np.searchsorted(ends, inside, "right"))
                narrowed.setdefault((k, float(mine["lo"].iloc[b]), float(mine["hi"].iloc[b])), []).append((inside - int(ends[b] - mine["n"].iloc[b]), r))
        open_, logarithm = narrowed, False
    out: dict[str, list[float]] = {}
    for k, c in enumerate(columns):
        n, values = first[f"n{k}"], []
        for p in shares if n else []:
            at = p * (n - 1)
            low, high = int(np.floor(at)), int(np.ceil(at))
            values.append(found[k, low] if low == high else (high - at) * found[k, low] + (at - low) * found[k, high])
        out[c] = values
    return out


def correlation_blocks(returns: DataFrame, key: str = "ticker", ts: str = "ts", value: str = "r", blocks: int = 16, seconds: int = 30 * SLICE_SECONDS) -> DataFrame:
    """(a, b, corr) of all pairs a < b of keys, from rows of the times at which every key has a value.

    Keys are dealt to blocks, times to slices. A row goes to each pair of blocks that its own is in, and a pair
    of blocks gives the products of its two matrices (times by keys) for a slice of time, which are summed. So
    rows are copied once a block and not once a key; a task holds two blocks in one slice.
    """
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda j: F.struct(F.least(block, j).alias("i"), F.greatest(block, j).alias("j"))))
    dealt = returns.select(F.col(key).alias("k"), F.col(ts).alias("t"), F.col(value).cast("double").alias("r"), slice_number(returns, ts, seconds).alias("slice_no"), block.alias("block"), pairs.alias("p"))
    dealt = dealt.select("k", "t", "r", "slice_no", "block", "p.*")
    kind = returns.schema[key].dataType.simpleString()

    def products(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        m = rows.pivot(index="t", columns="k", values="r")
        of = rows.groupby("k")["block"].first()
        left, right = [k for k in m.columns if of[k] == i], [k for k in m.columns if of[k] == j]
        a, b = m[left].to_numpy(), m[right].to_numpy()
        both = a.T @ b
        n = float(len(m))
        x, y = np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij")
        x, y = x.ravel(), y.ravel()
        names_a, names_b = np.array(left, object)[x], np.array(right, object)[y]
        out = pd.DataFrame({"a": names_a, "b": names_b, "n": n, "sa": a.sum(0)[x], "sb": b.sum(0)[y], "saa": (a * a).sum(0)[x], "sbb": (b * b).sum(0)[y], "sab": both.ravel()})
        turned = out["a"] > out["b"]
        out.loc[turned, ["a", "b", "sa", "sb", "saa", "sbb"]] = out.loc[turned, ["b", "a", "sb", "sa", "sbb", "saa"]].to_numpy()
        return out[(out["a"] != out["b"]) & ~(turned & (i == j))]

    sums = dealt.groupBy("i", "j", "slice_no").applyInPandas(products, f"a {kind}, b {kind}, n double, sa double, sb double, saa double, sbb double, sab double")
    total = sums.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")))
    n = F.col("n")
    over = F.col("sab") - F.col("sa") * F.col("sb") / n
    under = F.sqrt((F.col("saa") - F.col("sa") * F.col("sa") / n) * (F.col("sbb") - F.col("sb") * F.col("sb") / n))
    return total.select("a", "b", F.when(n > 0, over / F.nullif(under, F.lit(0.0))).alias("corr"))
