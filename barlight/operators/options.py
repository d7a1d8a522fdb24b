"""Option contracts, chains and features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.functions.scalars import expiry_type, safe_divide


def price_range(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.min("close").alias("min_close"), F.max("close").alias("max_close"))


def discover_contracts(contracts: DataFrame, bars: DataFrame, moneyness: float = 0.2) -> DataFrame:
    """Contracts whose strike is within moneyness of the middle of the ticker's range of closes."""
    mid = price_range(bars).select("ticker", ((F.col("min_close") + F.col("max_close")) / 2).alias("mid"))
    return contracts.join(mid, "ticker").where((F.col("strike") >= F.col("mid") * (1 - moneyness)) & (F.col("strike") <= F.col("mid") * (1 + moneyness))).drop("mid")


def valid_contracts(chains: DataFrame) -> DataFrame:
    return chains.where("strike is not null and close > 0 and dte >= 1")


def intrinsic(kind: Column, s: Column, k: Column) -> Column:
    return F.greatest(F.when(kind == "C", s - k).otherwise(k - s), F.lit(0.0))


def has_time_premium(chains: DataFrame) -> DataFrame:
    return chains.where((F.col("close") > intrinsic(F.col("type"), F.col("underlying"), F.col("strike"))) & (F.col("dte") > 0) & (F.col("close") > 0) & (F.col("underlying") > 0))


def chain_enrich(chains: DataFrame, day: str = "day") -> DataFrame:
    """dte, expiry_type, moneyness, intrinsic, extrinsic and mid."""
    s, k = F.col("underlying"), F.col("strike")
    out = chains.withColumn("dte", F.greatest(F.datediff("expiry", day), F.lit(0)))
    out = out.withColumn("expiry_type", expiry_type(F.col("expiry"), F.col("dte"))).withColumn("moneyness", safe_divide(s, k)).withColumn("intrinsic", intrinsic(F.col("type"), s, k))
    return out.withColumn("extrinsic", F.greatest(F.col("close") - F.col("intrinsic"), F.lit(0.0))).withColumn("mid", F.col("close"))


def option_features(chains: DataFrame, keys: tuple[str, ...] = ("ticker", "ts")) -> DataFrame:
    """At-the-money straddle, volumes and ratios of each underlying and bar, in one aggregation after one window.

    chains: keys, underlying, strike, type, close, volume, dte, symbol. Of several bars of one strike and
    type the last by (dte, symbol) counts.
    """
    w = Window.partitionBy(*keys)
    gap = F.abs(F.col("strike") - F.col("underlying"))
    atm = chains.withColumn("atm", F.min(F.struct(gap, "strike")).over(w)["strike"])
    at, order = F.col("strike") == F.col("atm"), F.struct("dte", "symbol")
    pick = lambda kind, c: F.max_by(c, F.when(at & (F.col("type") == kind), order))
    vol = lambda kind: F.sum(F.when(F.col("type") == kind, F.col("volume")).otherwise(0.0))
    out = atm.groupBy(*keys).agg(F.first("atm").alias("atm_strike"), pick("C", "close").alias("call_close"), pick("P", "close").alias("put_close"), vol("P").alias("put_volume"), vol("C").alias("call_volume"), F.countDistinct("strike").alias("contract_count"), F.coalesce(pick("C", "dte"), pick("P", "dte")).alias("atm_dte"))
    straddle = F.col("call_close") + F.col("put_close")
    return out.withColumn("straddle", straddle).withColumn("expected_move", straddle).withColumn("pcr", safe_divide(F.col("put_volume"), F.col("call_volume")))


def iv30d_contract(chains: DataFrame, keys: tuple[str, ...] = ("ticker", "ts"), target: int = 30, near: float = 0.02) -> DataFrame:
    """The contract of dte >= 1 within 2 % of the money whose dte is nearest to 30."""
    close = chains.where((F.col("dte") >= 1) & (F.abs(F.col("strike") - F.col("underlying")) <= near * F.col("underlying")))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.abs(F.col("dte") - target), "dte", F.abs(F.col("strike") - F.col("underlying")), "symbol"))
    return close.withColumn("n", n).where("n = 1").drop("n")


def chain_iv30d(chains: DataFrame, keys: tuple[str, ...] = ("ticker", "ts"), target: int = 30, near: float = 0.02) -> DataFrame:
    """The strike nearest to the money among those of the dte nearest to 30: those within 2 % if there are any."""
    w = Window.partitionBy(*keys)
    dte = F.min(F.struct(F.abs(F.col("dte") - target), "dte")).over(w)["dte"]
    mine = chains.withColumn("d", dte).where("dte = d").withColumn("gap", F.abs(F.col("strike") - F.col("underlying")))
    inside = (F.col("gap") <= near * F.col("underlying")).cast("int")
    mine = mine.withColumn("n", F.row_number().over(w.orderBy(F.desc(inside), "gap", "strike", "type", "symbol")))
    return mine.where("n = 1").drop("n", "d", "gap")


def option_quote_features(quotes: DataFrame, keys: tuple[str, ...] = ("ticker", "bucket")) -> DataFrame:
    spread = F.col("ask_price") - F.col("bid_price")
    both = F.col("bid_size") + F.col("ask_size")
    return quotes.groupBy(*keys).agg(F.avg(F.when(spread >= 0, spread)).alias("mean_spread"), F.avg("bid_size").alias("mean_bid_size"), F.avg("ask_size").alias("mean_ask_size"), F.avg(safe_divide(F.col("bid_size") - F.col("ask_size"), both)).alias("mean_imbalance"))


def chain_daily_features(chains: DataFrame, keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """Mean IV, gamma exposure, put less call IV, delta sum, vega-weighted IV."""
    mean = lambda kind: F.avg(F.when(F.col("type") == kind, F.col("iv")))
    return chains.groupBy(*keys).agg(F.avg("iv").alias("mean_iv"), F.sum(F.abs("gamma") * F.col("volume")).alias("gamma_exposure"), (mean("P") - mean("C")).alias("iv_skew"), F.sum("delta").alias("delta_sum"), (F.sum(F.col("iv") * F.col("vega")) / F.nullif(F.sum("vega"), F.lit(0.0))).alias("vega_weighted_iv"))


def chain_snapshot_features(snapshot: DataFrame, keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """Open interest, volumes and exposures of a chain: gex and dex are sums of greek * open interest * S * 100, null if 0."""
    exposure = lambda g: F.nullif(F.sum(F.col(g) * F.col("open_interest") * F.col("underlying") * 100), F.lit(0.0))
    of = lambda kind, c: F.sum(F.when(F.col("type") == kind, F.col(c)).otherwise(0.0))
    out = snapshot.groupBy(*keys).agg(exposure("gamma").alias("gex"), exposure("delta").alias("dex"), of("C", "volume").alias("call_volume"), of("P", "volume").alias("put_volume"), of("C", "open_interest").alias("call_oi"), of("P", "open_interest").alias("put_oi"), F.sum("open_interest").alias("total_oi"))
    return out.withColumn("pcr", safe_divide(F.col("put_volume"), F.col("call_volume")))


def iv_term_structure(chains: DataFrame, targets: tuple[int, ...] = (7, 30, 60, 90), keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """IV of the contract nearest to each target in days, then nearest to the money; one shuffle for all targets."""
    gap = F.abs(F.col("strike") - F.col("underlying"))
    return chains.groupBy(*keys).agg(*(F.min_by("iv", F.struct(F.abs(F.col("dte") - t), "dte", gap, "strike", "symbol")).alias(f"iv_{t}d") for t in targets))


def iv_at_delta(chains: DataFrame, kind: str, target: float, name: str, keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    """IV at a delta, between the two contracts whose deltas are nearest to it."""
    near = F.row_number().over(Window.partitionBy(*keys).orderBy(F.abs(F.col("delta") - target), "symbol"))
    two = chains.where(F.col("type") == kind).where("delta is not null and iv is not null").withColumn("n", near).where("n <= 2")
    v = lambda c, k: F.max(F.when(F.col("n") == k, F.col(c)))
    out = two.groupBy(*keys).agg(*(v(c, k).alias(f"{c}{k}") for c in ("delta", "iv") for k in (1, 2)))
    slope = safe_divide(F.col("iv2") - F.col("iv1"), F.col("delta2") - F.col("delta1"))
    return out.select(*keys, F.coalesce(F.col("iv1") + slope * (F.lit(target) - F.col("delta1")), F.col("iv1")).alias(name))


def skew_25d(chains: DataFrame, keys: tuple[str, ...] = ("ticker", "day")) -> DataFrame:
    put, call = iv_at_delta(chains, "P", -0.25, "put_iv", keys), iv_at_delta(chains, "C", 0.25, "call_iv", keys)
    return put.join(call, list(keys), "full").withColumn("skew", F.col("put_iv") - F.col("call_iv"))


def interp_rate(rows: DataFrame, curve: DataFrame, tenors: dict[str, int], date: str = "day", default: float = 4.0) -> DataFrame:
    """Rate by straight line between tenors in days; ends are kept, a rate that isn't positive takes the larger end; /100.

    The curve's tenors are columns, so this is one row expression after asof_yield_join.
    """
    from barlight.operators.joins import asof_yield_join

    joined = asof_yield_join(rows, curve, date)
    names = sorted(tenors, key=tenors.get)
    d = F.col("dte")
    rate = F.col(names[-1])
    for a, b in reversed(list(zip(names, names[1:], strict=False))):
        ra, rb = F.col(a), F.col(b)
        line = ra + (rb - ra) * (d - tenors[a]) / (tenors[b] - tenors[a])
        bad = (ra <= 0) | (rb <= 0) | ra.isNull() | rb.isNull()
        rate = F.when(d <= tenors[b], F.when(bad, F.greatest(ra, rb)).otherwise(line)).otherwise(rate)
    rate = F.when(d <= tenors[names[0]], F.col(names[0])).otherwise(rate)
    return joined.withColumn("rate", F.coalesce(rate, F.lit(default)) / 100).drop(*names, "curve_date")


#: Values of the error function on a grid, from which _erf() interpolates by cubics (off by less than 1e-11).
_STEP = 1 / 256
_GRID = np.array([math.erf(k * _STEP) for k in range(int(6.5 / _STEP) + 2)])
_SLOPE = 2 / math.sqrt(math.pi) * np.exp(-((np.arange(len(_GRID)) * _STEP) ** 2)) * _STEP


def _erf(x: np.ndarray) -> np.ndarray:
    size = np.minimum(np.nan_to_num(np.abs(x), nan=0.0), 6.5) / _STEP
    k = size.astype(np.int64)
    t = size - k
    a, b, da, db = _GRID[k], _GRID[k + 1], _SLOPE[k], _SLOPE[k + 1]
    return np.copysign(a + t * (da + t * (3 * (b - a) - 2 * da - db + t * (2 * (a - b) + da + db))), x)


def _cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / math.sqrt(2)))


def _density(x: np.ndarray) -> np.ndarray:
    return np.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def _implied(s: np.ndarray, k: np.ndarray, r: np.ndarray, price: np.ndarray, t: np.ndarray, call: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Volatility by Newton's steps, and where it was found. A row that is solved, or can't move, takes no further step."""
    v, solved = np.full(len(s), 0.3), np.zeros(len(s), bool)
    root, disc = np.sqrt(t), k * np.exp(-r * t)
    lead = np.log(s / k) + r * t
    open_ = np.flatnonzero((s > 0) & (k > 0) & (price > 0) & (t > 0) & (price > np.maximum(np.where(call, s - k, k - s), 0)))
    for _ in range(20):
        if not len(open_):
            break
        now, w = v[open_], root[open_]
        d1 = (lead[open_] + now * now / 2 * t[open_]) / (now * w)
        put = np.where(call[open_], 0.0, 1.0)
        model = s[open_] * (_cdf(d1) - put) - disc[open_] * (_cdf(d1 - now * w) - put)
        vega = s[open_] * _density(d1) * w
        gap = model - price[open_]
        hit = np.abs(gap) < 1e-4
        solved[open_[hit]] = True
        go = ~hit & (vega > 1e-10)
        v[open_[go]] = np.clip(now[go] - gap[go] / vega[go], 0.001, 5)
        open_ = open_[go]
    return v, solved


GREEKS = ("iv", "delta", "gamma", "theta", "vega", "rho")


def _greeks(pdf: pd.DataFrame, prefix: str = "") -> pd.DataFrame:
    """Implied volatility and greeks of the columns with a prefix; null where a row has no time premium or no solution."""
    number = lambda c: pd.to_numeric(pdf[c]).to_numpy(float, na_value=np.nan)
    s, k, r, price, t = number("underlying"), number(f"{prefix}strike"), number("rate"), number(f"{prefix}close"), number(f"{prefix}dte") / 365
    call = (pdf[f"{prefix}type"] == "C").to_numpy(bool)
    with np.errstate(all="ignore"):
        v, solved = _implied(s, k, r, price, t, call)
        root, disc = np.sqrt(t), k * np.exp(-r * t)
        d1 = (np.log(s / k) + (r + v * v / 2) * t) / (v * root)
        d2 = d1 - v * root
        slope = _density(d1)
        theta = -s * slope * v / (2 * root) + np.where(call, -r * disc * _cdf(d2), r * disc * _cdf(-d2))
        out = {"iv": v, "delta": _cdf(d1) - np.where(call, 0.0, 1.0), "gamma": slope / (s * v * root), "theta": theta / 365, "vega": s * slope * root / 100, "rho": np.where(call, _cdf(d2), -_cdf(-d2)) * disc * t / 100}
    return pdf.assign(**{prefix + n: pd.Series(np.where(solved, np.round(x, 6), np.nan), index=pdf.index).astype(object).where(solved, None) for n, x in out.items()})


def _with_greeks(rows: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in prefixes:
                pdf = _greeks(pdf, p)
            yield pdf

    added = [T.StructField(p + n, T.DoubleType()) for p in prefixes for n in GREEKS]
    rest = rows.drop(*(f.name for f in added))
    return rest.mapInPandas(run, T.StructType([*rest.schema.fields, *added]))


def enrich_greeks(chains: DataFrame) -> DataFrame:
    """iv, delta, gamma, theta, vega and rho from underlying, strike, rate, close, dte and type, batch by batch."""
    return _with_greeks(chains, ("",))


def greeks_job(chains: DataFrame, curve: DataFrame, minutes: DataFrame, tenors: dict[str, int]) -> DataFrame:
    """Chains as they were stored, with underlying and rate filled in and the greeks of each row.

    chains: symbol, ticker (of the underlying), ts, strike, dte, type, close, underlying (null where it wasn't known) and
    any other columns. curve: date and rates in percent by tenor. minutes: ticker, minute, close. A missing
    underlying is the close of the row's minute, or the last one that the contract had before; rows
    that still have none, no price, no time or no time premium keep null greeks. The rate is that of the curve at or before the
    row's day, by straight line between tenors.
    """
    from barlight.operators.joins import minute_backfill_join

    # Rows that have their underlying don't go through the join.
    filled = chains.where("underlying is not null").unionByName(minute_backfill_join(chains.where("underlying is null"), minutes))
    # A contract has few rows a day, so slices of its time would be as many as its rows; all of it is sorted in one task instead.
    so_far = Window.partitionBy("symbol").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    filled = filled.withColumn("underlying", F.last("underlying", ignorenulls=True).over(so_far))
    rated = interp_rate(filled.withColumn("curve_day", F.to_date("ts")), curve, tenors, "curve_day").drop("curve_day")
    return enrich_greeks(rated)


def enrich_feature_greeks(features: DataFrame, contracts: tuple[str, ...]) -> DataFrame:
    """The same for several contracts of one row: prefix_strike, prefix_close, prefix_dte, prefix_type with underlying and rate.

    Rows stay as they are, repeated ones too: nothing is shuffled.
    """
    return _with_greeks(features, tuple(f"{p}_" for p in contracts))


def price_of(iv: Column, underlying: Column, strike: Column, rate: Column, years: Column, call: Column) -> Column:
    """Price of an option from its volatility, by an approximation of the normal distribution that is good to 1e-7."""
    # Coefficients of the usual five-term polynomial for the normal distribution.
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

    def cdf(x: Column) -> Column:
        k = 1 / (1 + 0.2316419 * F.abs(x))
        tail = F.lit(0.0)
        for c in reversed(terms):
            tail = (tail + c) * k
        tail = tail * F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        return F.when(x >= 0, 1 - tail).otherwise(tail)

    wide = iv * F.sqrt(years)
    d1 = (F.log(underlying / strike) + (rate + iv * iv / 2) * years) / wide
    put = F.when(call, 0.0).otherwise(1.0)
    return underlying * (cdf(d1) - put) - strike * F.exp(-rate * years) * (cdf(d1 - wide) - put)
