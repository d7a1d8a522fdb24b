"""Predicates built from parameters; each is a Column that reaches the scan as far as Spark can push it."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def range_filter(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive at both ends; a null fails as soon as a bound is set."""
    parts = ([c.isNotNull()] if low is not None or high is not None else []) + ([c >= low] if low is not None else []) + ([c <= high] if high is not None else [])
    return all_of(parts)


def date_range_filter(ts: Column, start: str, end: str) -> Column:
    """Whole UTC days from start to end, both included."""
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))


def compare_filter(**tests) -> Column:
    """col=x, col__lt, col__lte, col__gt, col__gte, col__any_of on any dataset."""
    ops = {"lt": lambda c, x: c < x, "lte": lambda c, x: c <= x, "gt": lambda c, x: c > x, "gte": lambda c, x: c >= x, "any_of": lambda c, x: c.isin(list(x)), "": lambda c, x: c == x}
    parts = []
    for name, value in tests.items():
        column, _, op = name.partition("__")
        parts.append(ops[op](F.col(column), value))
    return all_of(parts)


def snapshot_filter(config: dict) -> Column:
    """price, volume and rvol inside the ranges of config (<field>_min, <field>_max)."""
    return all_of([range_filter(F.col(f), config.get(f"{f}_min"), config.get(f"{f}_max")) for f in ("price", "volume", "rvol")])


def detail_filter(config: dict) -> Column:
    """market_cap range, any sector keyword, exchange, active. active fails only where it is known to differ."""
    parts = [range_filter(F.col("market_cap"), config.get("market_cap_min"), config.get("market_cap_max"))]
    if config.get("sectors"):
        parts.append(reduce(lambda a, b: a | b, [F.lower(F.coalesce("sector", F.lit(""))).contains(w.lower()) for w in config["sectors"]]))
    if config.get("exchange"):
        parts.append(F.lower(F.coalesce("exchange", F.lit(""))) == config["exchange"].lower())
    if config.get("active") is not None:
        parts.append(F.coalesce(F.col("active") == config["active"], F.lit(True)))
    return all_of(parts)


def read_config(text: str) -> dict:
    """JSON whose lines may begin with #, which are left out."""
    return json.loads("\n".join(x for x in text.splitlines() if not x.lstrip().startswith("#")))
