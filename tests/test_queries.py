"""Every registered query with SQL gives what DuckDB gives on the smallest tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from barlight.operators import options
from barlight.plans import catalog, fixtures

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    def one(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return None
        return round(float(x), 3) + 0.0 if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(str(tuple(map(one, r))) for r in rows)


def distinct():
    seen = {}
    for name, text in catalog.ORACLE_SQL.items():
        seen.setdefault(text, name)
    return sorted(seen.values())


@pytest.mark.parametrize("name", distinct())
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    oracle = con.execute(f"select {', '.join(f'\"{c}\"' for c in cols)} from ({catalog.ORACLE_SQL[name]})").fetchall()
    assert plain(df.select(*(f"`{c}`" for c in cols)).collect()) == plain(oracle)


def test_greeks_price_back(spark):
    """The implied volatility gives the price again, and rows without time premium have none."""
    chains = fixtures.chains(spark, SF).withColumn("rate", F.lit(0.04)).select("symbol", "day", "line_order", "underlying", "strike", "rate", "close", "dte", "type")
    rows = options.enrich_greeks(chains).collect()
    n = lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2)))
    solved = [r for r in rows if r.iv is not None]
    assert solved
    for r in solved[:200]:
        t = r.dte / 365
        d1 = (math.log(r.underlying / r.strike) + (r.rate + r.iv**2 / 2) * t) / (r.iv * math.sqrt(t))
        d2 = d1 - r.iv * math.sqrt(t)
        disc = r.strike * math.exp(-r.rate * t)
        price = r.underlying * n(d1) - disc * n(d2) if r.type == "C" else disc * n(-d2) - r.underlying * n(-d1)
        assert price == pytest.approx(r.close, abs=0.01)
    for r in rows:
        intrinsic = max(0, r.underlying - r.strike if r.type == "C" else r.strike - r.underlying)
        if r.close <= intrinsic or r.dte <= 0:
            assert r.iv is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
