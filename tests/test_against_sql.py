"""Queries against their SQL on small tables that the given ones don't have the like of."""

import duckdb
from pyspark.sql import functions as F

from barlight.plans import catalog
from tests.test_queries import plain

SF = "/root/testdata/sf0.001"


def same(spark, name, sf, tables):
    df = catalog.QUERIES[name](spark, str(sf))
    cols = sorted(df.columns)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet/*.parquet')")
    oracle = con.execute(f"select {', '.join(f'"{c}"' for c in cols)} from ({catalog.ORACLE_SQL[name]})").fetchall()
    got = df.select(*(f"`{c}`" for c in cols)).collect()
    assert plain(got) == plain(oracle)
    return got


def test_hours_with_a_price_of_zero(spark, tmp_path):
    """Such an hour counts for nothing in its day, its volume and vwap neither; a day of such hours has no row."""
    e = spark.read.parquet(f"{SF}/events.parquet").where("day(ts) <= 3")
    at = F.hour("ts")
    zero = ((F.dayofmonth("ts") == 1) & (at % 6 == 0)) | (F.dayofmonth("ts") == 2)
    e.withColumn("value", F.when(zero, 0.0).otherwise(F.col("value"))).write.parquet(f"{tmp_path}/events.parquet")
    got = same(spark, "ohlcv_resample", tmp_path, ["events"])
    assert {str(r.bucket)[-2:] for r in got} == {"01", "03"}


def test_greeks_job_moves_no_more_than_it_needs(spark):
    """One shuffle by contract, no slices of a contract's time, and no column that nobody reads on the way through Python."""
    plan = catalog.QUERIES["greeks_job"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "slice_no" not in plan and "l_tax" not in plan and "open_interest" not in plan
    assert plan.count("Exchange hashpartitioning(symbol#") == 1
