"""Operator 9, mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlight.llm.store import kept

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source and size that are ranked in one task at a time.
RANKED = 4096


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source and target from source and source_size, one row a source.

    Sources in order of code points, null last, take the weights in turn. Together they share `share`
    times all words by weight; none gets more than `most` times its size, and what is over is shared
    again among the others. The table has a row for each source, so its windows are unpartitioned.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1)).withColumn("most", F.col("source_size") * F.lit(most))
    filled = Window.orderBy(F.col("most") / F.col("weight"), "source")
    total = sources.agg((F.sum("source_size") * F.lit(share)).alias("total"))
    levels = weighed.crossJoin(F.broadcast(total))
    levels = levels.withColumn("below", F.coalesce(F.sum("most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("left", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
    levels = levels.withColumn("level", (F.col("total") - F.col("below")) / F.col("left"))
    level = levels.where(F.col("level") <= F.col("most") / F.col("weight")).agg(F.min_by("level", F.struct(F.col("most") / F.col("weight"), "source")).alias("level"))
    return weighed.crossJoin(F.broadcast(level)).select("source", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("level"), F.col("most"))).alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, most: float = 2.0, rounds: int = 60, near: float = 1e-9) -> DataFrame:
    """source and tilt: the solution of the dual of entropy balancing.

    A document of x times its source's mean size has the rate min(most, exp(tilt * x)); the tilt is
    where a source's rates times sizes sum to its target. Newton's steps on the convex dual are kept
    inside a bracket, which is halved where a step leaves it. Each step is one aggregation of cells
    (source, size, n), which stand for all documents.
    """
    top = float(np.log(most))
    mean = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    m = mean.withColumnRenamed("source", "s")
    state = goals.join(m, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    full = F.col("target") >= F.col("source_size") * F.lit(most)
    end = F.lit(top) * F.col("mean") / F.col("least")
    state = state.select("source", "target", "mean", F.when(full | F.col("least").isNull(), end).alias("done"), F.lit(0.0).alias("tilt"), F.lit(-1000.0).alias("lo"), end.alias("hi"))
    state = kept(state.withColumn("tilt", F.coalesce("done", "tilt")))
    for _ in range(rounds):
        if state.where("done is null").isEmpty():
            break
        s = state.where("done is null").withColumnRenamed("source", "s")
        x = F.col("size") / F.col("mean")
        power = F.col("tilt") * x
        rate = F.exp(F.least(power, F.lit(top)))
        words = F.col("size") * F.col("n")
        sums = cells.join(s, F.col("source").eqNullSafe(F.col("s"))).groupBy("source").agg(F.sum(words * rate).alias("f"), F.sum(F.when(power < top, words * x * rate).otherwise(0.0)).alias("df"))
        sums = sums.withColumnRenamed("source", "s")
        now = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        gap = F.col("f") - F.col("target")
        now = now.withColumn("lo", F.when(gap < 0, F.greatest("lo", "tilt")).otherwise(F.col("lo"))).withColumn("hi", F.when(gap > 0, F.least("hi", "tilt")).otherwise(F.col("hi")))
        step = F.col("tilt") - gap / F.col("df")
        half = (F.col("lo") + F.col("hi")) / 2
        good = F.abs(gap) <= F.lit(near) * F.col("target")
        stuck = (F.col("hi") - F.col("lo")) <= F.lit(1e-13) * F.greatest(F.abs("hi"), F.lit(1.0))
        now = now.withColumn("done", F.coalesce("done", F.when(good | stuck, F.col("tilt"))))
        next_ = F.when((F.col("df") > 0) & (step > F.col("lo")) & (step < F.col("hi")), step).otherwise(half)
        state = kept(now.withColumn("tilt", F.coalesce(F.col("done"), next_)).drop("f", "df"))
    return state.select("source", "mean", "tilt")


def _round(cells: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size get one copy more: what is over goes on to the next smaller size."""
    cells = cells.sort_values("size", ascending=False, kind="stable")
    more, carry = [], 0.0
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
        want = n * (rate - np.floor(rate)) * size + carry
        k = int(min(max(round(want / size), 0), n if rate < np.floor(rate) + 1 and rate % 1 else 0)) if size else 0
        carry = want - k * size
        more.append(k)
    return cells.assign(more=np.array(more, np.int64), base=np.floor(cells["rate"]).astype(np.int64))[["source", "size", "n", "rate", "base", "more"]]


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every row of docs.

    size: words `[^ white space]+` of the text, 0 for null. taken: size times copies. Which documents
    of one source and size get the copy more is settled by a hash of doc_id, so that reruns agree.
    Documents without words have no taken words. Equal rows are ranked in any order, with the same
    result. What iterates and what is rounded is the table of (source, size, n), whose groups are
    bounded by the number of different sizes; documents of a hot source or size are ranked in parts.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = kept(docs.select("doc_id", "source", size.alias("size")))
    cells = kept(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = kept(targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most))
    tilt = tilts(cells, goals, most).withColumnRenamed("source", "s")
    rate = F.when(F.col("size") > 0, F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(800.0))))).otherwise(F.lit(1.0))
    rated = cells.join(tilt, F.col("source").eqNullSafe(F.col("s"))).select("source", "size", "n", rate.alias("rate"))
    rounded = rated.groupBy("source").applyInPandas(_round, "source string, size long, n long, rate double, base long, more long") if docs.schema["source"].dataType.simpleString() == "string" else rated.groupBy("source").applyInPandas(_round, rated.schema.simpleString()[7:-1].replace(":", " ") + ", base long, more long")
    g = goals.withColumnRenamed("source", "s")
    plan = kept(rounded.join(g, F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    p = plan.withColumnsRenamed({"source": "s", "size": "z"})
    rows = sized.join(p, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    part = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.expr(f"(n - 1) div {RANKED} + 1"))
    rows = kept(rows.withColumn("part", part))
    counts = rows.groupBy("source", "size", "part").agg(F.count("*").alias("m"))
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("q"), "before")
    own = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ranked = rows.withColumn("own", own).join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("q")))
    copies = F.col("base") + (F.col("before") + F.col("own") <= F.col("more")).cast("long")
    return ranked.withColumn("copies", copies).select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))
