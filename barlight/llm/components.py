"""Connected components of a graph that is a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.store import kept


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (u, v): root is the smallest node that can be reached.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends and joins
    the ends of links; a round leaves at most half of the nodes that still have links.
    """
    links = kept(links.where("u <> v").select("u", "v").distinct())
    found = None
    while not links.isEmpty():
        both = links.union(links.select("v", "u"))
        hook = kept(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root")))
        while True:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            hook = kept(hook.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")))
            moved = not hook.where("moved").isEmpty()
            hook = hook.drop("moved")
            if not moved:
                break
        if found is None:
            found = hook
        else:
            later = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            found = kept(found.join(later, "root", "left").select("node", F.coalesce("above", "root").alias("root")))
        a, b = hook.toDF("u", "ru"), hook.toDF("v", "rv")
        links = kept(links.join(a, "u").join(b, "v").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).where("u <> v").distinct())
    if found is None:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found
