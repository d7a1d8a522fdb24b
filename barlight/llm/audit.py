"""Filter interaction audit: what each filter removes, alone and after others, for every order of five filters.

Spark counts each part's documents by which of the filters they fail, at most 32 numbers a part. These
are a tensor of 2 x 2 x 2 x 2 x 2; what an order's step removes or keeps is the contraction of it with a
vector along each axis that takes those who pass, those who fail, or all.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The filters and the numbers of their conditions.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DIFFERENT, MOST_CAPITALS = 50, 65, 5
SPACES, MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"

PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
OUT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

#: Parts that are contracted at a time.
PARTS = 1 << 10


def text_failures(text: Column) -> list[Column]:
    """Conditions of the filters that look at a text alone, A to D; null is empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, SPACES), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    return [n < LEAST_WORDS, 100 * different < LEAST_DIFFERENT * n, 100 * F.regexp_count(t, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(t), t.rlike(MARKS)]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How many documents, good and toxic ones of each part fail each set of filters: part, fails (bit k: filter k), n, good, toxic.

    Copies are counted where they are: documents of one text, part and label are one row before texts
    are compared, with the number of those of the smallest doc_id. So no group of copies meets in one
    task. Texts are the same if their lengths, MD5 and 64-bit hashes are.
    """
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = rows.select("doc_id", "part", bits.alias("fails"), F.struct(F.length("text").alias("l"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("m"), F.xxhash64("text").alias("h")).alias("same"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = rows.join(marks, F.col("doc_id") == F.col("of"), "left").select("doc_id", "part", "fails", "same", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    key = ["same", "part", "good", "toxic", "fails"]
    by_doc = marked.groupBy(*key, "doc_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    unnumbered = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    groups = by_doc.groupBy(*key).agg(F.sum("n").alias("n"), least.alias("least"), unnumbered.alias("unnumbered"))
    firsts = groups.groupBy(F.col("same").alias("first_same")).agg(F.min("least.doc_id").alias("first_id"))
    joined = groups.join(firsts, F.col("same") == F.col("first_same"))
    # Documents without a doc_id are neither smaller nor larger than others.
    ahead = F.col("unnumbered") + F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    halves = F.array(F.struct(F.col("fails").alias("fails"), ahead.alias("n")), F.struct((F.col("fails") + (1 << 4)).alias("fails"), (F.col("n") - ahead).alias("n")))
    split = joined.select("part", "good", "toxic", F.inline(halves)).where("n > 0")
    return split.groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def contractions(counts: np.ndarray) -> list[tuple[str, int, np.ndarray]]:
    """(order, step, counts of COUNTS a part) for each order and step; counts: parts x (all, good, toxic) x 2 x 2 x 2 x 2 x 2."""
    axes = range(len(FILTERS))

    def taken(selectors: list[np.ndarray]) -> np.ndarray:
        return np.einsum("pkabcde,a,b,c,d,e->pk", counts, *selectors, optimize=True)

    fails = {f: taken([FAIL if a == f else ALL for a in axes])[:, 0] for f in axes}
    alone = {f: taken([FAIL if a == f else PASS for a in axes])[:, 0] for f in axes}
    earlier_sets = [frozenset(s) for k in range(len(FILTERS) + 1) for s in itertools.combinations(axes, k)]
    kept = {s: taken([PASS if a in s else ALL for a in axes])[:, 0] for s in earlier_sets}
    removed = {(s, f): taken([PASS if a in s else FAIL if a == f else ALL for a in axes]) for s in earlier_sets for f in axes if f not in s}
    orders = list(itertools.permutations(axes))
    total = {f: sum(removed[frozenset(o[: o.index(f)]), f][:, 0] for o in orders) for f in axes}
    out = []
    for order in orders:
        name = "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order):
            before = frozenset(order[:step])
            gone = removed[before, f]
            out.append((name, step + 1, np.stack([kept[before | {f}], gone[:, 0], fails[f] - gone[:, 0], alone[f], gone[:, 1], gone[:, 2], total[f]], axis=1)))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part, order of the filters A to E and step: the counts of COUNTS.

    part: the value of source, an empty string where it is null. Null texts are empty; they fail A only, and E
    behind another empty text. A document fails E if a smaller doc_id has the same text anywhere; rows of one
    doc_id don't make each other fail, and those without one never do. A document is good or toxic if any
    of its rows in labels says so. Repeated rows count as often as they stand there; other columns are not
    read. Without documents there are no rows.
    """
    per_part = failures(docs, labels).groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))  # 32 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PARTS):
                yield from one(batch.slice(lo, PARTS))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, cells = batch.column("part").to_pylist(), batch.column("cells").to_pylist()
        flat = np.zeros((len(names), 3, 1 << len(FILTERS)), np.int64)
        for p, of_part in enumerate(cells):
            for c in of_part:
                flat[p, :, c["fails"]] += (c["n"], c["good"], c["toxic"])
        # Bit 0 is the last axis of a number's bits: turn them round, so that the first axis is filter A.
        cube = flat.reshape(len(names), 3, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
        for name, step, counts in contractions(cube):
            n = len(names)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([name] * n, pa.string()), pa.array([step] * n, pa.int32()), *(pa.array(counts[:, k], pa.int64()) for k in range(len(COUNTS)))], names=["part", "filter_order", "step", *COUNTS])

    return per_part.mapInArrow(run, OUT)
