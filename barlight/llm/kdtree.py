"""Operator 10, exact top-k search: a KD-tree for each shard, and a bound that goes from shard to shard.

The shards are the leaves of the top of one tree, so each has a box of its own. A query is searched in its
own shard first; then in those whose boxes allow more than its kth score, the most promising ones first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlight.llm.store import kept

#: Vectors of a shard and of a leaf, and queries that go to a shard in one task.
SHARD, LEAF, TOGETHER = 8192, 128, 1024
#: Vectors to which the splits between shards are fitted, for each shard and in all; bytes of the shards' boxes.
FITTED, MOST_FITTED, BOX_BYTES = 32, 50_000, 64 << 20
#: Shards that a query visits in the second round, those of the largest bounds; in the last round all that are left.
NEXT = 4
#: Bounds of queries by shards that are held at once, and queries that are sent on at once.
CELLS, SENT = 1 << 21, 1 << 13


@dataclass(frozen=True)
class Splits:
    """Top of one tree over all vectors: its inner nodes' component and value, and children; a child below 0 is shard -1 - child."""

    side: np.ndarray
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, shards: int) -> Splits:
        """Median splits along the widest side of a sample of points, until there are `shards` parts or nothing differs."""
        side, value, low, high, done = [], [], [], [], 0

        def node(part: np.ndarray, n: int) -> int:
            nonlocal done
            wide = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(1)
            if n > 1 and wide.max() > 0:
                k = int(wide.argmax())
                cut = float(np.median(part[:, k]))
                if not (part[:, k] < cut).any():
                    cut = float(part[:, k][part[:, k] > cut].min())
                me = len(side)
                for x in (side, value, low, high):
                    x.append(0)
                side[me], value[me] = k, cut
                below = part[:, k] < cut
                low[me] = node(part[below], n // 2)
                high[me] = node(part[~below], n - n // 2)
                return me
            done += 1
            return -done

        node(points, shards)
        return cls(np.array(side, np.int64), np.array(value, float), np.array(low, np.int64), np.array(high, np.int64))

    def shard(self, points: np.ndarray) -> np.ndarray:
        """The shard of each point; components that a point hasn't are 0."""
        at = np.zeros(len(points), np.int64) if len(self.side) else np.full(len(points), -1)
        open_ = np.flatnonzero(at >= 0)
        while len(open_):
            n = at[open_]
            below = points[open_, self.side[n]] < self.value[n]
            at[open_] = np.where(below, self.low[n], self.high[n])
            open_ = open_[at[open_] >= 0]
        return -1 - at


class Tree:
    """Median splits along the widest side, with the tight box of each node.

    Equal vectors are one point; of their ids the `keep` smallest can be among the best, so no more are held.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, keep: int):
        order = np.lexsort((ids, *points.T[::-1])) if len(ids) else np.zeros(0, np.int64)
        ids, points = ids[order], points[order]
        new = np.r_[True, (points[1:] != points[:-1]).any(axis=1)] if len(ids) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        rank = np.arange(len(ids)) - np.flatnonzero(new)[group] if len(ids) else order
        self.ids, self.points = ids[rank < keep], points[rank < keep]
        self.lo, self.hi, self.below, self.span = [], [], [], []
        if len(self.ids):
            self._split(0, len(self.ids))
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.scored = 0  # points that searches have scored

    def _split(self, a: int, b: int) -> int:
        """A node of the points a to b, which are put in order of its sub-trees."""
        node, part = len(self.lo), self.points[a:b]
        low, high = part.min(axis=0), part.max(axis=0)
        self.lo.append(low)
        self.hi.append(high)
        self.span.append((a, b))
        self.below.append(None)
        side = int((high - low).argmax())
        if b - a > LEAF and high[side] > low[side]:
            mid = (a + b) // 2
            order = np.argpartition(part[:, side], mid - a)
            self.points[a:b], self.ids[a:b] = part[order], self.ids[a:b][order]
            self.below[node] = (self._split(a, mid), self._split(mid, b))
        return node

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[float, int]]:
        """The k best (score, -id) of at least `floor`, the best first, without the id `own`.

        Nodes are taken in the order of the largest inner product that their box allows, until that
        is below the kth best.
        """
        if not len(self.ids):
            return []
        up, down = np.maximum(query, 0), np.minimum(query, 0)
        best: list[tuple[float, int]] = []
        queue = [(-float(up @ self.hi[0] + down @ self.lo[0]), 0)]
        while queue and -queue[0][0] >= floor:
            node = heapq.heappop(queue)[1]
            if self.below[node]:
                pair = list(self.below[node])
                bounds = self.hi[pair] @ up + self.lo[pair] @ down
                for bound, child in zip(bounds.tolist(), pair, strict=True):
                    if bound >= floor:
                        heapq.heappush(queue, (-bound, child))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            self.scored += b - a
            for i in np.flatnonzero(scores >= floor).tolist():
                vec = int(self.ids[a + i])
                if vec == own:
                    continue
                item = (float(scores[i]), -vec)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return sorted(best, reverse=True)


def whole_numbers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * component) of a vector; null for a vector that is null or has a null, infinite or NaN component."""
    parts = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.when(embedding.isNotNull() & ~F.coalesce(F.exists(embedding, bad), F.lit(False)), parts)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lists = column.to_pylist()
    out = np.zeros((len(lists), max(map(len, lists), default=0)))
    for row, x in zip(out, lists, strict=True):
        row[: len(x)] = x
    return out


def _fit(x: np.ndarray, wide: int) -> np.ndarray:
    return x[:, :wide] if x.shape[1] >= wide else np.pad(x, ((0, 0), (0, wide - x.shape[1])))


def routed(q: np.ndarray, own: np.ndarray, floor: np.ndarray, number: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: int, last: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of the shards that queries go to: in order of their bounds from first to last, but for a query's own, if the bound reaches its floor.

    One array of queries by shards, of CELLS at most, is held. Bounds are whole numbers and exact, so both rounds see the same order.
    """
    bound = np.maximum(q, 0) @ hi.T
    bound += np.minimum(q, 0) @ lo.T
    bound[number[None] == own[:, None]] = -np.inf
    n = last or first
    if n and n < len(number):
        best = np.argpartition(bound, len(number) - n, axis=1)[:, len(number) - n :]
        values = np.take_along_axis(bound, best, axis=1)
    else:
        best, values = np.arange(len(number))[None].repeat(len(q), 0), bound
    if last is None:
        if n < len(number):
            np.put_along_axis(bound, best[:, : n or 0], -np.inf, axis=1)
        else:
            bound[:] = -np.inf
        row, at = np.nonzero((bound >= floor[:, None]) & (bound > -np.inf))
        return row, number[at]
    row, at = np.nonzero((values >= floor[:, None]) & (values > -np.inf))
    return row, number[best[row, at]]


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every` the k largest inner products.

    vectors: vec_id, embedding. Candidates are all rows with another vec_id; ties go to the smaller
    vec_id. Products are of whole numbers and exact below 2 ** 53. Null vec_ids, null vectors and those
    with a null, NaN or infinite component take no part; vectors of different lengths meet on their
    common components. Rows of a repeated vec_id are candidates one by one; a repeated query is
    searched once for each different vector and reported by vec_id, its best k in all. An empty table
    gives no rows.

    Of equal vectors, however many, only the k + 1 rows of the smallest vec_ids can be among the best, so no
    more are indexed; each task keeps no more before they are dealt by vector. The splits between shards are fitted to a sample of about FITTED vectors a shard, drawn by
    hash, at most twice MOST_FITTED in all; all are
    dealt by them. The boxes of the shards, of BOX_BYTES at most, go to every task: a larger table has larger
    shards. Queries of one shard are searched in blocks of about TOGETHER, each in a task of its own.
    """
    found = kept(_found(vectors, every, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", "vec_id", "score").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _found(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """query_id, vec_id, score of all shards' best for each query, and how many points were scored for them (on one row a query and shard)."""
    valid = kept(vectors.select("vec_id", whole_numbers(F.col("embedding")).alias("v")).where("vec_id is not null and v is not null"))
    same = Window.partitionBy("v").orderBy("vec_id")
    points = kept(valid.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n"))
    count, wide = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    most = max(1, BOX_BYTES // (16 * max(wide, 1)))
    shards = int(min(max(1, -(-count // SHARD)), most))
    wanted = min(FITTED * shards, MOST_FITTED)
    drawn = F.pmod(F.xxhash64("vec_id", "v", F.lit(7)), F.lit(1 << 20)) <= int(wanted / max(count, 1) * (1 << 20))
    sample = points.where(drawn).select("v").limit(2 * wanted).toArrow().column("v")
    splits = Splits.fit(_fit(_matrix(sample), max(wide, 1)), shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = splits.shard(_fit(_matrix(batch.column("v")), max(wide, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.columns], ["shard", *batch.schema.names])

    schema = "shard int, vec_id long, v array<double>"
    typed = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    placed = kept(typed(points).mapInArrow(deal, schema))
    asked = kept(typed(valid.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0).dropDuplicates(["vec_id", "v"])).mapInArrow(deal, schema))

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            part, shard = _fit(_matrix(batch.column("v")), max(wide, 1)), batch.column("shard").to_numpy()
            for s in np.unique(shard).tolist():
                lo, hi = part[shard == s].min(axis=0), part[shard == s].max(axis=0)
                if s in held:
                    lo, hi = np.minimum(lo, held[s][0]), np.maximum(hi, held[s][1])
                held[s] = lo, hi
        rows = list(held.items())
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([x[0].tobytes() for _, x in rows], pa.binary()), pa.array([x[1].tobytes() for _, x in rows], pa.binary())], ["shard", "lo", "hi"])

    def joined_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lo, hi = np.frombuffer(a), np.frombuffer(b)
                held[s] = (np.minimum(lo, held[s][0]), np.maximum(hi, held[s][1])) if s in held else (lo, hi)
        rows = list(held.items())
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([x[0].tobytes() for _, x in rows], pa.binary()), pa.array([x[1].tobytes() for _, x in rows], pa.binary())], ["shard", "lo", "hi"])

    boxed = placed.select("shard", "v").mapInArrow(box, "shard int, lo binary, hi binary").repartition("shard").mapInArrow(joined_boxes, "shard int, lo binary, hi binary").toArrow()
    number = boxed.column("shard").to_numpy()
    corner = lambda c: np.frombuffer(b"".join(boxed.column(c).to_pylist()), float).reshape(len(number), max(wide, 1))
    lo, hi = corner("lo"), corner("hi")

    def route(first: int, last: int | None):
        """To each query the shards first .. last in order of their bounds, its own aside, if the bound reaches the floor."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, CELLS // max(len(number), 1))
            for whole in batches:
                for at in range(0, whole.num_rows if len(number) else 0, step):
                    batch = whole.slice(at, step)
                    q = _fit(_matrix(batch.column("v")), max(wide, 1))
                    floor = np.array([-np.inf if x is None else x for x in batch.column("floor").to_pylist()])
                    row, shard = routed(q, batch.column("shard").to_numpy(), floor, number, lo, hi, first, last)
                    for part in range(0, len(row), SENT):
                        sent = batch.take(pa.array(row[part : part + SENT]))
                        yield pa.RecordBatch.from_arrays([pa.array(shard[part : part + SENT], pa.int32()), sent.column("vec_id"), sent.column("v"), sent.column("floor")], ["shard", "vec_id", "v", "floor"])

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, ids, points_ = None, None, [], []
        for batch in batches:
            shard, block = batch.column("shard").to_numpy(), batch.column("block").to_numpy()
            asking = batch.column("asking").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (block[1:] != block[:-1]) | (asking[1:] != asking[:-1])) + 1), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                part = batch.slice(a, b - a)
                if (shard[a], block[a]) != now:
                    now, tree, ids, points_ = (shard[a], block[a]), None, [], []
                if not asking[a]:
                    ids.append(part.column("vec_id").to_numpy())
                    points_.append(_fit(_matrix(part.column("v")), max(wide, 1)))
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(ids), np.concatenate(points_), k + 1) if ids else Tree(np.zeros(0, np.int64), np.zeros((0, max(wide, 1))), k + 1)
                    ids, points_ = [], []
                queries, out = _fit(_matrix(part.column("v")), max(wide, 1)), []
                for q, own, floor in zip(queries, part.column("vec_id").to_pylist(), part.column("floor").to_pylist(), strict=True):
                    before = tree.scored
                    best = tree.search(q, own, k, -np.inf if floor is None else floor)
                    out += [(own, -neg, int(score), (tree.scored - before) if i == 0 else 0) for i, (score, neg) in enumerate(best)]
                cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score", "scored"])

    def searched(queries: DataFrame) -> DataFrame:
        """Queries (shard, vec_id, v, floor) with their shards' vectors, which are repeated for each block of queries."""
        queries = kept(queries)
        blocks = queries.groupBy("shard").agg(F.expr(f"int((count(*) - 1) div {TOGETHER}) + 1").alias("blocks"))
        held = placed.join(F.broadcast(blocks), "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asks = queries.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
        columns = lambda df, asking, floor: df.select("shard", "block", F.lit(asking).alias("asking"), "vec_id", "v", floor.alias("floor"))
        both = columns(held, False, F.lit(None).cast("double")).union(columns(asks, True, F.col("floor")))
        return kept(both.repartition("shard", "block").sortWithinPartitions("shard", "block", "asking").mapInArrow(search, "query_id long, vec_id long, score long, scored long"))

    def with_floor(found: DataFrame) -> DataFrame:
        kth = Window.partitionBy("query_id").orderBy(F.desc("score"))
        floors = found.withColumn("n", F.row_number().over(kth)).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
        return asked.join(floors, "vec_id", "left").select("shard", "vec_id", "v", "floor")

    schema = "shard int, vec_id long, v array<double>, floor double"
    found = searched(asked.withColumn("floor", F.lit(None).cast("double")))
    for first, last in ((0, NEXT), (NEXT, None)):
        if len(number) <= 1 + first:
            break
        found = found.union(searched(with_floor(found).mapInArrow(route(first, last), schema)))
    return found
