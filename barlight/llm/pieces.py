"""Pieces of texts round anchors, dealt to groups that a task can hold, and the spans that repeat in them.

A piece has all windows of a text that one anchor stands for, as the units (bytes, or words by their
hashes) from the first of its first window to the last of its last. Equal windows have equal anchors
at the same offset, so they meet in one group. What repeats is found by the operator's own index, first
among the pieces of a task, then of each group. Of pieces that are alike a task hands one on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.anchors import edges, new_texts
from barlight.llm.store import kept
from barlight.llm.words import byte_codes, mix, ranges, rolling, span_hash

HEAD = np.dtype([("path", "<u8"), ("anchor", "<u8"), ("key", "<u8"), ("first", "<u4"), ("offset", "<u4"), ("windows", "<u4")])
SPAN = np.dtype([("key", "<u8"), ("first", "<u4"), ("end", "<u4")])
ROWS = "kind int, bucket long, data binary"
#: Kinds of rows: spans that are found, and pieces of a level (its number).
FOUND = -1
#: Levels of dealing: by anchor, by a longer path, by the path of a whole window.
LEVELS = 3
#: Bytes of pieces that are hashed at a time: hashing takes some forty bytes for each.
HASHED = 1 << 18


class Pieces:
    """head: one row a piece. body: bytes of all units. length: units of a window. unit: bytes of a unit."""

    def __init__(self, head: np.ndarray, body: np.ndarray, length: int, unit: int):
        self.head, self.body, self.length, self.unit = head, body, length, unit
        self.units = head["windows"].astype(np.int64) + (length - 1)
        self.end = np.cumsum(self.units)
        self.at = self.end - self.units

    def __len__(self) -> int:
        return len(self.head)

    def take(self, which: np.ndarray) -> Pieces:
        return Pieces(self.head[which], self.body[ranges(self.at[which] * self.unit, self.units[which] * self.unit)], self.length, self.unit)

    def windows(self, piece: np.ndarray, place: np.ndarray, count: np.ndarray) -> Pieces:
        """New pieces of `count` windows each, from a place of a piece on."""
        head = self.head[piece]
        head["first"] += place.astype(np.uint32)
        head["offset"] -= place.astype(np.uint32)
        head["windows"] = count
        start = (self.at[piece] + place) * self.unit
        return Pieces(head, self.body[ranges(start, (count + self.length - 1) * self.unit)], self.length, self.unit)

    def different(self) -> np.ndarray:
        """The first of each group of pieces that are alike in anchor, offset, windows and units."""
        where = self.head["anchor"] ^ (self.head["offset"].astype(np.uint64) << np.uint64(32)) ^ self.head["windows"]
        code = mix(self.hashes(self.units) + mix(where))
        return np.sort(np.unique(code, return_index=True)[1])

    def hashes(self, units: np.ndarray) -> np.ndarray:
        """Hash of the first `units` units of each piece, some pieces at a time; it doesn't depend on which."""
        out = np.empty(len(self), np.uint64)
        edge = edges(self.end * self.unit // HASHED)
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            start = self.at[a:b] * self.unit
            prefix = rolling(byte_codes(self.body[start[0] : self.end[b - 1] * self.unit]))
            out[a:b] = span_hash(prefix, start - start[0], start - start[0] + units[a:b] * self.unit)
        return out

    def rows(self, kind: int, bits: int) -> pa.RecordBatch:
        """One row a bucket of paths."""
        bucket = self.head["path"] >> np.uint64(64 - bits)
        order = np.argsort(bucket, kind="stable")
        edge = edges(bucket[order])
        sorted_ = self.take(order)
        at = np.append(sorted_.at, sorted_.at[-1] + sorted_.units[-1] if len(self) else 0) * self.unit
        blobs = [int(b - a).to_bytes(4, "little") + sorted_.head[a:b].tobytes() + sorted_.body[at[a] : at[b]].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return _rows(kind, bucket[order][edge[:-1]], blobs)

    @classmethod
    def of(cls, blobs: list[bytes], length: int, unit: int) -> Pieces:
        heads, bodies = [np.zeros(0, HEAD)], [np.zeros(0, np.uint8)]
        for blob in blobs:
            n = int.from_bytes(blob[:4], "little")
            heads.append(np.frombuffer(blob, HEAD, n, 4))
            bodies.append(np.frombuffer(blob, np.uint8, offset=4 + n * HEAD.itemsize))
        return cls(np.concatenate(heads), np.concatenate(bodies), length, unit)


def _rows(kind: int, buckets: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(blobs), pa.int32()), pa.array(buckets.astype(np.int64)), pa.array(blobs, pa.binary())], ["kind", "bucket", "data"])


def _found(pieces: Pieces, spans: tuple[np.ndarray, np.ndarray, np.ndarray], bits: int) -> pa.RecordBatch:
    piece, first, end = spans
    out = np.zeros(len(piece), SPAN)
    out["key"] = pieces.head["key"][piece]
    out["first"], out["end"] = pieces.head["first"][piece] + first, pieces.head["first"][piece] + end
    out = np.sort(out)
    bucket = out["key"] >> np.uint64(64 - bits)
    edge = edges(bucket)
    return _rows(FOUND, bucket[edge[:-1]], [out[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)])


#: From pieces: (piece, first, end) of spans of units, counted from the piece's first, that occur in another piece, too.
Find = Callable[[Pieces], tuple[np.ndarray, np.ndarray, np.ndarray]]


def repeated_spans(texts: DataFrame, cut: Callable[[pa.RecordBatch], Pieces], find: Find, split: Callable[[Pieces, int], Pieces], length: int, unit: int, bits: int, held_bytes: int = 4 << 20, most_bytes: int = 16 << 20) -> DataFrame:
    """(text_key, spans) of what find() finds in the pieces that cut() takes from the rows of texts.

    A task finds what it can in held_bytes at a time. A group of more than most_bytes isn't held: it is
    worked through part by part, and its different pieces are dealt again by the longer paths that
    split() gives them for the next level. On the last level a group is one window and what
    little can differ round it; of it only pieces that are not alike are held.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Pieces] = []

        def flush() -> Iterator[pa.RecordBatch]:
            pieces = Pieces(np.concatenate([p.head for p in held]), np.concatenate([p.body for p in held]), length, unit)
            held.clear()
            yield _found(pieces, find(pieces), bits)
            yield pieces.take(pieces.different()).rows(0, bits)

        size = 0
        for batch in new_texts(batches):
            pieces = cut(batch)
            if len(pieces):
                held.append(pieces)
                size += len(pieces.body)
            if size > held_bytes:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def meet(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, blobs, size, over, limit = None, [], 0, False, most_bytes
            pending: list[bytes] = []
            pending_size = 0

            def part() -> Iterator[pa.RecordBatch]:
                """A part of a group that is too large: one of like pieces goes on."""
                nonlocal blobs, size, limit
                pieces = Pieces.of(blobs, length, unit)
                yield _found(pieces, find(pieces), bits)
                pieces = pieces.take(pieces.different())
                blobs, size = [], 0
                if level + 1 < LEVELS:
                    yield split(pieces, level + 1).rows(level + 1, bits)
                else:
                    blobs = pieces.rows(level, 1).column("data").to_pylist()
                    size = len(pieces.body)
                    limit = max(most_bytes, 2 * size)

            def close() -> Iterator[pa.RecordBatch]:
                nonlocal pending, pending_size
                if over and level + 1 < LEVELS:
                    yield from part()
                else:
                    pending += blobs
                    pending_size += size
                    if pending_size > held_bytes:
                        yield from together()

            def together() -> Iterator[pa.RecordBatch]:
                nonlocal pending, pending_size
                pieces = Pieces.of(pending, length, unit)
                pending, pending_size = [], 0
                yield _found(pieces, find(pieces), bits)

            for batch in batches:
                for kind, b, data in zip(*(batch.column(n).to_pylist() for n in ("kind", "bucket", "data")), strict=True):
                    if kind == FOUND:
                        yield _rows(FOUND, np.array([b]), [data])
                        continue
                    if b != bucket:
                        yield from close()
                        blobs, size, over, limit = [], 0, False, most_bytes
                    bucket = b
                    blobs.append(data)
                    size += len(data)
                    if size > limit:
                        over = True
                        yield from part()
            yield from close()
            if pending:
                yield from together()

        return run

    some, done = texts.mapInArrow(deal, ROWS), None
    for level in range(LEVELS):
        found = kept(some.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(meet(level), ROWS))
        done = found if done is None else done.union(found)
        some = found.where(F.col("kind") == level + 1)
        if level + 1 == LEVELS or some.isEmpty():
            break
    return kept(done.where(F.col("kind") == FOUND).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_gathered, "text_key long, spans binary"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text, joined where they touch, as pairs of 4-byte numbers."""
    bucket, parts = None, []

    def close() -> pa.RecordBatch:
        rows = np.sort(np.concatenate([np.frombuffer(x, SPAN) for x in parts]))
        key, first, end = rows["key"], rows["first"].astype(np.int64), rows["end"].astype(np.int64)
        # ends so far, text by text: a text's number stands above them
        text = np.cumsum(np.r_[True, key[1:] != key[:-1]]) << 34
        reach = np.maximum.accumulate(end + text)
        new = np.r_[True, (first + text)[1:] > reach[:-1]]
        last = np.r_[np.flatnonzero(new)[1:] - 1, len(rows) - 1]
        spans = np.stack([first[new], (reach - text)[last]], 1).astype("<u4")
        edge = edges(key[new])
        return pa.RecordBatch.from_arrays([pa.array(key[new][edge[:-1]].view(np.int64)), pa.array([spans[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["text_key", "spans"])

    for batch in batches:
        for b, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
            if b != bucket and parts:
                yield close()
                parts = []
            bucket = b
            parts.append(data)
    if parts:
        yield close()


def spans_of(spans: bytes | None, size: int, length: int, all_of_it: bool) -> list[tuple[int, int]]:
    """Maximal removed runs [start, end) of a text of `size` units: its spans, or all of it if it is of two rows and not too short."""
    if all_of_it and size >= length:
        return [(0, size)]
    return [(a, b) for a, b in np.frombuffer(spans or b"", "<u4").reshape(-1, 2).tolist()]
