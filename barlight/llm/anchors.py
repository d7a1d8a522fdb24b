"""Which places of texts may stand in a passage that occurs again.

From each window of places the one with the smallest hash is its anchor. Equal passages of a window's
length have equal anchors, so only passages round anchors that occur twice need a closer look: they
are a few hundredths of all places, and nothing that repeats is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.store import kept
from barlight.llm.words import chunks, planes, unplanes

#: Hashes and places that a task holds before it hands them on.
HELD = 2_000_000


def windows_anchor(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` hashes the place of its smallest, the first one on ties. Places have 32 bits."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 32) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    done = 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    return (least & low).astype(np.int64)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """text, its 64-bit text_key, and more columns. A null text is taken as an empty one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(text.alias("text"), F.xxhash64(text).alias("text_key"), *more)


def new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks without the texts that this task has had before."""
    seen = np.zeros(0, np.int64)
    for batch in chunks(batches):
        keys = batch.column("text_key").to_numpy()
        new = np.zeros(len(keys), bool)
        new[np.unique(keys, return_index=True)[1]] = True
        new &= ~np.isin(keys, seen)
        seen = np.append(seen, keys[new])
        yield batch.filter(pa.array(new))


def with_side(docs: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """docs joined with side by text_key, alike at every size: both are shuffled and side is hashed, so no text is sorted.

    Of a text that very many rows have, Spark splits the rows over several tasks (skew join).
    """
    return docs.join(side.hint("shuffle_hash"), "text_key", how)


def copied(docs: DataFrame) -> DataFrame:
    """text_key of the texts of two or more rows."""
    return docs.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select("text_key")


def edges(sorted_numbers: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins, and the end."""
    if not len(sorted_numbers):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(sorted_numbers[1:] != sorted_numbers[:-1]) + 1, len(sorted_numbers)]


def repeated_anchors(docs: DataFrame, anchors: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int) -> DataFrame:
    """(text_key, places) of the anchors that occur at two or more places of different texts or of one.

    anchors: hash, text number and place of each anchor of some texts. An anchor that a task meets
    more than once is settled there, and one of it is sent on: so a passage of a third of all texts
    is sent once a task.
    """
    shift = np.uint64(64 - bits)

    def rows(kind: int, buckets: np.ndarray, parts: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        edge = edges(buckets)
        blobs = [b"".join(planes(x[a:b], n) for x, n in parts) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(blobs), pa.int32()), pa.array(buckets[edge[:-1]].astype(np.int64)), pa.array(blobs, pa.binary())], ["kind", "bucket", "data"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            sig, key, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(sig, kind="stable")
            sig, key, place = sig[order], key[order], place[order]
            head = np.r_[True, sig[1:] != sig[:-1]] if len(sig) else np.zeros(0, bool)
            many = ~head | np.r_[~head[1:], False] if len(sig) else head
            yield rows(1, sig[head] >> shift, [(sig[head], 8), (key[head], 8), (place[head], 4)])
            order = np.argsort(key[many])
            k, p = key[many][order], place[many][order]
            yield rows(0, k >> shift, [(k, 8), (p, 4)])

        size = 0
        for batch in new_texts(batches):
            sig, text, place = anchors(batch.column("text"))
            held.append((sig, batch.column("text_key").to_numpy().view(np.uint64)[text], place.astype(np.uint64)))
            size += len(sig)
            if size > HELD:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def close() -> pa.RecordBatch:
            lead = 8 * now[0]
            wide = lead + 12
            n = [len(x) // wide for x in parts]
            key = np.concatenate([unplanes(x[lead * m : (lead + 8) * m], 8) for x, m in zip(parts, n, strict=True)])
            place = np.concatenate([unplanes(x[(lead + 8) * m :], 4) for x, m in zip(parts, n, strict=True)])
            if lead:
                sig = np.concatenate([unplanes(x[: lead * m], lead) for x, m in zip(parts, n, strict=True)])
                order = np.lexsort((place, key, sig))
                sig, key, place = sig[order], key[order], place[order]
                same = sig[1:] == sig[:-1]
                new = np.r_[True, ~same | (key[1:] != key[:-1]) | (place[1:] != place[:-1])]
                sig, key, place = sig[new], key[new], place[new]
                same = sig[1:] == sig[:-1]
                many = np.r_[same, False] | np.r_[False, same]
                key, place = key[many], place[many]
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(place.astype(np.int64))], ["text_key", "place"])

        for batch in batches:
            for kind, b, data in zip(*(batch.column(n).to_pylist() for n in ("kind", "bucket", "data")), strict=True):
                if (kind, b) != now and parts:
                    yield close()
                    parts = []
                now = (kind, b)
                parts.append(data)
        if parts:
            yield close()

    dealt = docs.select("text", "text_key").mapInArrow(emit, "kind int, bucket long, data binary").repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    found = dealt.mapInArrow(meet, "text_key long, place long")
    return kept(found.groupBy("text_key").agg(F.collect_set("place").alias("places")))


def chosen(batch: pa.RecordBatch, starts: np.ndarray) -> np.ndarray:
    """The places column of a chunk, counted from the chunk's start, where the texts start at `starts`."""
    places = batch.column("places")
    flat, count = places.flatten().to_numpy(), np.diff(places.offsets.to_numpy())
    return flat + np.repeat(starts, count)
