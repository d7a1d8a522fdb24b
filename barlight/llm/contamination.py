"""Operator 2, benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.llm.store import kept
from barlight.llm.words import MARK, Words, chunks, grams, rolling, span_hash, within

#: Words of the benchmark that go to every task at once; a larger benchmark is gone through in blocks of so many.
BLOCK_WORDS = 2_000_000


def tile(item: np.ndarray, text: np.ndarray, least: int) -> int:
    """Words of item in the tiles of greedy string tiling.

    The longest common run of words that no tile covers yet becomes a tile, until none of `least`
    words is left. Runs of one length are compared by their running Karp-Rabin hashes; the search
    length starts at the longest possible and falls to the longest run that is left.
    """
    if not len(item) or not len(text):
        return 0
    a, b = rolling(item), rolling(text)
    free_a, free_b = np.ones(len(item), bool), np.ones(len(text), bool)

    def common(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        used_a, used_b = np.cumsum(np.r_[0, ~free_a]), np.cumsum(np.r_[0, ~free_b])
        at_a = np.flatnonzero(used_a[n:] == used_a[: len(used_a) - n])
        at_b = np.flatnonzero(used_b[n:] == used_b[: len(used_b) - n])
        if not len(at_a) or not len(at_b):
            return None
        ha, hb = span_hash(a, at_a, at_a + n), span_hash(b, at_b, at_b + n)
        order = np.argsort(hb, kind="stable")
        lo, hi = np.searchsorted(hb[order], ha), np.searchsorted(hb[order], ha, "right")
        hit = np.flatnonzero(hi > lo)
        return (at_a[hit], lo[hit], at_b[order]) if len(hit) else None

    covered, length = 0, min(len(item), len(text))
    while length >= least:
        low, high = least, length  # the longest length with a common run: common runs of n contain runs of n - 1
        if common(least) is None:
            break
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if common(mid) is not None else (low, mid - 1)
        length = low
        starts, lo, at_b = common(length)
        hb = span_hash(b, at_b, at_b + length)
        for s, k in zip(starts, lo, strict=True):
            if not free_a[s : s + length].all():
                continue
            h = hb[k]
            while k < len(at_b) and hb[k] == h and not free_b[at_b[k] : at_b[k] + length].all():
                k += 1
            if k < len(at_b) and hb[k] == h:
                free_a[s : s + length] = False
                free_b[at_b[k] : at_b[k] + length] = False
                covered += length
    return covered


def _blocks(items: DataFrame) -> Iterator[tuple[list, np.ndarray, np.ndarray, int]]:
    """Ids, word hashes and first words of the items, and the number of blocks: about BLOCK_WORDS words at a time: only one block is in the driver.

    Items are dealt to blocks by their hash; how many blocks there are follows from the number of all words.
    """
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 4
    blocks = int(total // BLOCK_WORDS) + 1
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id").toArrow()
        if part.num_rows:
            words = Words(part.column("text"), MARK)
            yield part.column("item_id").to_pylist(), words.hash, words.first, blocks


def _seeds(hashes: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each seed length: seeds in order, the item of each, and its place in the item. Shorter items are one seed."""
    out, size = [], np.diff(first)
    for n in range(1, least + 1):
        ok = within(first, n)
        of = np.searchsorted(first, np.arange(len(ok)), "right") - 1
        ok &= (size[of] == n) | (n == least)
        at = np.flatnonzero(ok)
        if len(at):
            seeds = grams(hashes, n)[at]
            order = np.argsort(seeds, kind="stable")
            out.append((n, seeds[order], of[at][order], (at - first[of[at]])[order]))
    return out


def contamination(docs: DataFrame, items: DataFrame, least: int = 5, threshold: float = 0.5) -> DataFrame:
    """docs with contaminated, item_id, coverage and n_items.

    Words: runs of letters, digits and other than ASCII characters, A-Z lower-cased. coverage: the
    largest part of an item (item_id, text) that tiles of `least` or more words of the document cover
    (an item of fewer words: all of it), in whatever order they stand; item_id: that item, the smallest
    on ties, null without a tile. contaminated: coverage is at least `threshold`. n_items: items
    of which that holds. Null and wordless texts and items have coverage 0. A null item_id can be
    found, too, and then leaves item_id null. Columns of docs with the names of results are replaced.
    Items go to every task in blocks of about BLOCK_WORDS words, one block after another, so that a larger
    benchmark needs more passes, not more memory, in tasks or in the driver.
    """
    own = [c for c in docs.columns if c not in ("contaminated", "item_id", "coverage", "n_items")]
    docs = docs.select(*own)
    kind = items.schema["item_id"].dataType
    added = [T.StructField("item_id", kind), T.StructField("coverage", T.DoubleType()), T.StructField("n_items", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *added])
    out = docs.select("*", F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("coverage"), F.lit(0).cast("long").alias("n_items"))
    for ids, hashes, first, blocks in _blocks(items):
        out = out.mapInArrow(_scan(own, ids, hashes, first, least, threshold), schema)
        if blocks > 1:
            out = kept(out)  # so that the block needn't stay
    return out.withColumn("contaminated", F.col("n_items") > 0)


def _scan(own: list[str], ids: list, hashes: np.ndarray, first: np.ndarray, least: int, threshold: float):
    sizes = np.diff(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(hashes, first, least)
        for batch in chunks(batches):
            words = Words(batch.column("text"), MARK)
            found = []
            for n, known, item, place in seeds:
                at = np.flatnonzero(within(words.first, n))
                got = grams(words.hash, n)[at]
                lo = np.searchsorted(known, got)
                hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == got)
                count = np.searchsorted(known, got[hit], "right") - lo[hit]
                which = np.repeat(lo[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found.append((np.repeat(at[hit], count), item[which], place[which], np.full(len(which), n)))
            at, item, place, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
            text = np.searchsorted(words.first, at, "right") - 1
            order = np.lexsort((item, text))
            at, item, place, n, text = (x[order] for x in (at, item, place, n, text))
            edges = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (text[1:] != text[:-1]), True]) if len(at) else np.zeros(1, np.int64)
            best = list(zip(*(batch.column(c).to_pylist() for c in ("item_id", "coverage", "n_items")), strict=True))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                k, d, span = int(item[a]), int(text[a]), int(n[a])
                mine = np.zeros(int(sizes[k]), bool)
                for p in np.unique(place[a:b]):
                    mine[p : p + span] = True
                if mine.sum() < threshold * sizes[k] and mine.mean() < best[d][1]:
                    continue  # no tiling can cover more than the seeds do
                near = np.zeros(int(words.count[d]), bool)
                for p in np.unique(at[a:b]) - words.first[d]:
                    near[p : p + span] = True
                # words off all seeds match nothing: one stands for each run of them
                keep = near | np.r_[True, near[:-1]]
                own_words = np.where(near, words.hash[words.first[d] : words.first[d + 1]], np.uint64(0))[keep]
                share = tile(hashes[first[k] : first[k + 1]], own_words, min(span, int(sizes[k]))) / int(sizes[k])
                was, cover, hits = best[d]
                if share > cover or share == cover > 0 and was is not None and ids[k] is not None and ids[k] < was:
                    was, cover = ids[k], share
                best[d] = (was, cover, hits + (share >= threshold))
            columns = list(zip(*best, strict=True)) if best else [(), (), ()]
            kind = batch.schema.field("item_id").type
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(columns[0], kind), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int64())], [*own, "item_id", "coverage", "n_items"])

    return run
