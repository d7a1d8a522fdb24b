"""Operator 6, substring dedup by prefix-partitioned suffix trees over words.

The suffixes that may repeat to the depth of a window are dealt by prefixes: first by the gram of words
that is their anchor, so that neighbours travel together as one piece; those of a group that a task
can't hold by their whole prefix up to the end of the anchor, whose length differs from suffix to suffix;
and by the prefix of a window at last. A group's suffixes are sorted, neighbours' common prefixes are
counted in words, and the internal nodes that they make are the tree. Each node of a window's depth or
more is a repeat, to its full depth, and its leaves are the places where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.llm.anchors import chosen, copied, keyed, repeated_anchors, windows_anchor, with_side
from barlight.llm.pieces import HEAD, Pieces, repeated_spans, spans_of
from barlight.llm.store import bucket_bits, kept
from barlight.llm.words import Words, chunks, grams, mix, ranges, within

#: Bytes of a word's hash in a piece.
WORD_BYTES = 5


def gram_words(window: int) -> int:
    """Words of an anchor."""
    return -(-window // 3)


def sorted_suffixes(words: np.ndarray, at: np.ndarray, size: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `starts` of some sequences, and the words that each has in common with the one before it.

    words: numbers, one sequence after the other; at, size: where each begins, and its words. A suffix ends
    with its sequence. Ranks of runs of 1, 2, 4 ... words, made from those of half the length, put them in
    order; common prefixes are counted down the same ranks, which are held in four bytes each.
    """
    ranked = lambda x: np.unique(x, return_inverse=True)[1].astype(np.int32) + 1
    end = np.repeat(at + size, size)
    place = np.arange(len(words))
    ranks = [ranked(words)]
    step = 1
    while step < size.max(initial=0):
        ahead = np.zeros(len(words), np.int64)
        fits = np.flatnonzero(place + step < end)
        ahead[fits] = ranks[-1][fits + step]
        ranks.append(ranked(ranks[-1].astype(np.int64) * (int(ranks[-1].max()) + 1) + ahead))
        step *= 2
    order = starts[np.argsort(ranks[-1][starts], kind="stable")] if len(starts) else starts
    a, b = order[:-1].copy(), order[1:].copy()
    left = np.minimum(end[a] - a, end[b] - b) if len(a) else a
    common = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = np.flatnonzero(common + (1 << k) <= left)
        same = fits[ranks[k][a[fits] + common[fits]] == ranks[k][b[fits] + common[fits]]]
        common[same] += 1 << k
    return order, np.r_[0, common] if len(order) else common


def internal_nodes(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth and leaves [first, last] of the tree's internal nodes of `least` words or more.

    common: of sorted suffixes, as from sorted_suffixes(). A node of depth d is a longest run of suffixes
    whose neighbours have d words in common, and some no more.
    """
    depth, first, last = [], [], []
    for d in np.unique(common[common >= least]):
        inside = np.r_[common >= d, False]
        lo = np.flatnonzero(inside[1:] & ~inside[:-1])
        hi = np.flatnonzero(~inside[1:] & inside[:-1])
        exact = np.cumsum(np.r_[0, common == d])
        of = exact[hi + 1] > exact[lo + 1]
        depth.append(np.full(of.sum(), d))
        first.append(lo[of])
        last.append(hi[of])
    if not depth:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(depth), np.concatenate(first), np.concatenate(last)


def _numbers(body: np.ndarray) -> np.ndarray:
    out = np.zeros((len(body) // WORD_BYTES, 8), np.uint8)
    out[:, :WORD_BYTES] = body.reshape(-1, WORD_BYTES)
    return out.reshape(-1).view("<u8")


def repeats(pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first, end) of the words below deep internal nodes: each leaf, to the depth of its deepest node.

    A leaf whose piece has the same words from one word earlier on below a node of one word more is left
    out: that repeat isn't maximal to the left.
    """
    windows = pieces.head["windows"].astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), windows)
    place = ranges(np.zeros(len(pieces), np.int64), windows)
    order, common = sorted_suffixes(_numbers(pieces.body), pieces.at, pieces.units, pieces.at[piece] + place)
    depth, first, last = internal_nodes(common, pieces.length)
    deep = np.zeros(len(pieces.body) // WORD_BYTES + 1, np.int64)
    for d in np.unique(depth):  # deeper nodes come later
        nodes = np.flatnonzero(depth == d)
        deep[order[ranges(first[nodes], last[nodes] - first[nodes] + 1)]] = d
    at = pieces.at[piece] + place
    found = deep[at] > 0
    inner = found & (place > 0)
    inner[inner] = deep[at[inner] - 1] > deep[at[inner]]
    found &= ~inner
    return piece[found], place[found], place[found] + deep[at[found]]


def longer_prefixes(window: int):
    """Suffixes of a large group one by one, by the prefix up to the anchor's end (level 1) or of a window (level 2)."""

    def split(pieces: Pieces, level: int) -> Pieces:
        windows = pieces.head["windows"].astype(np.int64)
        piece = np.repeat(np.arange(len(pieces)), windows)
        one = pieces.windows(piece, ranges(np.zeros(len(pieces), np.int64), windows), np.ones(len(piece), np.int64))
        words = one.head["offset"].astype(np.int64) + gram_words(window) if level == 1 else one.units
        one.head["path"] = mix(one.hashes(words))
        return one

    return split


def _anchored(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the grams, the windows that stand in one text, and the anchor of each."""
    n = gram_words(window)
    gram = grams(words.hash, n)
    start = np.flatnonzero(within(words.first, window))
    return gram, start, windows_anchor(gram, window - n + 1)[start]


def repeated_windows(docs: DataFrame, window: int, held_bytes: int = 4 << 20, most_bytes: int = 16 << 20) -> DataFrame:
    """(text_key, spans) of words covered by windows that occur at another place, as packed pairs (first, end).

    docs: text, text_key. held_bytes, most_bytes: of suffixes that a task holds together, and of a group beyond
    which it gets longer prefixes. Texts of several rows count once.
    """

    def anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = Words(texts, lower=False)
        gram, _, anchor = _anchored(words, window)
        anchor = np.unique(anchor)
        text = np.searchsorted(words.first, anchor, "right") - 1
        return gram[anchor], text, anchor - words.first[text]

    def cut(batch: pa.RecordBatch) -> Pieces:
        words = Words(batch.column("text"), lower=False)
        gram, start, anchor = _anchored(words, window)
        marked = np.zeros(len(words.hash) + 1, bool)
        marked[chosen(batch, words.first[:-1])] = True
        keep = marked[anchor]
        start, anchor = start[keep], anchor[keep]
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(start) else start
        text = np.searchsorted(words.first, start[new], "right") - 1
        head = np.zeros(len(new), HEAD)
        head["anchor"], head["key"] = gram[anchor[new]], batch.column("text_key").to_numpy().view(np.uint64)[text]
        head["path"] = mix(head["anchor"])
        head["first"], head["offset"] = start[new] - words.first[text], anchor[new] - start[new]
        head["windows"] = np.diff(np.append(new, len(start)))
        at = ranges(start[new], head["windows"].astype(np.int64) + window - 1)
        body = (words.hash[at] >> np.uint64(64 - 8 * WORD_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
        return Pieces(head, body.reshape(-1), window, WORD_BYTES)

    bits = bucket_bits(docs)
    some = with_side(docs, repeated_anchors(docs, anchors, bits)).select("text", "text_key", "places")
    return repeated_spans(some, cut, repeats, longer_prefixes(window), window, WORD_BYTES, bits, held_bytes, most_bytes)


def remove_passages(docs: DataFrame, window: int = 35) -> DataFrame:
    """All rows and columns of docs with n_words, n_removed, spans and kept_text.

    A word goes if a window of `window` words that covers it occurs at another place, in any row or in
    the same text; overlapping occurrences count, and windows are judged on the input. Words are split
    by ASCII white space and are not changed; kept words are joined by one space. spans: the removed
    runs of words. Null, empty and short texts lose nothing (null: kept_text is empty). Every row of
    repeated rows counts, so a text of two rows and `window` words goes whole. Columns of docs with
    the names of results or text_key, copied are replaced.
    """
    extra = ["n_words", "n_removed", "spans", "kept_text"]
    docs = docs.drop(*extra, "text_key", "copied")
    texts = keyed(docs)
    found = repeated_windows(texts, window)
    twice = copied(texts).withColumn("copied", F.lit(True))
    fate = kept(found.join(twice, "text_key", "full"))
    own = docs.columns
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string("n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out: dict[str, list] = {n: [] for n in extra}
            for text, found, twice in zip(*(batch.column(n).to_pylist() for n in ("text", "spans", "copied")), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                spans = spans_of(found, len(words), window, bool(twice))
                kept_words, at = [], 0
                for a, b in spans:
                    kept_words += words[at:a]
                    at = b
                kept_words += words[at:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept_words))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept_text"].append(b" ".join(kept_words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(out["kept_text"], pa.string())], [*own, *extra])

    joined = with_side(docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")))), fate, "left")
    return joined.select(*own, "spans", "copied").mapInArrow(run, schema)
