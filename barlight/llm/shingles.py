"""Sets of word shingles of each text of a chunk, as sorted 52-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from barlight.llm.words import Words, chunks, grams, mix, within

#: Of the 64 bits of a sort key, 52 are the shingle's, 12 the text's number in its chunk.
BITS, MOST_TEXTS = 52, 1 << 12


def small_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        for at in range(0, batch.num_rows, MOST_TEXTS):
            yield batch.slice(at, MOST_TEXTS)


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and where each text's begin.

    A text of fewer than `width` words has one shingle, its whole sequence; one without words has none.
    """
    words = Words(texts)
    at = np.flatnonzero(within(words.first, width))
    values, of = [grams(words.hash, width)[at]], [words.text[at]]
    for n in range(1, width):
        short = np.flatnonzero(words.count == n)
        if len(short):
            values.append(grams(words.hash, n)[words.first[short]])
            of.append(short)
    keys = (np.concatenate(of).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(values) >> np.uint64(64 - BITS))
    keys.sort()
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
    first = np.searchsorted(keys >> np.uint64(BITS), np.arange(len(words.count) + 1))
    return keys & np.uint64((1 << BITS) - 1), first


def least_hash(values: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """The smallest of the shingles' hashes, which two sets share as often as they are similar; 0 for the empty set."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.minimum.reduceat(mix(values ^ np.uint64(seed)), first[full])
    return out


def set_ids(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set: equal sets have equal numbers. 0 for the empty set.

    The first 16 bits are those of the smallest shingle hash, so that similar sets are near in order.
    """
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        whole = mix(np.add.reduceat(mix(values + np.uint64(1)), first[full]) + np.diff(first)[full].astype(np.uint64))
        near = mix(least_hash(values, first, 1)[full])
        out[full] = (whole >> np.uint64(16)) | (near >> np.uint64(48) << np.uint64(48))
    return out
