"""Operator 4, suffix-array dedup of byte strings.

Strings of the wanted length that may repeat are found by their anchors. Round each such anchor the
bytes of the strings that it stands for are a piece. A task cuts its pieces into blocks, counted from
the anchor, and builds one suffix array of the blocks of all of them; suffixes that share enough
blocks stand side by side there. What is left of a string before its first and behind its last whole
block is compared among these. This is done with the pieces of each task first and then, dealt by
their anchors, with those of all tasks.
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
from barlight.llm.words import buffer, byte_codes, chunks, mix, ranges, rolling, span_hash, within

#: Bytes of an anchor and of a block.
GRAM, BLOCK = 32, 40


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of the suffixes of a list of whole numbers, by linear grouping.

    First, suffixes are grouped by their Lyndon prefix. They begin in groups of one symbol. The groups
    are taken from the greatest to the smallest: each suffix in hand points to the nearest one before
    it that is of a smaller group, and a suffix that is pointed to c times has its prefix grown by c
    times that of the group in hand, so it moves to a new group just above its own; more often
    pointed to is greater. Then the order of each group follows from suffixes that are in place
    already: from each of them, smallest first, the pointers lead to those that come next.
    """
    n = len(symbols)
    members: list[list[int]] = []
    group, number = [0] * n, {}
    for value in sorted(set(symbols)):
        number[value] = len(members)
        members.append([])
    for i, value in enumerate(symbols):
        group[i] = number[value]
        members[group[i]].append(i)
    lower, higher = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    before, done = [-1] * n, bytearray(n)
    finished: list[tuple[int, int]] = []
    now = len(members) - 1
    while now >= 0:
        inside = sorted(i for i in members[now] if group[i] == now)
        finished.append((now, len(inside)))
        for i in inside:
            done[i] = 1
        hits: dict[int, int] = {}
        for i in inside:
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        grown: dict[tuple[int, int], list[int]] = {}
        for j, c in hits.items():
            grown.setdefault((group[j], -c), []).append(j)
        for old, c in sorted(grown):  # of one old group those of most hits first: others push them up
            moved, new, next_ = grown[old, c], len(members), higher[old]
            members.append(moved)
            lower.append(old)
            higher.append(next_)
            higher[old] = new
            if next_ >= 0:
                lower[next_] = new
            for j in moved:
                group[j] = new
        now = lower[now]
    slot, at, out, placed = {}, 0, [0] * n, bytearray(n)
    for g, size in reversed(finished):
        slot[g] = at
        at += size
    end = n
    for k in range(-1, n):
        j = (end if k < 0 else out[k]) - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            out[slot[group[j]]] = j
            slot[group[j]] += 1
            j = before[j]
    return out


def _anchored(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, hashes of their grams, the strings that stand in one text, and the anchor of each."""
    data, at = buffer(texts)
    prefix = rolling(byte_codes(data))
    place = np.arange(max(0, len(data) - GRAM + 1))
    gram = span_hash(prefix, place, place + GRAM)
    start = np.flatnonzero(within(at, length))
    return data, at, gram, start, windows_anchor(gram, length - GRAM + 1)[start]


def repeated_strings(pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first, end) of the bytes of strings that another piece has at the same place from the same anchor."""
    head, data, at, length = pieces.head, pieces.body, pieces.at, pieces.length
    need = length // BLOCK - 1
    offset = head["offset"].astype(np.int64)
    low = -(offset // BLOCK)  # blocks are counted from the anchor
    count = (pieces.units - offset) // BLOCK - low
    piece = np.repeat(np.arange(len(head)), count)
    block = ranges(low, count)
    begin = at[piece] + offset[piece] + block * BLOCK
    prefix = rolling(byte_codes(data))
    code = mix(span_hash(prefix, begin, begin + BLOCK) + mix(head["anchor"][piece] + block.astype(np.uint64)))
    rank = np.unique(code, return_inverse=True)[1] + 1
    # a 0 ends each piece
    ends = np.cumsum(count)
    symbols = np.zeros(len(code) + len(head), np.int64)
    where = np.arange(len(code)) + piece
    symbols[where] = rank
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    own = np.full(len(symbols), -1)
    own[where] = np.arange(len(code))
    order = own[order]
    left = ends[piece] - np.arange(len(code))
    order = order[order >= 0]
    order = order[left[order] >= need]
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(need):
        same &= rank[order[1:] + k] == rank[order[:-1] + k]
    run = np.cumsum(np.r_[True, ~same]) if len(order) else order
    shared = np.r_[same, False] | np.r_[False, same] if len(order) else np.zeros(0, bool)
    order, run = order[shared], run[shared]
    out_piece, out_place = [], []
    for head_bytes in range(BLOCK):
        start = begin[order] - head_bytes
        place = start - at[piece[order]]
        ok = (place >= 0) & (place < head["windows"][piece[order]])
        start, place, mine, r = start[ok], place[ok], piece[order][ok], run[ok]
        middle = start + head_bytes
        rest = middle + need * BLOCK
        string = mix(span_hash(prefix, start, middle) + mix(span_hash(prefix, rest, start + length) + mix(r.astype(np.uint64))))
        by = np.argsort(string, kind="stable")
        again = string[by][1:] == string[by][:-1]
        hit = by[np.r_[again, False] | np.r_[False, again]] if len(by) else by
        out_piece.append(mine[hit])
        out_place.append(place[hit])
    piece, place = np.concatenate(out_piece), np.concatenate(out_place)
    order = np.lexsort((place, piece))
    piece, place = piece[order], place[order]
    new = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)]) if len(piece) else piece
    last = np.append(new[1:] - 1, len(piece) - 1) if len(piece) else piece
    return piece[new], place[new], place[last] + length


def longer_paths(pieces: Pieces, level: int) -> Pieces:
    """The strings of a large group in smaller pieces: those with the same first whole block, dealt by this and the last one, then by all."""
    windows = pieces.head["windows"].astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), windows)
    place = ranges(np.zeros(len(pieces), np.int64), windows)
    block = (pieces.head["offset"][piece].astype(np.int64) - place) // BLOCK
    new = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (block[1:] != block[:-1])]) if len(piece) else piece
    small = pieces.windows(piece[new], place[new], np.diff(np.append(new, len(piece))))
    prefix = rolling(byte_codes(small.body))
    first = small.at + small.head["offset"].astype(np.int64) - block[new] * BLOCK
    last = first + (pieces.length // BLOCK - 1) * BLOCK
    span = span_hash(prefix, first, last) if level > 1 else span_hash(prefix, first, first + BLOCK) + mix(span_hash(prefix, last - BLOCK, last))
    small.head["path"] = mix(span ^ mix(small.head["anchor"] + block[new].astype(np.uint64)))
    return small


def repeated_runs(docs: DataFrame, length: int, held_bytes: int = 4 << 20, most_bytes: int = 16 << 20) -> DataFrame:
    """(text_key, spans) covered by strings of `length` bytes that occur at another place. docs: text, text_key."""

    def anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, at, gram, _, anchor = _anchored(texts, length)
        anchor = np.unique(anchor)
        text = np.searchsorted(at, anchor, "right") - 1
        return gram[anchor], text, anchor - at[text]

    def cut(batch: pa.RecordBatch) -> Pieces:
        data, at, gram, start, anchor = _anchored(batch.column("text"), length)
        marked = np.zeros(len(gram), bool)
        marked[chosen(batch, at[:-1])] = True
        keep = marked[anchor]
        start, anchor = start[keep], anchor[keep]
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(start) else start
        text = np.searchsorted(at, start[new], "right") - 1
        head = np.zeros(len(new), HEAD)
        head["anchor"], head["key"] = gram[anchor[new]], batch.column("text_key").to_numpy().view(np.uint64)[text]
        head["path"] = mix(head["anchor"])
        head["first"], head["offset"] = start[new] - at[text], anchor[new] - start[new]
        head["windows"] = np.diff(np.append(new, len(start)))
        return Pieces(head, data[ranges(start[new], head["windows"].astype(np.int64) + length - 1)], length, 1)

    bits = bucket_bits(docs)
    some = with_side(docs, repeated_anchors(docs, anchors, bits)).select("text", "text_key", "places")
    return repeated_spans(some, cut, repeated_strings, longer_paths, length, 1, bits, held_bytes, most_bytes)


def remove_strings(docs: DataFrame, length: int = 400) -> DataFrame:
    """All rows and columns of docs with n_bytes, n_removed, spans and kept (binary).

    A byte of a text's UTF-8 goes if a string of `length` bytes that covers it begins anywhere else,
    in any row or in the same text; overlapping ones count, and strings are judged on the input.
    spans: the maximal removed runs of bytes; kept: the other bytes, one after the other. Null, empty
    and short texts lose nothing. A text of two rows and `length` bytes goes whole. Columns of docs
    with the names of results or text_key, spans, copied are replaced. length: at least 2 blocks and a gram.
    """
    if length < max(2 * BLOCK, GRAM + 1):
        raise ValueError(f"length must be at least {max(2 * BLOCK, GRAM + 1)}")
    extra = ["n_bytes", "n_removed", "spans", "kept"]
    docs = docs.drop(*extra, "text_key", "copied")
    own = docs.columns
    texts = keyed(docs)
    fate = kept(repeated_runs(texts, length).join(copied(texts).withColumn("copied", F.lit(True)), "text_key", "full"))
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string("n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out: dict[str, list] = {n: [] for n in extra}
            data, at = buffer(batch.column("text"))
            for k, (found, twice) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("spans", "copied")), strict=True)):
                text = data[at[k] : at[k + 1]].tobytes()
                spans = spans_of(found, len(text), length, bool(twice))
                left = [text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True)]
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept"].append(b"".join(left))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), pa.array(out["n_bytes"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["spans"], span), pa.array(out["kept"], pa.binary())], [*own, *extra])

    joined = with_side(docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")))), fate, "left")
    return joined.select(*own, "spans", "copied").mapInArrow(run, schema)
