"""Operator 5, license scans: an exact set-similarity join of spans of words with license templates."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.llm.words import MARK, Words, chunks

# Phrases and labels of the plain count, and public license notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    *((f"cc-{k}", f"Licensed under CC {k.upper()} 4.0") for k in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")),
    *((f"cc-{k}", f"This work is licensed under a Creative Commons {name} 4.0 International License") for k, name in (
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"), ("by-nc", "Attribution-NonCommercial"),
        ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))),
    ("cc0", "Licensed under CC0 1.0 Universal"),
)
#: Words that tell licenses apart: a block without those of its template meets the threshold, but doesn't give the label.
NAMES = "mit apache general lesser mozilla cc cc0 creative sa nd nc sharealike noderivatives noncommercial"
#: Words of a block at most, for each word of its template.
SPAN = 2


@dataclass(frozen=True)
class Templates:
    """Templates as sets of ranks: a word's rank is its place among all words of templates, the corpus's rarest first."""

    tokens: np.ndarray  # hashes of all words of templates, sorted
    rank: np.ndarray  # of each of these
    sets: list[np.ndarray]  # of each template, sorted ranks
    need: np.ndarray  # words that a block must share with it
    width: np.ndarray  # words of a block at most
    names: list[frozenset]

    @classmethod
    def of(cls, texts: list[str], tokens: np.ndarray, counts: dict[int, int], least: float) -> Templates:
        n = np.array([counts.get(t, 0) for t in tokens.tolist()], np.int64)
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, n))] = np.arange(len(tokens))
        hashes = [_hashes(t) for t in texts]
        sets = [np.sort(rank[np.searchsorted(tokens, np.unique(h))]) for h in hashes]
        need = np.array([math.ceil(least * len(x) - 1e-9) for x in sets], np.int64)
        named = np.intersect1d(_hashes(NAMES), tokens)
        known = set(rank[np.searchsorted(tokens, named)].tolist())
        return cls(tokens, rank, sets, need, np.array([SPAN * len(h) for h in hashes], np.int64), [frozenset(known & set(x.tolist())) for x in sets])

    def index(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The prefixes of some templates by rank: where each rank's entries begin, template and place in its set."""
        rows = [(int(r), int(k), i) for k in which for i, r in enumerate(self.sets[k][: len(self.sets[k]) - self.need[k] + 1])]
        rank, k, i = np.array(sorted(rows), np.int64).reshape(-1, 3).T
        return np.searchsorted(rank, np.arange(len(self.tokens) + 1)), k, i

    def classes(self) -> list[tuple[int, np.ndarray]]:
        """Templates by their width, rounded up to a power of two."""
        rounded = 1 << np.ceil(np.log2(np.maximum(self.width, 1))).astype(np.int64)
        full = np.array([len(x) > 0 for x in self.sets], bool)
        return [(int(w), np.flatnonzero((rounded == w) & full)) for w in np.unique(rounded[full])]


def _runs(n: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def block_candidates(templates: Templates, width: int, index: tuple, text: np.ndarray, place: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and template of the blocks that share enough words with a template.

    Every stretch of `width` words lies in one of the blocks of twice as many that begin each `width` words.
    A block is the set of its words that templates have, in order of rank. Its pairs with templates come from
    the templates' prefixes; they stay if the block is long enough, and if behind their first shared word,
    this one included, both sets still have as many words as are needed. For these, shared words are counted.
    """
    begins, entry_k, entry_i = index
    number = place // width
    second = number > 0
    span = int(number.max(initial=0)) + 1
    block = np.concatenate([text * span + number, text[second] * span + number[second] - 1])
    pairs = np.unique(block * len(templates.tokens) + np.concatenate([rank, rank[second]]))
    block, rank = pairs // len(templates.tokens), pairs % len(templates.tokens)
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(block)])
    of = np.repeat(np.arange(len(first)), size)

    n = begins[rank + 1] - begins[rank]
    entry = np.repeat(begins[rank], n) + _runs(n)
    at = np.repeat(np.arange(len(rank)), n)
    _, head = np.unique(of[at] * len(templates.sets) + entry_k[entry], return_index=True)
    b, k, i, j = of[at[head]], entry_k[entry[head]], entry_i[entry[head]], at[head] - first[of[at[head]]]
    length = np.array([len(x) for x in templates.sets])
    good = (size[b] >= templates.need[k]) & (np.minimum(length[k] - i, size[b] - j) >= templates.need[k])
    b, k = b[good], k[good]

    member = np.zeros((len(templates.sets), len(templates.tokens)), bool)
    for x, ranks in enumerate(templates.sets):
        member[x, ranks] = True
    pair = np.repeat(np.arange(len(b)), size[b])
    shared = np.bincount(pair, member[k[pair], rank[first[b[pair]] + _runs(size[b])]], len(b))
    good = shared >= templates.need[k]
    b, k = b[good], k[good]
    return block[first[b]] // span, block[first[b]] % span * width, k


def spans(ranks: np.ndarray, places: np.ndarray, width: int, names: frozenset, need: int) -> Iterator[tuple[int, int, frozenset]]:
    """First and last word, and the words of the template that they hold, of stretches without overlaps.

    Those of most of its words come first, then those with its names, then the shortest. Those of fewer
    than `need` words are left out, unless none has more; then the best of them is given.
    """
    place, word = places.tolist(), ranks.tolist()
    held: Counter = Counter()
    found, left = [], 0
    for right, w in enumerate(word):
        held[w] += 1
        while place[right] - place[left] >= width or held[word[left]] > 1:
            held[word[left]] -= 1
            if not held[word[left]]:
                del held[word[left]]
            left += 1
        found.append((-len(held), not names <= held.keys(), place[right] - place[left], left, right))
    found.sort()
    taken = np.zeros(len(word), bool)
    for n, _, _, left, right in found:
        if -n < need and taken.any():
            return
        if not taken[left : right + 1].any():
            taken[left : right + 1] = True
            yield place[left], place[right], frozenset(word[left : right + 1])
            if -n < need:
                return


def _hashes(text: str) -> np.ndarray:
    return Words(pa.array([text]), MARK).hash


def token_counts(docs: DataFrame, tokens: np.ndarray) -> dict[int, int]:
    """How often each of the tokens (few, of templates) stands in the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in chunks(batches):
            h = Words(batch.column("text"), MARK).hash
            at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
            total += np.bincount(at[tokens[at] == h], minlength=len(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(total)], ["token", "n"])

    rows = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token % 2**64: r.n for r in rows.collect()}


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, least: float = 0.5) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score, matches and blocks.

    Words are runs of letters, digits and other than ASCII characters, A-Z lower-cased. n_base: places
    where the words of a phrase of PHRASES stand consecutively; first_word and last_word: the smallest
    and largest of them. A block is at most SPAN times as many consecutive words as the template has,
    across line breaks. Its containment of a template is the part of the template's different words
    that it has. blocks: (line from 0 on which it begins, label, containment) of all blocks of `threshold` or
    more that don't overlap better ones of their template. matches: those of them that give their label. A block
    doesn't if it lacks those words of the template that are in NAMES, or if one of another label with its own names
    overlaps it and has the same words and more. score: the largest containment of a document's blocks, or 0 below
    `least`. Null, empty and wordless texts have no words and labels; score 0. Repeated rows are told one by one.

    The join: words of templates are put in order of their counts in the whole corpus, rarest first. Blocks that
    share a word of a template's prefix, the first |T| - ceil(least * |T|) + 1 of its words, are its candidates; length and
    positional filters drop those that can't share enough (block_candidates), and the others are searched in one
    pass. Templates are an argument, as large as the caller makes them; they go to every task.
    """
    hashes = [np.unique(_hashes(t)) for _, t in templates]
    tokens = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    table = Templates.of([t for _, t in templates], tokens, token_counts(docs, tokens) if len(tokens) else {}, least)
    enough = np.array([math.ceil(threshold * len(x) - 1e-9) for x in table.sets], np.int64)
    classes = [(width, table.index(which)) for width, which in table.classes()]
    widest = int(table.width.max(initial=0))
    labels = [label for label, _ in templates]
    phrases = [(label, _hashes(p)) for p, label in PHRASES.items()]
    extra = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, " + ", ".join(f"{c} array<struct<line:long,label:string,containment:double>>" for c in ("matches", "blocks"))
    added = T._parse_datatype_string(extra).fields
    own = [c for c in docs.columns if c not in {f.name for f in added}]
    docs = docs.select(*own)
    schema = T.StructType([*docs.schema.fields, *added])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))] * 2

    def located(text: np.ndarray, place: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, int, int, int, float, frozenset]]:
        """Text, template, first and last word, containment and shared words of blocks, from words of templates in order."""
        for width, index in classes:
            of, lo, k = block_candidates(table, width, index, text, place, rank)
            if not len(of):
                continue
            order = np.lexsort((lo, of, k))
            of, lo, k = of[order], lo[order], k[order]
            fresh = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (k[1:] != k[:-1]) | (lo[1:] > lo[:-1] + 2 * width)])
            for a, b in zip(fresh.tolist(), np.r_[fresh[1:], len(of)].tolist(), strict=True):
                d, x = int(of[a]), int(k[a])
                i, j = np.searchsorted(text, [d, d + 1])
                i, j = i + np.searchsorted(place[i:j], [lo[a], lo[b - 1] + 2 * width])
                mine = i + np.flatnonzero(np.isin(rank[i:j], table.sets[x]))
                for first, last, held in spans(rank[mine], place[mine], int(table.width[x]), table.names[x], int(enough[x])):
                    if len(held) >= table.need[x]:
                        yield d, x, first, last, len(held) / len(table.sets[x]), held

    def chosen(matches: list[tuple]) -> list[bool]:
        """Of matches sorted by first word, those with their template's names that no overlapping one of another label outdoes."""
        named = [y for y in matches if table.names[y[0]] <= y[4]]
        starts = [y[1] for y in named]

        def outdone(x: tuple) -> bool:
            near = named[bisect_left(starts, x[1] - widest) : bisect_right(starts, x[2])]
            return any(labels[x[0]] != labels[y[0]] and x[1] <= y[2] and x[4] <= y[4] and (x[4] < y[4] or x[3] < y[3]) for y in near)

        return [table.names[x[0]] <= x[4] and not outdone(x) for x in matches]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"), MARK)
            h, text = words.hash, words.text
            texts = len(words.count)
            n_base = np.zeros(texts, np.int64)
            lo, hi = np.full(texts, -1), np.full(texts, -1)
            base: list[set] = [set() for _ in range(texts)]
            for label, phrase in phrases:
                at = np.flatnonzero(h[: len(h) - len(phrase) + 1] == phrase[0])
                for i, token in enumerate(phrase[1:], 1):
                    at = at[h[at + i] == token]
                at = at[text[at] == text[at + len(phrase) - 1]]
                of = text[at]
                place = at - words.first[of]
                np.add.at(n_base, of, 1)
                np.maximum.at(hi, of, place)
                for d, p in zip(of.tolist(), place.tolist(), strict=True):
                    base[d].add(label)
                    lo[d] = p if lo[d] < 0 else min(lo[d], p)
            lines = np.flatnonzero(words.data == 10)
            line = np.searchsorted(lines, words.start)
            matches: list[list] = [[] for _ in range(texts)]
            if len(tokens):
                token = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                pos = np.flatnonzero(tokens[token] == h)
                for d, *match in located(text[pos], pos - words.first[text[pos]], table.rank[token[pos]]):
                    matches[d].append(match)
            before = np.searchsorted(lines, words.at)
            rows = []
            for d in range(texts):
                good = sorted((x for x in matches[d] if len(x[4]) >= enough[x[0]]), key=lambda x: (x[1], x[2], x[0]))
                blocks = [{"line": int(line[words.first[d] + x[1]] - before[d]), "label": labels[x[0]], "containment": x[3]} for x in good]
                given = [x for x, c in zip(blocks, chosen(good), strict=True) if c]
                all_labels = sorted(base[d] | {x["label"] for x in given})
                score = max((x[3] for x in matches[d]), default=0.0)
                rows.append((int(words.count[d]), int(n_base[d]), int(lo[d]) if lo[d] >= 0 else None, int(hi[d]) if hi[d] >= 0 else None, ",".join(sorted(base[d])), ",".join(all_labels), score, given, blocks))
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], [*own, *(f.name for f in added)])

    return docs.mapInArrow(run, schema)
