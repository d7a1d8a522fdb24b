"""Operator 7, language ID: mixture inference over the languages of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlight.llm.words import LOWER, buffer, chunks

BINS = 1 << 15
_FOLD = np.where((np.arange(256) >= 128) | ((LOWER >= 97) & (LOWER <= 122)), LOWER, 32).astype(np.uint8)


def fold_remainder(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, mod parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def _word_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of the trigram at each place inside or beside a word; the first place of each word; each text's first word."""
    raw, at = buffer(texts)
    data = np.full(len(raw) + 2, 32, np.uint8)
    data[1:-1] = _FOLD[raw]
    upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data[1:][upper] += 32  # capital letters of Latin-1
    inside = data != 32
    edge = np.zeros(len(data), bool)
    edge[at[:-1] + 1] = True
    places = np.flatnonzero(inside)
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge[1:])) + 1
    left = np.where(edge[places], 32, data[places - 1]).astype(np.uint32)
    ends = np.zeros(len(data) + 1, bool)
    ends[at[1:] + 1] = True
    right = np.where(ends[places + 1], 32, data[places + 1]).astype(np.uint32)
    code = (left << 16) | (data[places].astype(np.uint32) << 8) | right
    bins = ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)
    return bins, np.searchsorted(places, starts), np.searchsorted(starts, at + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of each language in this partition."""
    total: dict[str, np.ndarray] = {}
    for batch in chunks(batches):
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        bins, word_at, first = _word_grams(batch.column("text"))
        gram_at = np.append(word_at, len(bins))[first]
        names, code = np.unique(langs.astype(str), return_inverse=True)
        which = np.repeat(code, np.diff(gram_at)).astype(np.int64)
        found = np.bincount(which * BINS + bins, minlength=len(names) * BINS).reshape(-1, BINS)
        for name, row in zip(names, found, strict=True):
            total[str(name)] = total.get(str(name), 0) + row
    for name, row in total.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))], ["lang", "bin", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-likelihood of each n-gram bin in each, from all given rows with a lang.

    What reaches the driver is BINS numbers a language, whatever the size of the corpus.
    """
    rows = docs.where("lang is not null").select("text", "lang").mapInArrow(_count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((len(names), BINS))
    if names:
        counts[[names.index(x) for x in rows.column("lang").to_pylist()], rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    counts += 0.5
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _mixture(word_ll: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text's languages by expectation-maximisation, and the log-likelihood."""
    n = np.maximum(np.diff(first), 1)[:, None]
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    top = word_ll.max(axis=1, keepdims=True) if len(word_ll) else np.zeros((0, 1), np.float32)
    like = np.exp(word_ll - top)
    of = np.repeat(np.arange(len(n)), np.diff(first))
    full = np.flatnonzero(np.diff(first))
    total = np.zeros(len(n))
    for _ in range(rounds):
        joint = like * share[of].astype(np.float32)
        each = np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        grown = np.zeros_like(share)
        if len(full):
            grown[full] = np.add.reduceat(joint / each, first[full], axis=0)
            total[full] = np.add.reduceat(np.log(each[:, 0].astype(float)) + top[:, 0], first[full])
        share = grown / n
    return share, total


def choose(word_ll: np.ndarray, first: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Proportions over the set of languages with the best penalised likelihood, one row a text.

    A language costs half the logarithm of the number of words, and 2 more. Sets are the k most
    probable languages of the full mixture; a set is only left for a larger one if that pays.
    """
    texts, langs = len(first) - 1, word_ll.shape[1]
    if not langs:
        return np.zeros((texts, 0))
    share, most = _mixture(word_ll, first, np.ones((texts, langs)), rounds)
    words = np.diff(first)
    cost = 0.5 * np.log(np.maximum(words, 1)) + 2
    alone = np.zeros((texts, langs))
    full = np.flatnonzero(words)
    if len(full):
        alone[full] = np.add.reduceat(word_ll, first[full], axis=0)
    best = np.zeros((texts, langs))
    best[np.arange(texts), alone.argmax(axis=1)] = 1
    value = alone.max(axis=1) - cost
    order = np.argsort(-share, axis=1, kind="stable")
    for k in range(2, langs + 1):
        open_ = np.flatnonzero((most - k * cost > value) & (words > 0))
        if not len(open_):
            break
        allowed = np.zeros((len(open_), langs))
        np.put_along_axis(allowed, order[open_, :k], 1, axis=1)
        at = np.concatenate([[0], np.cumsum(words[open_])])
        rows = np.repeat(first[open_] - at[:-1], words[open_]) + np.arange(at[-1])
        mixed, gain = _mixture(word_ll[rows], at, allowed, rounds)
        better = gain - k * cost[open_] > value[open_]
        best[open_[better]] = mixed[better]
        value[open_[better]] = (gain - k * cost[open_])[better]
    return best


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], rounds: int = 12) -> DataFrame:
    """docs with lang_pred and score.

    lang_pred: the language with the largest proportion in the selected set, the first in order on
    ties; `und` with score 0 if the text is null or has no letter, or if no language was learned.
    Columns of docs with these names are replaced. Empty docs give no rows.
    """
    names, table = model
    docs = docs.drop("lang_pred", "score")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            bins, word_at, first = _word_grams(batch.column("text"))
            word_ll = np.zeros((len(word_at), len(names)), np.float32)
            for k in range(len(names) if len(word_at) else 0):
                word_ll[:, k] = np.add.reduceat(table[k][bins], word_at)
            share = choose(word_ll, first, rounds)
            pred, score = [], []
            for text, row, n in zip(batch.column("text").to_pylist(), share, np.diff(first), strict=True):
                known = bool(names) and n > 0 and _has_letter(text)
                pred.append(names[int(row.argmax())] if known else "und")
                score.append(min(1.0, float(row.max())) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
