"""Operator 3, LM scoring with a gated recurrent model that is trained on the corpus itself."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.language import fold_remainder
from barlight.llm.recurrent import Model, Trainer, one_thread, score
from barlight.llm.store import kept
from barlight.llm.words import Words, chunks, mix

END = mix(np.array([0xE0D], np.uint64))[0]
#: Words that the model tells apart at least, and words whose counts go to every task; others are joined.
MODEL_WORDS, TABLE_WORDS = 2047, 1 << 17
#: Words told apart for each root of the number of different words, and those for each bucket of rarer words.
ROOT_WORDS, BUCKET_WORDS = 16, 8
#: Tokens that a task holds, and blocks of weights that are averaged apart.
HELD, BLOCKS = 3_000_000, 64
#: Training tokens of a shard, and least and most shards: they follow from the corpus, not from its files. A shard
#: writes its weights once a round, which for the largest vocabulary is about as much as the texts of so many tokens.
SHARD_TOKENS, LEAST_SHARDS, MOST_SHARDS = 64_000_000, 8, 4096
#: What all shards write of weights in all rounds is at most this part of what the training tokens' numbers take.
WEIGHTS_SHARE = 0.7


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of the texts, an end after each text's words; the first token of each text."""
    words = Words(texts)
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(words.hash)) + words.text] = words.hash
    return out, first


def count_tokens(docs: DataFrame) -> DataFrame:
    """token (a hash) and n, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            token, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(token)
            token, n = token[order], n[order]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            return token[starts], np.add.reduceat(n, starts)

        size = 0
        for batch in chunks(batches):
            tokens = _tokens(batch.column("text"))[0]
            if len(tokens):
                held.append(np.unique(tokens, return_counts=True))
                size += len(held[-1][0])
            if size > HELD:
                held[:] = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["token", "n"])
                    held, size = [], 0
        if held:
            token, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

    return docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def model_words(distinct: int, table: int) -> int:
    """Words that the model tells apart one by one: they grow with the root of the training words."""
    return min(max(MODEL_WORDS, ROOT_WORDS * math.isqrt(distinct)), table)


class Lookup:
    """Numbers of words in the model's vocabulary; all others have that of their bucket, behind these.

    Hashes lie evenly, so a token's leading bits lead to about its place among the sorted ones.
    """

    def __init__(self, tokens: np.ndarray, buckets: int = 1):
        self.order = np.argsort(tokens)
        self.sorted, self.n, self.buckets = tokens[self.order], len(tokens), buckets
        bits = min(max(self.n.bit_length() + 2, 8), 24)
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.sorted, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        other = self.n + (mix(tokens) % np.uint64(self.buckets)).astype(np.int64)
        if not self.n:
            return other
        at = np.minimum(self.begin.take(tokens >> self.shift), self.n - 1)
        late = np.flatnonzero(self.sorted.take(at) < tokens)
        while len(late):
            late = late[at[late] < self.n - 1]
            at[late] += 1
            late = late[self.sorted.take(at[late]) < tokens[late]]
        return np.where(self.sorted.take(at) == tokens, self.order.take(at), other)


def bucket_counts(counts: DataFrame, vocabulary: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket, the sum of counts and the number of its training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, n, words = Lookup(vocabulary, buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            at = look(batch.column("token").to_numpy().view(np.uint64)) - len(vocabulary)
            np.add.at(n, at[at >= 0], batch.column("n").to_numpy()[at >= 0])
            words += np.bincount(at[at >= 0], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(n), pa.array(words)], ["bucket", "n", "words"])

    rows = counts.select("token", "n").mapInArrow(run, "bucket long, n long, words long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).toArrow()
    out = np.zeros((2, buckets), np.int64)
    out[:, rows.column("bucket").to_numpy()] = rows.column("n").to_numpy(), rows.column("words").to_numpy()
    return out[0], out[1]


def shard_count(tokens: int, weights: int, rounds: int) -> int:
    """Shards of a corpus: by its tokens, but no more than WEIGHTS_SHARE allows, at four bytes a token and two a weight."""
    allowed = int(WEIGHTS_SHARE * 4 * tokens / (2 * weights * rounds))
    return max(1, min(max(tokens // SHARD_TOKENS, LEAST_SHARDS), MOST_SHARDS, allowed))


def encoded(docs: DataFrame, table: np.ndarray, buckets: int, shards: int, rounds: int, complete: bool) -> DataFrame:
    """All rows of docs (doc_id, held_out, text) as numbers of tokens, written once: places in the table, or behind it the bucket.

    row: a number of its own. round, shard: where the text is learned from, by its hash, so that this doesn't
    depend on how docs are stored. rare: hashes of the tokens that the table hasn't; empty if it is complete.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, row = Lookup(table, buckets), TaskContext.get().partitionId() << 40
        for batch in chunks(batches):
            tokens, first = _tokens(batch.column("text"))
            ids = look(tokens)
            late = (ids >= len(table)) & (not complete)
            at = np.concatenate([[0], np.cumsum(late)])[first]
            rare = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens[late].view(np.int64)))
            blob = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((first * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<i4").tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(batch.num_rows)), *(batch.column(n) for n in ("doc_id", "held_out", "round", "shard", "key")), blob.cast(pa.binary()), rare], ["row", "doc_id", "held_out", "round", "shard", "key", "ids", "rare"])
            row += batch.num_rows

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    dealt = docs.select("doc_id", "held_out", "text", key.alias("key")).withColumn("round", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(rounds)).cast("int")).withColumn("shard", F.pmod(F.xxhash64("key", F.lit(4)), F.lit(shards)).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return kept(dealt.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, round int, shard int, key long, ids binary, rare array<long>"), "round")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of some texts one after the other, and the first of each."""
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, "<i4")[at[0] // 4 : at[-1] // 4], (at - at[0]) // 4


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]]:
    """Token numbers of about HELD tokens at a time, with the rows they are from."""
    parts: list[tuple[np.ndarray, np.ndarray, pa.RecordBatch]] = []
    size = 0
    for batch in batches:
        tokens, first = _numbers(batch.column("ids"))
        parts.append((tokens, first, batch))
        size += len(tokens)
        if size > HELD:
            yield _joined(parts)
            parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]:
    first, at = [np.zeros(1, np.int64)], 0
    for tokens, f, _ in parts:
        first.append(f[1:] + at)
        at += len(tokens)
    return np.concatenate([p[0] for p in parts]), np.concatenate(first), [p[2] for p in parts]


def train(rows: DataFrame, to_model: np.ndarray, model: Model, shards: int, rounds: int, rate: float = 0.01) -> Model:
    """The model after one pass over all training rows of encoded(), in rounds that take a part of the documents each.

    In a round every shard goes on from the same weights over its own documents, in order of their hashes;
    what they have moved by is averaged, by the tokens behind it, in blocks: a task averages one block of
    all shards. Moves are written in half precision, a thousandth of each at most off. Only the averages reach the driver. Files and partitions play no part.
    """
    for k in range(rounds):
        part = rows.where((F.col("round") == k) & ~F.col("held_out")).select("shard", "key", "ids")

        def run(batches: Iterator[pa.RecordBatch], start: Model = model) -> Iterator[pa.RecordBatch]:
            for own, total in _shards_learned(batches, start, to_model, rate):
                blobs = [b.astype(np.float16).tobytes() for b in np.array_split(own.flat() - start.flat(), BLOCKS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([total] * BLOCKS, pa.int64()), pa.array(blobs, pa.binary())], ["block", "tokens", "weights"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for block, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    had = sums.setdefault(block, [0.0, 0])
                    had[0] = had[0] + np.frombuffer(blob, np.float16).astype(float) * n
                    had[1] += n
            blobs = [(s / n).astype(np.float32).tobytes() for s, n in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(blobs, pa.binary())], ["block", "weights"])

        trained = part.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "key").mapInArrow(run, "block int, tokens long, weights binary")
        rows_out = trained.repartition("block").sortWithinPartitions("block", "tokens").mapInArrow(average, "block int, weights binary").toArrow()
        if rows_out.num_rows:
            blocks = dict(zip(rows_out.column("block").to_pylist(), rows_out.column("weights").to_pylist(), strict=True))
            model = model.with_flat(model.flat() + np.concatenate([np.frombuffer(blocks[b], np.float32) for b in range(BLOCKS)]))
    return model


def _shards_learned(batches: Iterator[pa.RecordBatch], start: Model, to_model: np.ndarray, rate: float) -> Iterator[tuple[Model, int]]:
    """The model that each shard of a sorted partition comes to, and the shard's tokens."""

    def by_shard() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edge = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if b > a:
                    yield batch.slice(a, b - a)

    def learned(shard: int, first: pa.RecordBatch) -> tuple[Model, int, pa.RecordBatch | None]:
        after: list[pa.RecordBatch] = []

        def mine() -> Iterator[pa.RecordBatch]:
            yield first
            for batch in parts:
                if batch.column("shard")[0].as_py() != shard:
                    after.append(batch)
                    return
                yield batch

        own, total = Trainer(start.with_flat(start.flat()), rate), 0
        for tokens, at, _ in _held(mine()):
            own.learn(to_model[tokens], at, int(np.clip(len(tokens) // 2048, 8, 208)))
            total += len(tokens)
        return own.model, total, after[0] if after else None

    one_thread()
    parts = by_shard()
    batch = next(parts, None)
    while batch is not None:
        model, total, batch = learned(batch.column("shard")[0].as_py(), batch)
        if total:
            yield model, total


def score_documents(docs: DataFrame, hidden: int = 16, rounds: int = 6) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs.

    Tokens: words split by ASCII white space, A-Z lower-cased, and one end; a null or empty text is
    the end alone. Documents whose crc32(doc_id as text) mod 5 is 1 are held out (null ids count as
    the empty text), all others are counted and learned from. base_score: log10 probability under
    the smoothed counts. score: that of the recurrent model, whose state runs through the whole text.
    The model tells model_words() words apart, which grow with the corpus, and reads and predicts each
    other word as its hash's bucket. A bucket's probability is split by smoothed counts, so probabilities
    add up to one over known words and one unknown a bucket.
    Without training tokens the counts are 0 and both scores come from smoothing alone. Repeated rows
    are scored one by one. Counts of TABLE_WORDS words go to every task; those of all rarer words
    are joined by a shuffle, so no vocabulary is too large.
    """
    docs = docs.select("doc_id", (fold_remainder(F.col("doc_id")) == 1).alias("held_out"), "text")
    counts = kept(count_tokens(docs.where(~F.col("held_out"))))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(TABLE_WORDS).toArrow()
    table, table_n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    words = model_words(int(distinct), len(table))
    buckets = max(1, words // BUCKET_WORDS)
    vocabulary, model_n = table[:words], table_n[:words]
    rest, rest_distinct = bucket_counts(counts, vocabulary, buckets)
    complete = distinct <= len(table)
    start = Model.start(np.concatenate([model_n, rest[:-1]]), rest[-1], hidden)
    shards = shard_count(int(total), start.flat().size, rounds)
    rows = encoded(docs, table, buckets, shards, rounds, complete)
    # of a place in the table or a bucket behind it, the model's word
    to_model = np.concatenate([Lookup(vocabulary, buckets)(table), words + np.arange(buckets)]).astype(np.int32)
    model = train(rows, to_model, start, shards, rounds)
    plain = np.log10(total + 0.5 * (distinct + 1))
    spread = np.log10(rest + 0.5 * (rest_distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        log_n = np.append(np.log10(table_n + 0.5), np.log10(0.5) if complete else 0.0)
        for tokens, first, parts in _held(batches):
            ids, at = to_model[tokens], np.minimum(tokens, len(table))
            lp = score(model, ids, first) / np.log(10)
            other = ids >= words
            lp[other] += log_n[at[other]] - spread[ids[other] - words]
            sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has a token
            n = np.diff(first)
            own = pa.Table.from_batches(parts).combine_chunks()
            yield pa.RecordBatch.from_arrays([*(own.column(c).chunk(0) for c in ("row", "doc_id", "held_out")), pa.array(n), pa.array(sums((at < len(table)).astype(np.int64))), pa.array(sums(log_n[at]) - n * plain), pa.array(sums(lp)), own.column("rare").chunk(0)], ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.select("row", "doc_id", "held_out", "ids", "rare").mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>")
    if not complete:
        scored = kept(scored)
        late = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("m")).join(counts, "token", "left")
        more = late.groupBy("row").agg(F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("known"))
        scored = scored.join(more, "row", "left").withColumns({c: F.col(c) + F.coalesce(F.col(x), F.lit(0)) for c, x in (("base_score", "more"), ("score", "more"), ("n_known", "known"))})
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
