"""Operator 1, n-gram Jaccard join by PartEnum signatures.

Sets fall into bands of sizes, each a quarter wider than the last. A class holds the pairs whose
larger set is of one band; a set takes part in the classes of its own band and of the next. In a
class, two sets that link differ in at most h elements. The domain of shingles is cut into n1
partitions, each of them into n2 parts. At least one partition has at most k2 of the differences, so
some n2 - k2 of its parts are free of them: a signature is the content of such a subset of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlight.llm.components import components
from barlight.llm.shingles import set_ids, shingle_sets, small_chunks
from barlight.llm.store import bucket_bits, kept
from barlight.llm.words import mix, planes, ranges, unplanes

#: Bytes of a signature beyond the first bits, by which it is dealt, and signatures of a bucket that a task sorts itself.
SIGNATURE_BYTES, MOST_SIGNATURES = 6, 4_000_000
#: A candidate table of at most so many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Members of one signature that are compared in one task at a time; those of at most SMALL are compared with other signatures' at once.
BLOCK, SMALL = 2048, 128
#: Times that sets ask for their nearest before all that are still apart are compared.
ASKING = 1
SUBSETS = ((0, 1), (0, 2), (1, 2))


@dataclass(frozen=True)
class Scheme:
    """Threshold num/den, as whole numbers; bands and partitions follow from it."""

    num: int = 80
    den: int = 100
    width: int = 5
    spare: float = 0.2

    def differ(self, total: np.ndarray) -> np.ndarray:
        """Most differences of two sets that link, from the sum of their sizes."""
        return total * (self.den - self.num) // (self.den + self.num)

    def largest(self, size: np.ndarray) -> np.ndarray:
        return size * self.den // self.num

    def bands(self, most: int) -> np.ndarray:
        """The largest size of each band, up to `most` and one band beyond."""
        out, low = [], 1
        while True:
            out.append(low * self.den // self.num)
            if low > most:
                return np.array(out, np.int64)
            low = out[-1] + 1

    def parts(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n1, n2 and k2 of the classes whose largest size is top."""
        need = self.differ(2 * top) + 1
        fine = need <= 24
        n1 = np.where(fine, -(-need // 2), need)
        return n1 + np.ceil(self.spare * n1).astype(np.int64) * (need > 1), np.where(fine, 3, 1), np.where(fine, 1, 0)


def signatures(values: np.ndarray, first: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets, and the number of the set that each belongs to.

    A signature of at most one shingle says little. A set leaves these out if it has so few partitions
    with such a signature that any set linked with it still shares another; else it keeps them all.
    """
    size = np.diff(first)
    tops = scheme.bands(int(size.max(initial=1)))
    band = np.searchsorted(tops, size)
    spread = mix(values + np.uint64(0x51ED270B))
    out, owner = [], []
    for step in (0, 1):
        top = tops[band + step]
        n1, n2, k2 = scheme.parts(top)
        use = np.flatnonzero(size)
        cells = n1 * n2
        base = np.concatenate([[0], np.cumsum(cells[use])])
        rows = ranges(first[:-1][use], size[use])
        count = size[use]
        cell = ((values[rows] >> np.uint64(20)) * np.repeat(cells[use].astype(np.uint64), count) >> np.uint64(32)).astype(np.int64)
        cell += np.repeat(base[:-1], count)
        total, held = np.zeros(base[-1], np.uint64), np.zeros(base[-1], np.int32)
        if len(cell):
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            total[cell[starts]] = np.add.reduceat(spread[rows], starts)
            held[cell[starts]] = np.diff(np.append(starts, len(cell)))
        reach = np.minimum(scheme.largest(size), top)
        spare = n1 - scheme.differ(size + reach) // (k2 + 1) - 1
        for fine in (False, True):
            mine = np.flatnonzero(k2[use] == fine)
            if not len(mine):
                continue
            parts = n1[use[mine]]
            at = ranges(base[mine], cells[use[mine]])
            of = np.repeat(np.arange(len(mine)), parts)
            sums, counts = total[at], held[at]
            if fine:
                sums, counts = sums.reshape(-1, 3), counts.reshape(-1, 3)
                sums = np.stack([sums[:, a] + sums[:, b] for a, b in SUBSETS], 1)
                counts = np.stack([counts[:, a] + counts[:, b] for a, b in SUBSETS], 1)
            else:
                sums, counts = sums[:, None], counts[:, None]
            low = counts <= 1
            weak = np.bincount(of, low.any(axis=1), len(mine))
            drop = (weak <= spare[use[mine]])[of]
            place = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
            tag = mix((top[use[mine]][of].astype(np.uint64) << np.uint64(24)) + place.astype(np.uint64))
            for k in range(sums.shape[1]):
                keep = ~(low[:, k] & drop)
                out.append(mix(sums[keep, k] ^ mix(tag[keep] + np.uint64(k))))
                owner.append(use[mine][of[keep]])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def _new_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sets of each chunk, and which of them this task has not had yet: copies end here."""
    seen = np.zeros(0, np.uint64)
    for batch in small_chunks(batches):
        values, first = shingle_sets(batch.column("text"), width)
        ids = set_ids(values, first)
        new = np.zeros(len(ids), bool)
        new[np.unique(ids, return_index=True)[1]] = True
        new &= (np.diff(first) > 0) & ~np.isin(ids, seen)
        seen = np.append(seen, ids[new])
        yield batch, values, first, ids, new


def _only(values: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = np.diff(first)[which]
    return values[ranges(first[:-1][which], count)], np.concatenate([[0], np.cumsum(count)])


def with_set_ids(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, text_key, n_shingles and set_id of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_chunks(batches):
            values, first = shingle_sets(batch.column("text"), scheme.width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(first)), pa.array(set_ids(values, first).view(np.int64))], ["doc_id", "text_key", "n_shingles", "set_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, set_id long")


def shared_signatures(docs: DataFrame, scheme: Scheme, most: int = MOST_SIGNATURES) -> DataFrame:
    """(signature, set_id, n, mate): signatures of two or more different sets, n of them; mate: the other set of two, on one row.

    A bucket of more than `most` entries isn't held: its entries go on as they are, and Spark counts them.
    """
    bits = bucket_bits(docs)
    schema = "signature long, set_id long, n long, mate long"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            sig, sid = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(sig)
            sig, sid = sig[order], sid[order]
            bucket = sig >> np.uint64(64 - bits)
            edge = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)] if len(bucket) else np.zeros(1, np.int64)
            rest = (sig << np.uint64(bits)) >> np.uint64(64 - 8 * SIGNATURE_BYTES)
            blobs = [planes(rest[a:b], SIGNATURE_BYTES) + sid[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]].astype(np.int64)), pa.array(blobs, pa.binary())], ["bucket", "data"])

        size = 0
        for _, values, first, ids, new in _new_sets(batches, scheme.width):
            which = np.flatnonzero(new)
            sig, owner = signatures(*_only(values, first, which), scheme)
            held.append((sig, ids[which][owner]))
            size += len(sig)
            if size > 4_000_000:
                yield flush()
                size = 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, size, over = -1, [], 0, False
        wide = SIGNATURE_BYTES + 8

        def close() -> pa.RecordBatch:
            n = SIGNATURE_BYTES
            sig = np.concatenate([unplanes(x[: len(x) // wide * n], n) for x in parts])
            sid = np.concatenate([np.frombuffer(x[len(x) // wide * n :], "<u8") for x in parts])
            if not over:
                order = np.argsort(sig, kind="stable")
                sig, sid = sig[order], sid[order]
                again = sig[1:] == sig[:-1]
                near = np.flatnonzero(np.r_[again, False] | np.r_[False, again])
                sig, sid = sig[near], sid[near]
            order = np.lexsort((sid, sig))
            sig, sid = sig[order], sid[order]
            keep = np.r_[True, (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])] if len(sig) else np.zeros(0, bool)
            sig, sid = sig[keep], sid[keep]
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
            group = np.diff(np.append(starts, len(sig)))
            n_of = np.repeat(group, group) if not over else np.zeros(len(sig), np.int64)
            two = starts[group == 2] if not over else starts[:0]
            mate = np.zeros(len(sig), np.int64)
            has = np.zeros(len(sig), bool)
            mate[two], has[two] = sid[two + 1].view(np.int64), True
            many = (n_of > 1) | over
            full = (sig[many] << np.uint64(bits)) | np.uint64(bucket)
            return pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), pa.array(sid[many].view(np.int64)), pa.array(n_of[many]), pa.array(mate[many], mask=~has[many])], ["signature", "set_id", "n", "mate"])

        for batch in batches:
            for b, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if b != bucket:
                    if parts:
                        yield close()
                    parts, size, over = [], 0, False
                bucket = b
                parts.append(data)
                size += len(data) // wide
                if size > most:
                    over = True
                    yield close()
                    parts, size = [], 0
        if parts:
            yield close()

    dealt = docs.select("text").mapInArrow(emit, "bucket long, data binary").repartition("bucket").sortWithinPartitions("bucket")
    found = kept(dealt.mapInArrow(meet, schema))
    if found.where("n = 0").isEmpty():
        return found
    late = found.where("n = 0").select("signature", "set_id").distinct()
    counts = late.groupBy("signature").agg(F.count("*").alias("n"), F.min("set_id").alias("least"), F.max("set_id").alias("most")).where("n > 1")
    counted = late.join(counts, "signature").select("signature", "set_id", "n", F.when((F.col("n") == 2) & (F.col("set_id") == F.col("least")), F.col("most")).alias("mate"))
    return kept(found.where("n > 0").union(counted))


def sets_of(docs: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """set_id, size, sketch and elements of the sets whose text_key is in wanted.

    A sketch has the parity of the number of shingles in each of 1024 or more cells; two sets differ
    in at least as many shingles as their sketches in bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, first, ids, new in _new_sets(batches, scheme.width):
            which = np.flatnonzero(new)
            values, first = _only(values, first, which)
            size = np.diff(first)
            sketches, blobs = [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                wide = 1 << max(10, int(b - a).bit_length() + 2)
                bits = np.bincount((values[a:b] & np.uint64(wide - 1)).astype(np.int64), minlength=wide) & 1
                sketches.append(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes())
                blobs.append(planes(values[a:b], 7))
            yield pa.RecordBatch.from_arrays([pa.array(ids[which].view(np.int64)), pa.array(size), pa.array(sketches, pa.binary()), pa.array(blobs, pa.binary())], ["set_id", "size", "sketch", "elements"])

    small = wanted.count() <= BROADCAST_ROWS
    docs = docs.select("text", F.xxhash64("text").alias("text_key")).join(F.broadcast(wanted) if small else wanted, "text_key", "left_semi")
    return docs.select("text").mapInArrow(run, "set_id long, size long, sketch binary, elements binary").dropDuplicates(["set_id"])


def linked(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (u, v) that link, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                both = np.concatenate([unplanes(a, 7), unplanes(b, 7)])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(scheme.den * same >= scheme.num * (len(both) - same))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("set_id").alias("u"), F.col("elements").alias("a"))
    b = sets.select(F.col("set_id").alias("v"), F.col("elements").alias("b"))
    return pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def near_pairs(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (u, v) whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n, a, b = (batch.column(c) for c in ("m", "n", "a", "b"))
            most = scheme.differ(m.to_numpy() + n.to_numpy()).tolist()
            keep = []
            for x, y, far in zip(a.to_pylist(), b.to_pylist(), most, strict=True):
                wide = 8 * min(len(x), len(y))
                keep.append((_folded(x, wide) ^ _folded(y, wide)).bit_count() <= far)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("set_id").alias("u"), F.col("size").alias("m"), F.col("sketch").alias("a"))
    b = sets.select(F.col("set_id").alias("v"), F.col("size").alias("n"), F.col("sketch").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "m", "n", "a", "b").mapInArrow(run, "u long, v long")


def _folded(sketch: bytes, wide: int) -> int:
    """The sketch as a number of `wide` bits."""
    x, now = int.from_bytes(sketch, "little"), 8 * len(sketch)
    while now > wide:
        now //= 2
        x = (x >> now) ^ (x & ((1 << now) - 1))
    return x


def _narrow(sketch: np.ndarray, wide: int) -> np.ndarray:
    while sketch.shape[1] > wide:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def close_pairs(groups: DataFrame, scheme: Scheme, nearest: bool) -> DataFrame:
    """Pairs (u, v) of one signature and different roots whose sketches allow a link; nearest: for each u only the nearest v.

    groups: signature, set_id, root, size, sketch, asking; with nearest only sets that ask are held against
    others. A signature of more than BLOCK sets is compared block by block in several tasks; a pair never
    leaves the task that turns it down.
    """

    def compare(x: dict, y: dict, ahead: bool) -> tuple[np.ndarray, np.ndarray]:
        """ahead: x is the first part of y, and each of y is held against those before it only."""
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, (1 << 19) // max(1, y["sketch"].size))
        for i in range(0, len(x["root"]), step):
            part = slice(i, i + step)
            far = np.bitwise_count(x["sketch"][part, None] ^ y["sketch"][None]).sum(axis=2, dtype=np.int64)
            hit = (far <= scheme.differ(x["size"][part, None] + y["size"][None])) & (x["root"][part, None] != y["root"][None])
            a, b = np.nonzero(hit)
            if ahead:
                a, b = a[b > a + i], b[b > a + i]
            if nearest and len(a):
                order = np.lexsort((far[a, b], a))
                first = order[np.r_[True, a[order][1:] != a[order][:-1]]]
                a, b = a[first], b[first]
            us.append(x["set_id"][part][a])
            vs.append(y["set_id"][b])
        u, v = np.concatenate(us), np.concatenate(vs)
        return np.minimum(u, v), np.maximum(u, v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def close() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            cols = {n: t.column(n).to_numpy(zero_copy_only=False) if n == "asking" else t.column(n).to_numpy() for n in ("set_id", "root", "size", "block", "asking")}
            sketches = t.column("sketch").to_pylist()
            wide = min(map(len, sketches))
            sketch = np.concatenate([_narrow(np.frombuffer(s, np.uint8)[None], wide) for s in sketches])
            sketch = np.ascontiguousarray(sketch).view(np.uint64)
            lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
            part = lambda m: {n: x[m] for n, x in cols.items()} | {"sketch": sketch[m]}
            if lo == hi:
                # only sets outside the most common root are held against all
                roots, n = np.unique(cols["root"], return_counts=True)
                outside = cols["root"] != roots[n.argmax()]
                if nearest:
                    u, v = compare(part(outside & cols["asking"]), part(np.ones(len(outside), bool)), False)
                else:
                    order = np.argsort(~outside, kind="stable")
                    u, v = compare(part(order[: outside.sum()]), part(order), True)
            elif nearest:
                low, high, asks = cols["block"] == lo, cols["block"] == hi, cols["asking"]
                (u, v), (x, y) = compare(part(low & asks), part(high), False), compare(part(high & asks), part(low), False)
                u, v = np.concatenate([u, x]), np.concatenate([v, y])
            else:
                u, v = compare(part(cols["block"] == lo), part(cols["block"] == hi), False)
            both = np.unique(np.stack([u, v], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

        for batch in batches:
            sig, lo, hi = (batch.column(n).to_numpy() for n in ("signature", "lo", "hi"))
            edges = np.flatnonzero((sig[1:] != sig[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(sig)], strict=True):
                if b > a:
                    now = (sig[a], lo[a], hi[a])
                    if held and now != key:
                        yield close()
                        held = []
                    key = now
                    held.append(batch.slice(a, b - a))
        if held:
            yield close()

    counts = groups.groupBy("signature").agg(F.count("*").alias("n"))
    blocks = groups.drop("n").join(counts, "signature").withColumn("blocks", F.expr(f"int((n - 1) div {BLOCK}) + 1"))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    pair = F.explode(F.expr("transform(sequence(0, blocks - 1), i -> struct(least(i, block) as lo, greatest(i, block) as hi))"))
    dealt = blocks.withColumn("pair", pair).select("signature", "pair.lo", "pair.hi", "block", "set_id", "root", "size", "sketch", "asking")
    dealt = dealt.repartition("signature", "lo", "hi").sortWithinPartitions("signature", "lo", "hi")
    return dealt.mapInArrow(run, "u long, v long").distinct()


def small_pairs(groups: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (u, v) as of close_pairs(), for signatures of few sets: all of a task's at once, column by column."""

    def compare(t: pa.Table) -> pa.RecordBatch:
        sig, ids, root, size = (t.column(n).to_numpy() for n in ("signature", "set_id", "root", "size"))
        sketch = t.column("sketch").combine_chunks().cast(pa.large_binary())
        sketch = sketch.chunk(0) if isinstance(sketch, pa.ChunkedArray) else sketch
        _, at, data = sketch.buffers()
        at = np.frombuffer(at, np.int64)[sketch.offset : sketch.offset + len(sketch) + 1]
        data, wide = np.frombuffer(data, np.uint8), np.diff(at)
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        least = np.repeat(np.minimum.reduceat(wide, starts), np.diff(np.append(starts, len(sig))))
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for w in np.unique(least):
            rows = np.flatnonzero(least == w)
            table = np.zeros((len(rows), int(w)), np.uint8)
            for x in np.unique(wide[rows]):
                mine = np.flatnonzero(wide[rows] == x)
                table[mine] = _narrow(data[ranges(at[rows[mine]], wide[rows[mine]])].reshape(-1, int(x)), int(w))
            table = table.view(np.uint64)
            s, r, n, i = sig[rows], root[rows], size[rows], ids[rows]
            for d in range(1, len(rows)):
                same = s[d:] == s[:-d]
                if not same.any():
                    break
                a = np.flatnonzero(same & (r[d:] != r[:-d]))
                far = np.bitwise_count(table[a] ^ table[a + d]).sum(axis=1, dtype=np.int64)
                a = a[far <= scheme.differ(n[a] + n[a + d])]
                us.append(i[a])
                vs.append(i[a + d])
        u, v = np.concatenate(us), np.concatenate(vs)
        both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > 50_000:
                t = pa.Table.from_batches(held)
                sig = t.column("signature").to_numpy()
                cut = int(np.flatnonzero(sig != sig[-1])[-1]) + 1 if sig[0] != sig[-1] else 0
                if cut:
                    yield compare(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), len(t) - cut
        if rows:
            yield compare(pa.Table.from_batches(held))

    dealt = groups.select("signature", "set_id", "root", "size", "sketch").repartition("signature").sortWithinPartitions("signature")
    return dealt.mapInArrow(run, "u long, v long").distinct()


def jaccard_components(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key and group_id of every row of docs (doc_id, text).

    Two documents link when their sets of shingles have a Jaccard similarity of the threshold or more;
    component_id is the smallest doc_id that links reach, the row's own included. Null and wordless
    texts have no shingle and stay alone. A null doc_id counts last: it is a component_id only where
    all ids are null. Repeated rows are all returned. Sets are told apart by 52-bit shingle hashes.
    Copies are one set throughout, so that a group of copies costs as much as one document. Only sets
    that share a signature are fetched. Two sets that are alone with a signature are a pair, compared
    once however many signatures they share. In larger groups each set is held first against the one
    before it, similar sets standing together, with which it shares most signatures; then against the
    nearest of another component by sketches, in one of its signatures at a time; last all sets that are still in different components are
    compared. Sketches only turn pairs down that can't link, the rest is decided by the whole sets, so no
    link is lost.
    """
    meta = kept(with_set_ids(docs, scheme))
    shared = shared_signatures(docs, scheme)
    ids = shared.select("set_id").distinct()
    wanted = kept(meta.where("n_shingles > 0").groupBy("set_id").agg(F.min("text_key").alias("text_key")).join(ids, "set_id", "left_semi").select("text_key"))
    sets = kept(sets_of(docs, wanted, scheme))
    twos = shared.where("mate is not null").select(F.least("set_id", "mate").alias("u"), F.greatest("set_id", "mate").alias("v")).distinct()
    links = kept(linked(near_pairs(twos, sets, scheme), sets, scheme))
    larger = kept(shared.where("n > 2").select("signature", "set_id", "n"))
    links = kept(links.union(linked(near_pairs(_neighbours(larger), sets, scheme), sets, scheme)))
    sketches = sets.select("set_id", "size", "sketch")
    for k in range(ASKING):
        homes = kept(larger.groupBy("set_id").agg(F.min_by("signature", F.xxhash64("signature", F.lit(k))).alias("home")))
        rooted = _apart(larger.join(homes.select(F.col("home").alias("signature")).distinct(), "signature", "left_semi"), links)
        asked = rooted.join(homes, "set_id").withColumn("asking", F.col("home") == F.col("signature")).join(sketches, "set_id")
        links = kept(links.union(linked(kept(close_pairs(asked, scheme, True)), sets, scheme)))
    rooted = kept(_apart(larger, links)).join(sketches, "set_id").withColumn("asking", F.lit(True))
    pairs = small_pairs(rooted.where(F.col("n") <= SMALL), scheme).union(close_pairs(rooted.where(F.col("n") > SMALL), scheme, False)).distinct()
    links = kept(links.union(linked(kept(pairs), sets, scheme)))
    roots = components(links).toDF("set_id", "root")
    least = meta.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = kept(least.groupBy("root").agg(F.min("doc_id").alias("component_id")).join(least.select("root", "set_id"), "root").select("set_id", "root", "component_id"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return meta.join(named, "set_id").select("doc_id", "n_shingles", own.alias("component_id"), "text_key", F.col("root").alias("group_id"))


def first_of_each_group(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """docs with one row of each group of linked documents: that of the smallest doc_id.

    Of several rows with that id the one with the smallest text_key stays, of equal rows any. All rows
    without a shingle stay.
    """
    names = docs.columns
    found = kept(jaccard_components(docs.select("doc_id", "text"), scheme))
    heads = found.where("n_shingles > 0 and doc_id <=> component_id").groupBy("group_id", "component_id", "text_key").agg(F.count("*").alias("n"))
    heads = heads.groupBy("group_id", "component_id").agg(F.min(F.struct("text_key", "n")).alias("x")).select("group_id", F.col("component_id").alias("head_id"), "x.*")
    heads = kept(heads)
    several = not heads.where("n > 1").isEmpty()
    small = heads.count() <= BROADCAST_ROWS
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    heads = (F.broadcast(heads) if small else heads).withColumnRenamed("text_key", "head_key")
    kept_rows = keyed.join(heads, (F.col("text_key") == F.col("head_key")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    if several:
        kept_rows = kept_rows.dropDuplicates(["group_id"])
    wordless = found.where("n_shingles = 0").select("text_key").distinct()
    return kept_rows.select(*names).union(keyed.join(wordless, "text_key", "left_semi").select(*names))


def _apart(shared: DataFrame, links: DataFrame) -> DataFrame:
    """shared with the root of each set's component, without the signatures whose sets are all of one."""
    roots = components(links).toDF("set_id", "root")
    rooted = kept(shared.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")))
    apart = rooted.groupBy("signature").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("signature")
    return rooted.join(apart, "signature", "left_semi")


def _neighbours(shared: DataFrame) -> DataFrame:
    """(u, v): for each set the one that comes before it, in an order that brings similar sets together, in most of its signatures.

    A signature of very many sets is cut into stretches of that order.
    """
    stretch = F.when(F.col("n") > BLOCK, F.shiftrightunsigned("set_id", 56)).otherwise(0)
    before = F.lag("set_id").over(Window.partitionBy("signature", stretch).orderBy("set_id"))
    pairs = shared.select(F.col("set_id").alias("u"), before.alias("v")).where("v is not null")
    return pairs.groupBy("u", "v").agg(F.count("*").alias("n")).groupBy("u").agg(F.max_by("v", F.struct("n", "v")).alias("v"))
