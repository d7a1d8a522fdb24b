"""Conversation repair: the cheapest edits that bring turns into the order of roles s?(ua)+, or to nothing.

A conversation's roles are one letter a turn. They are aligned to each feasible length of the
alternating string by Wagner-Fischer tables, cut to the band that the best cost so far allows, and the
audits of equal cost are compared. Long conversations are aligned in blocks of turns from each state
of the grammar; a block's results are a small table of states, and tables are joined in order. So one
conversation can lie in many tasks.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.llm.words import chunks

# Costs of the edits, kinds of damage by the remainder of the key's hash, and the patterns of texts.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
DROPPED, EMPTIED, UNPUNCTUATED, REPEATED, REROLED = range(5)
KINDS = 20
INK, STOPS = r"[^\x20\x09-\x0D]", r"[.!?]"
ENDS_WELL = r"[.!?][\x20\x09-\x0D]*\z"

#: States of the grammar: nothing kept yet, after system, after user, after assistant; and what each still needs at the end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

#: Turns that are aligned at once.
BLOCK = 12


def target(state: int, system: bool, length: int) -> str:
    """The roles that follow a state in the grammar: an alternating string, after a system turn if one is to come."""
    if system:
        return ("s" + "ua" * length)[:length]
    return ("au" * length if state == USER else "ua" * length)[:length]


def state_after(state: int, roles: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}[roles[-1]] if roles else state


def plain_cost(turns: tuple[tuple[str, str], ...]) -> int:
    """A cost that no cheapest alignment from any state exceeds: must-deletes go, others take the role that comes."""
    return sum(DELETE if fault in "bd" else REROLE + (TRUNCATED if fault == "t" else 0) for _, fault in turns)


def wagner_fischer(turns: tuple[tuple[str, str], ...], roles: str, most: int) -> tuple[int, str] | None:
    """The cheapest edits of turns into roles and the ASCII-least audit of them, or None if they cost more than `most`.

    rest[i][j] is the cost of turns i.. into roles j.., filled from the end within the band of cells whose
    surplus of turns or roles costs no more than `most`. The last edit is never an insertion.
    """
    n, m = len(turns), len(roles)
    none = most + 1
    # A path at turn i and role j has i - j turns too many so far, and the rest of the surplus ahead of it.
    surplus = n - m
    spare = most - (DELETE * surplus if surplus > 0 else -INSERT * surplus)
    if spare < 0:
        return None
    aside = spare // (DELETE + INSERT)
    behind, ahead = max(surplus, 0) + aside, max(-surplus, 0) + aside
    rest = [[none] * (m + 2) for _ in range(n + 2)]
    rest[n][m] = 0

    def price(i: int, j: int) -> tuple[int, int]:
        """Of keeping or reroling turn i as role j, and of deleting it."""
        role, fault = turns[i]
        if fault in "bd" and fault:
            return none, DELETE
        extra = TRUNCATED if fault == "t" else 0
        if j < m and role == roles[j]:
            return extra, DELETE
        return (REROLE + extra if j < m and roles[j] != "s" else none), DELETE

    for i in range(n - 1, -1, -1):
        row, after = rest[i], rest[i + 1]
        for j in range(min(m, i + ahead), max(0, i - behind) - 1, -1):
            match, delete = price(i, j)
            best = delete + after[j]
            if j < m:
                best = min(best, match + after[j + 1])
                if roles[j] != "s":
                    best = min(best, INSERT + row[j + 1])
            row[j] = min(best, none)
    if rest[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        match, delete = price(i, j)
        here = rest[i][j]
        if delete + rest[i + 1][j] == here:
            audit.append("D")
            i += 1
        elif j < m and roles[j] != "s" and INSERT + rest[i][j + 1] == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i][0] == roles[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


@functools.lru_cache(maxsize=1 << 15)
def aligned(turns: tuple[tuple[str, str], ...], state: int) -> dict[int, tuple[int, str]]:
    """For each state that turns (role's letter and fault) can end in from a state: least cost and its ASCII-least audit.

    Lengths of the target are tried from that of the turns outwards, as long as a length's surplus costs no
    more than the best so far. Each state has its own best, which cuts the bands of its lengths.
    """
    best: dict[int, tuple[int, str]] = {}
    n = len(turns)
    # From the plain alignment one state can be had; another takes an insertion, or a deletion, more.
    bound = plain_cost(turns) + DELETE + INSERT
    for system in (False, True) if state == START else (False,):
        for length in sorted(range(0, 2 * n + 2), key=lambda k: (abs(k - n), k)):
            if system and not length:
                continue
            roles = target(state, system, length)
            end = state_after(state, roles)
            most = best[end][0] if end in best else bound
            found = wagner_fischer(turns, roles, most)
            if found is not None and (end not in best or found < best[end]):
                best[end] = found
    return best


def joined(tables: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """Least cost and ASCII-least audit of a whole conversation from its blocks' tables: state before -> state after -> (cost, audit).

    Costs are added from the end; audits are then chosen from the begin. Two audits of a block are never
    begins of each other, as none ends with an insertion.
    """
    rest: dict[int, int] = {s: INSERT * len(e) for s, e in ENDING.items()}
    costs = [rest]
    for table in reversed(tables):
        rest = {s: min(c + rest[e] for e, (c, _) in ends.items() if e in rest) for s, ends in table.items() if any(e in rest for e in ends)}
        costs.append(rest)
    costs.reverse()
    state, audit = START, []
    for table, here, after in zip(tables, costs, costs[1:], strict=False):
        choice, state = min((a, e) for e, (c, a) in table[state].items() if e in after and c + after[e] == here[state])
        audit.append(choice)
    return costs[0][START], "".join([*audit, ENDING[state]])


def damaged(rows: DataFrame) -> DataFrame:
    """rows of conv_id, turn, role, text with what the hash of conv_id:turn does to them: copies (0: dropped), role, text. Nulls are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % KINDS
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", F.when(kind == REROLED, "user").otherwise(role).alias("role"), F.when(kind == EMPTIED, "").when(kind == UNPUNCTUATED, F.regexp_replace(text, STOPS, "")).otherwise(text).alias("text"), F.when(kind == DROPPED, 0).when(kind == REPEATED, 2).otherwise(1).alias("copies"))


def _fault(text: Column) -> Column:
    return F.when(~text.rlike(INK), "b").when(~text.rlike(ENDS_WELL), "t").otherwise("")


_ORDER = ["conv_id", "turn", "role", "digest"]
_BLOCKS = "conv_id long, turn long, role string, digest binary, number long, turns long, illegal long, first string, last string, tables string"


def _tables(found: dict[int, dict[int, tuple[int, str]]]) -> str:
    return ";".join(f"{s},{e},{c},{a}" for s, ends in found.items() for e, (c, a) in ends.items())


def _read_tables(text: str) -> dict[int, dict[int, tuple[int, str]]]:
    out: dict[int, dict[int, tuple[int, str]]] = {}
    for entry in text.split(";"):
        s, e, c, a = entry.split(",")
        out.setdefault(int(s), {})[int(e)] = (int(c), a)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows: each conversation's turns, BLOCK at a time, with their table and where they begin."""
    names = [f.split()[0] for f in _BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []
    open_, turns, number, head = None, [], 0, ()
    whole: bool = False  # whether the conversation's first turn is seen to stand in this partition

    def close() -> None:
        nonlocal turns, number, whole
        key = tuple(turns)
        states = (START,) if whole and number == 0 else (START, SYSTEM, USER, ASSISTANT)
        letters = [role for role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        out.append((*head, number, len(turns), illegal, letters[0], letters[-1], _tables({s: aligned(key, s) for s in states})))
        number += 1
        turns = []

    for batch in batches:
        for conv, turn, role, digest, fault, n, first in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "fault", "n", "first")), strict=True):
            if (conv,) != open_:
                if turns:
                    close()
                whole, open_, number = open_ is not None, (conv,), 0
            for copy in range(n):
                if not turns:
                    head = (conv, turn, role, digest)
                turns.append((role[:1], fault if fault == "b" or first and not copy else "d"))
                if len(turns) == BLOCK:
                    close()
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out = []
    if turns:
        close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs, audits, illegal = [], [], []
        for blocks in batch.column("blocks").to_pylist():
            cost, audit = joined([_read_tables(b["tables"]) for b in blocks])
            costs.append(cost)
            audits.append(audit)
            illegal.append(sum(b["illegal"] for b in blocks) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(blocks, blocks[1:], strict=False)))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(illegal, pa.int64())], names=["conv_id", "cost", "audit", "illegal"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows. Its audit comes before its turns; one row is held at a time."""
    ids, hashes = [], []
    open_, audit, at, state, digest, begun = None, "", 0, START, hashlib.sha256(), False

    def put(role: str, text: str) -> None:
        nonlocal begun
        digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
        begun = True

    def expected() -> str:
        return "assistant" if state == USER else "user"

    def inserted() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            put(expected(), "")
            state = ASSISTANT if state == USER else USER
            at += 1

    for batch in chunks(batches):
        for conv, said, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True):
            if said is not None:
                if open_ is not None:
                    inserted()
                    ids.append(open_[0])
                    hashes.append(digest.hexdigest())
                open_, audit, at, state, digest, begun = (conv,), said, 0, START, hashlib.sha256(), False
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit == "R":
                role = expected()
            if edit != "D":
                put(role, text)
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        if len(ids) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
            ids, hashes = [], []
    if open_ is not None:
        inserted()
        ids.append(open_[0])
        hashes.append(digest.hexdigest())
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def turn_rows(rows: DataFrame) -> DataFrame:
    """Different rows of each conversation after damage, without texts: their number n, own fault, and whether an equal role and text stood before."""
    hurt = damaged(rows).where("copies > 0")
    narrow = hurt.select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), _fault(F.col("text")).alias("fault"), "copies")
    equal = narrow.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").cast("int").alias("n"))
    # Nulls come first: a struct orders them so.
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = equal.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("least")).toDF("f_conv", "f_role", "f_digest", "least")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    return equal.join(firsts, same).select(*equal.columns, (at == F.col("least")).alias("first"))


def repair(rows: DataFrame) -> DataFrame:
    """A row for each conv_id of rows (conv_id, turn, role, text), damaged first: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are taken in order of turn (nulls first); equal turns in order of role and of their texts' MD5. Null
    roles and texts are one space; a null conv_id is a conversation. Empty and very long texts are rows like
    others. A conversation without rows after damage has zeros, an empty audit and an empty string's hash.
    Other columns are not read. Tables without rows give none.

    Faults, counts and audits come from rows without texts: equal ones are counted, sorted in ranges of
    (conv_id, turn) and aligned in blocks, so a conversation may lie in many tasks. Its audit is one value,
    and so are a block's tables, some 30 bytes a turn, while it is put together. Its hash can only be taken in
    order: texts are dealt by conversation and go through, one row at a time, behind their audit.
    """
    rows = rows.select("conv_id", "turn", "role", "text")
    flagged = turn_rows(rows)
    dup = F.when(F.col("fault") == "b", 0).otherwise(F.col("n") - F.when(F.col("first"), 1).otherwise(0))
    counts = flagged.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        F.sum(F.when(F.col("fault") == "b", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(dup).alias("duplicate"),
        F.count(F.when((F.col("fault") == "t") & F.col("first"), 1)).alias("truncated"),
    )
    ordered = flagged.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    blocks = ordered.mapInArrow(_blocks, _BLOCKS)
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "digest", "number", "illegal", "first", "last", "tables")
    of_conversation = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(at)).alias("blocks"))
    lists = of_conversation.select("conv_id", F.transform("blocks", lambda b: F.struct(b["illegal"].alias("illegal"), b["first"].alias("first"), b["last"].alias("last"), b["tables"].alias("tables"))).alias("blocks"))
    audits = lists.mapInArrow(_audits, "conv_id long, cost long, audit string, illegal long")
    hurt = damaged(rows).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    said = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), "audit", F.lit(None).cast("string").alias("text"))
    texts = hurt.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), F.lit(None).cast("string").alias("audit"), "text")
    stream = said.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    hashes = stream.select("conv_id", "audit", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    every = rows.select("conv_id").distinct()
    of = {"counts": counts, "audits": audits, "hashes": hashes}
    out = every
    for name, table in of.items():
        table = table.withColumnRenamed("conv_id", f"{name}_id")
        out = out.join(table, F.col("conv_id").eqNullSafe(F.col(f"{name}_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
