"""Conversation repair against plain searches over the grammar's states and over all edits."""

import collections
import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from barlight.llm import turns

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def least(seq):
    """(cost, audit) by states: the least of each after each turn."""
    best = {0: (0, "")}

    def inserted(table):
        out = dict(table)
        for _ in range(3):
            for q, (c, a) in list(out.items()):
                for letter, q2 in NEXT[q].items():
                    if letter != "s":
                        cand = (c + 2, a + "I")
                        if q2 not in out or cand < out[q2]:
                            out[q2] = cand
        return out

    for role, fault in seq:
        after = {}
        for q, (c, a) in inserted(best).items():
            options = [(q, c + 3, "D")]
            if fault not in ("b", "d"):
                more = fault == "t"
                for letter, q2 in NEXT[q].items():
                    if letter == role:
                        options.append((q2, c + more, "K"))
                    if letter != "s":
                        options.append((q2, c + 2 + more, "R"))
            for q2, cost, edit in options:
                if q2 not in after or (cost, a + edit) < after[q2]:
                    after[q2] = (cost, a + edit)
        best = after
    return min(v for q, v in inserted(best).items() if q in (0, 3))


def every_edit(seq):
    """(cost, audit) by trying all strings of edits of up to twice the turns and two."""
    found = []
    for n in range(2 * len(seq) + 3):
        for edits in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(seq):
                continue
            options, i = [(0, "")], 0
            for e in edits:
                out = []
                for c, roles in options:
                    if e == "I":
                        out += [(c + 2, roles + r) for r in "ua"]
                    elif e == "D":
                        out.append((c + 3, roles))
                    elif seq[i][1] not in ("b", "d"):
                        more = seq[i][1] == "t"
                        out += [(c + more, roles + (seq[i][0] or "?"))] if e == "K" else [(c + 2 + more, roles + r) for r in "ua"]
                options, i = out, i + (e != "I")
            costs = [c for c, roles in options if re.fullmatch("(s?(ua)+)?", roles)]
            if costs:
                found.append((min(costs), "".join(edits)))
    return min(found)


def by_blocks(seq, size):
    tables = [{s: turns.aligned(tuple(seq[k : k + size]), s) for s in range(4)} for k in range(0, len(seq), size)]
    return turns.joined(tables)


def test_all_edits():
    rng = random.Random(2)
    for _ in range(150):
        seq = [(rng.choice("suax"), rng.choice(["", "", "", "b", "d", "t"])) for _ in range(rng.randrange(1, 4))]
        want = every_edit(seq)
        assert least(seq) == want, seq
        assert by_blocks(seq, 9) == want, seq


def test_blocks_of_any_size():
    rng = random.Random(5)
    for k in range(600):
        n = rng.randrange(1, 40 if k % 10 else 120)
        seq = [(rng.choice(["s", "u", "a", "a", "u", "", "x"]), rng.choice(["", "", "", "b", "d", "t"])) for _ in range(n)]
        want = least(seq)
        for size in (1, 3, turns.BLOCK):
            assert by_blocks(seq, size) == want, (seq, size)


def brute(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, found in by.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, seq = set(), []
        for _, role, text in found:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not ink else "d" if (role, text) in seen else "" if ink[-1] in ".!?" else "t"
            seen.add((role, text))
            seq.append((role[:1], fault))
        known = [t for t, *_ in found if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = least(seq) if seq else (0, "")
        repaired, i, state = [], 0, 0
        for e in audit:
            want = "assistant" if state == 2 else "user"
            if e == "I":
                repaired.append(f"{want}:")
                state = 3 if state == 2 else 2
                continue
            _, role, text = found[i]
            i += 1
            if e != "D":
                role = want if e == "R" else role
                repaired.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
        count = collections.Counter(f for _, f in seq)
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(seq))
        out.append((conv, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return out


def conversations():
    rng = random.Random(8)
    say = lambda: rng.choice(["Yes.", "No!", "and then", "", " \n", "Ünd so?", "Done. \t", None, "x " * 30000]) if rng.random() < 0.5 else f"line {rng.random()}."
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system"] * (turn == 0) + ["user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3, -2]), role, say()))
    rows += rows[20:40]
    rows += [(777, t, "user" if t % 2 == 0 else "assistant", f"long {t % 90}." if t % 7 else "same.") for t in range(700)]
    rows += [(778, 5, "user", "again.")] * 200
    return rows + [(900 + k, 0, "user", "Hm.") for k in range(60)]


def test_brute_force(spark, monkeypatch):
    rows = conversations()
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"fault": F.lit(1), "audit": F.lit("x"), "n": F.lit(2)}).repartition(5)
    want = sorted(brute(rows), key=str)
    assert any(w[7] == "" for w in want)
    found = sorted((tuple(r) for r in turns.repair(docs).collect()), key=str)
    assert found == want
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = turns.turn_rows(docs).repartitionByRange(40, "conv_id", "turn", "role", "digest").where("conv_id = 777").select(F.spark_partition_id()).distinct().count()
        assert split > 3  # one conversation in many tasks
        assert sorted((tuple(r) for r in turns.repair(docs).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table(spark):
    assert turns.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
