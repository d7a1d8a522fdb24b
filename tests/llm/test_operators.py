"""The numbered operators against brute force, with nulls, empty and repeated rows and clashing columns."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlight.llm import html, jaccard, kdtree, language, licenses, mixing, passages, recurrent, scoring, suffixes
from barlight.llm.contamination import contamination, tile

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(seed=1, n=120):
    """Invented texts with copies, near copies, shared passages, nulls, empty and one-word texts."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["Über", "ñu", "Ça"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, line = text(60), text(90)
    rows = [(0, None), (1, ""), (2, "one"), (3, "one"), (4, " \t\n"), (None, "null id here"), (None, None)]
    base = [text(rng.randrange(1, 300)) for _ in range(20)]
    for i in range(10, n):
        t = rng.choice(base).split()
        for _ in range(rng.randrange(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            t[len(t) // 2 : len(t) // 2] = passage.split()
        if rng.random() < 0.2:
            t += line.split() * 2
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(t)))
    return rows + rows[-2:]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if (i or 0) % 11 == 0 else f"s{(i or 0) % 3}", len(t or "")) for i, t in corpus()]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def same(rows, want):
    assert collections.Counter(rows) == collections.Counter(want)


def test_jaccard_components(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = []
    for _, t in rows:
        w = words(low(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    want = [(rows[k][0], len(sets[k]), min((i for i in groups[find(k)] if i is not None), default=None)) for k in range(len(rows))]
    found = jaccard.jaccard_components(docs.withColumn("set_id", F.lit(1)))
    same([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], want)
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0
    texts = docs.select("text")
    rows = lambda df: sorted((r.signature, r.n, *sorted((r.set_id, r.mate or 0)) * (r.n == 2 and r.mate is not None)) for r in df.collect())
    assert rows(jaccard.shared_signatures(texts, jaccard.Scheme())) == rows(jaccard.shared_signatures(texts, jaccard.Scheme(), most=2))


def test_one_document_of_each_group(docs):
    kept_rows = jaccard.first_of_each_group(docs)
    assert kept_rows.columns == docs.columns
    n = jaccard.jaccard_components(docs)
    wordless = n.where("n_shingles = 0").count()
    assert kept_rows.count() == n.where("n_shingles > 0").select("group_id").distinct().count() + wordless


def test_signatures_meet_for_every_pair_that_links():
    """Sets right at the threshold, of all sizes, share a signature."""
    rng = np.random.default_rng(3)
    scheme = jaccard.Scheme()
    for size in (1, 2, 4, 5, 6, 9, 12, 20, 33, 50, 80, 130, 300, 900):
        for _ in range(15):
            a = np.unique(rng.integers(0, 1 << 52, size, dtype=np.uint64))
            drop = rng.integers(0, size // 5 + 1)
            add = (len(a) - drop) * 10 // 8 - len(a)
            b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - drop], rng.integers(0, 1 << 52, max(add, 0), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            sig, owner = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), scheme)
            assert set(sig[owner == 0]) & set(sig[owner == 1])


def removed(rows, length):
    """Brute force: which items of each sequence are covered by a run of `length` that begins elsewhere, too."""
    count = collections.Counter(tuple(s[k : k + length]) if not isinstance(s, bytes) else s[k : k + length] for s in rows for k in range(len(s) - length + 1))
    out = []
    for s in rows:
        gone = bytearray(len(s))
        for k in range(len(s) - length + 1):
            if count[tuple(s[k : k + length]) if not isinstance(s, bytes) else s[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        out.append(gone)
    return out


def test_passages(docs):
    rows = docs.collect()
    split = [words(r.text) for r in rows]
    gone = removed(split, 35)
    want = [(r.doc_id, len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for r, w, g in zip(rows, split, gone)]
    out = passages.remove_passages(docs.withColumn("text_key", F.lit(1)).withColumn("places", F.lit("x")).withColumn("spans", F.lit(2)))
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect()], want)
    assert passages.remove_passages(docs.limit(0)).count() == 0


def test_groups_that_are_too_large_get_longer_prefixes(docs):
    """With every group too large the spans are the same, and the groups of longer paths are smaller."""
    from barlight.llm.anchors import keyed

    texts = keyed(docs.where("doc_id < 45").coalesce(2))
    whole = {r.text_key: r.spans for r in passages.repeated_windows(texts, 35).collect()}
    assert whole and whole == {r.text_key: r.spans for r in passages.repeated_windows(texts, 35, most_bytes=3).collect()}
    whole = {r.text_key: r.spans for r in suffixes.repeated_runs(texts, 100).collect()}
    assert whole and whole == {r.text_key: r.spans for r in suffixes.repeated_runs(texts, 100, most_bytes=3).collect()}


def pieces_of(unit, length, rng, n, windows=10):
    """Pieces of one anchor whose units before and behind it differ."""
    from barlight.llm.pieces import HEAD, Pieces

    head, bodies = np.zeros(n, HEAD), []
    head["anchor"], head["path"], head["windows"], head["offset"] = 7, 99, windows, windows - 1
    head["key"] = np.arange(n)
    for _ in range(n):
        body = np.full((windows + length - 1, unit), 5, np.uint8)
        body[: windows - 1] = rng.integers(0, 2, (windows - 1, unit))
        body[-(windows - 1) :] = rng.integers(0, 2, (windows - 1, unit))
        bodies.append(body.reshape(-1))
    return Pieces(head, np.concatenate(bodies), length, unit)


def test_longer_paths_split_the_group_of_one_anchor():
    pieces = pieces_of(passages.WORD_BYTES, 35, np.random.default_rng(1), 200)
    largest = [int(pieces.head["windows"].sum())]
    for level in (1, 2):
        one = passages.longer_prefixes(35)(pieces, level)
        largest.append(int(np.unique(one.head["path"], return_counts=True)[1].max()))
        for path in np.unique(one.head["path"])[:40]:  # a path is a prefix of the suffixes dealt by it
            mine = np.flatnonzero(one.head["path"] == path)
            depth = int(one.head["offset"][mine[0]]) + passages.gram_words(35) if level == 1 else 35
            assert len({one.take(np.array([k])).body[: depth * passages.WORD_BYTES].tobytes() for k in mine}) == 1
    assert largest[0] > largest[1] >= largest[2]
    strings = pieces_of(1, 400, np.random.default_rng(2), 200, 100)
    assert len(np.unique(suffixes.longer_paths(strings, 1).head["path"])) > 1


def test_suffix_tree_against_brute_force():
    """Order, common prefixes, nodes and maximal repeats of small sequences."""
    rng = random.Random(8)
    for _ in range(60):
        sequences = [[rng.randrange(2) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 5))]
        size = np.array([len(s) for s in sequences])
        at = np.cumsum(size) - size
        flat = np.concatenate(sequences)
        suffix = {int(a + i): s[i:] for a, s in zip(at, sequences) for i in range(len(s))}
        order, common = passages.sorted_suffixes(flat, at, size, np.array(sorted(suffix)))
        assert [suffix[i] for i in order] == sorted(suffix.values())

        def shared(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        assert common.tolist() == [0] + [shared(suffix[a], suffix[b]) for a, b in zip(order, order[1:])]
        got = {(int(d), frozenset(order[a : b + 1].tolist())) for d, a, b in zip(*passages.internal_nodes(common, 2))}
        want = set()
        for a in suffix:
            for b in suffix:
                d = shared(suffix[a], suffix[b])
                if a != b and d >= 2:
                    want.add((d, frozenset(x for x in suffix if suffix[x][:d] == suffix[a][:d] and len(suffix[x]) >= d)))
        assert got == want


def test_without_the_suffix_array_nothing_is_found(docs, monkeypatch):
    """Strings are found by the array alone: with none in its order a task finds nothing."""
    from barlight.llm.pieces import HEAD, Pieces

    body = np.frombuffer(bytes(range(65, 91)) * 16, np.uint8)[:400]
    head = np.zeros(3, HEAD)
    head["anchor"], head["windows"], head["offset"], head["key"] = 3, 1, 100, [1, 2, 3]
    pieces = Pieces(head, np.tile(body, 3), 400, 1)
    assert len(suffixes.repeated_strings(pieces)[0]) == 3
    monkeypatch.setattr(suffixes, "suffix_array", lambda symbols: [])
    assert len(suffixes.repeated_strings(pieces)[0]) == 0


def test_strings(docs):
    rows = docs.collect()
    data = [(r.text or "").encode() for r in rows]
    gone = removed(data, 100)
    want = []
    for r, b, g in zip(rows, data, gone):
        spans = sum(1 for k in range(len(g)) if g[k] and (k == 0 or not g[k - 1]))
        want.append((r.doc_id, len(b), sum(g), spans, bytes(x for x, y in zip(b, g) if not y)))
    out = suffixes.remove_strings(docs.withColumn("runs", F.lit(1)).withColumn("spans", F.lit(2)), 100)
    same([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in out.collect()], want)
    assert suffixes.remove_strings(docs.limit(0)).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(500):
        a = [rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(40))]
        assert suffixes.suffix_array(a) == sorted(range(len(a)), key=lambda i: a[i:])


def test_language(spark):
    rng = random.Random(5)
    sound = {"aa": ["bado", "kimi", "luda", "mona"], "bb": ["xeft", "grosz", "przyk", "wrzo"], "cc": ["ñandu", "çela", "órto", "éline"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(sound))
        rows.append((i, " ".join(rng.choice(sound[lang]) for _ in range(rng.randrange(3, 40))).upper() if i % 7 == 0 else " ".join(rng.choice(sound[lang]) for _ in range(rng.randrange(3, 40))), lang))
    rows += [(900, None, "aa"), (901, "", None), (902, "123 !!", "bb"), (None, "bado kimi", None), (903, "bado kimi " * 30 + "xeft grosz " * 10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    held = language.fold_remainder(F.col("doc_id")) == 0
    out = {r.doc_id: r for r in language.identify(docs, language.train(docs.where(~held))).collect()}
    test = [r for r in rows if r[0] is not None and r[0] < 300 and zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert test and all(out[i].lang_pred == lang for i, _, lang in test)
    assert [out[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and out[902].score == 0
    assert out[903].lang_pred == "aa" and 0.6 < out[903].score < 0.9  # a mixture
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def test_contamination(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    moved = "noise " * 9 + " ".join(item.upper().split()[10:]) + ", filler filler " + " ".join(item.split()[:10])
    rows = [(1, item), (2, moved), (3, "nothing of the kind " * 20), (4, None), (5, ""), (6, " ".join(item.split()[:6])), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("coverage", F.lit("clash"))
    items = spark.createDataFrame([(7, item), (8, "tiny one"), (9, None), (10, "")], "item_id long, text string")
    out = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert [out[i].contaminated for i in (1, 2, 3, 4, 5, 6, None)] == [True, True, False, False, False, False, True]
    assert out[2].coverage == 1.0 and out[2].item_id == 7 and out[6].coverage == pytest.approx(6 / 20)
    assert contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_contamination_in_blocks(spark, monkeypatch):
    """A benchmark that goes through in several blocks gives what it gives at once; ties go to the smallest item."""
    from barlight.llm import contamination as module

    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghij") * 2 + str(rng.randrange(30)) for _ in range(n))
    items = [(i, text(rng.randrange(5, 30))) for i in range(30)]
    items += [(40 + i, items[i][1]) for i in range(5)]
    docs = [(i, text(40) + " " + rng.choice(items)[1] + " " + text(10)) for i in range(40)]
    args = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, contamination(*args).collect()))
    assert sum(r[5] if isinstance(r[5], bool) else r[-1] for r in whole) == 40 and all(r[2] < 40 for r in whole)
    monkeypatch.setattr(module, "BLOCK_WORDS", 200)
    assert whole == sorted(map(tuple, contamination(*args).collect()))


def test_tiling_against_brute_force():
    rng = random.Random(4)

    def slow(a, b, least):
        fa, fb, total = [1] * len(a), [1] * len(b), 0
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and fa[i + k] and fb[j + k]:
                        k += 1
                    best = max(best, (k, -i, -j))
            if best[0] < least:
                return total
            k, i, j = best[0], -best[1], -best[2]
            fa[i : i + k], fb[j : j + k] = [0] * k, [0] * k
            total += k

    for _ in range(150):
        a = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
        b = [rng.randrange(3) for _ in range(rng.randrange(1, 20))]
        got = tile(np.array(a, np.uint64) + np.uint64(1), np.array(b, np.uint64) + np.uint64(1), 3)
        assert abs(got - slow(a, b, 3)) <= 3  # ties of equal length may be laid differently


def test_mixing(docs):
    out = [r.asDict() for r in mixing.mix_sources(docs.withColumn("size", F.lit(1))).collect()]
    assert len(out) == docs.count()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 2 * sizes[s] for s in over}
        open_ -= over
    taken = collections.Counter()
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in order:
        assert taken[s] == pytest.approx(target[s], rel=0.03, abs=60)
    again = mixing.mix_sources(docs.repartition(3)).collect()
    same([(r.doc_id, r.taken) for r in again], [(r["doc_id"], r["taken"]) for r in out])
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_top_k(spark):
    rng = random.Random(6)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    hot = vec()
    rows = [(i, hot if i % 3 == 0 else vec()) for i in range(700)] + [(1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1050, [float("inf")] * 6), (None, vec())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    good = {r.vec_id: [int(np.floor(256 * float(x))) for x in r.embedding] for r in df.collect() if r.vec_id is not None and r.vec_id < 1000}
    want = []
    for q in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    old = kdtree.SHARD, kdtree.LEAF
    kdtree.SHARD, kdtree.LEAF = 150, 8
    try:
        same([tuple(r) for r in kdtree.top_k(df).collect()], want)
    finally:
        kdtree.SHARD, kdtree.LEAF = old
    assert kdtree.top_k(df.limit(0)).count() == 0


def test_shards_have_boxes_of_their_own(spark):
    """On clustered vectors less than half of the points are scored, and the result is that of brute force."""
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(16, 5)) * 20
    data = np.round((middle[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 5))) * 256) / 256
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, embedding array<double>")
    whole = np.floor(data * 256)
    old = kdtree.SHARD, kdtree.LEAF, kdtree.TOGETHER
    kdtree.SHARD, kdtree.LEAF, kdtree.TOGETHER = 200, 16, 7
    try:
        got = collections.defaultdict(list)
        for r in kdtree.top_k(df).collect():
            got[r.query_id].append((r["rank"], r.vec_id, r.score))
        scored = kdtree._found(df, 50, 5).agg(F.sum("scored")).first()[0]
    finally:
        kdtree.SHARD, kdtree.LEAF, kdtree.TOGETHER = old
    assert scored < 0.5 * 60 * 3000
    for q in range(0, 3000, 50):
        order = sorted((-float(whole[q] @ whole[i]), i) for i in range(3000) if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, int(-s)) for n, (s, i) in enumerate(order)]


def test_licenses(spark):
    rows = [(1, "Hello.\nReleased under the MIT License."), (2, "the general public license, general-public LICENSE"), (3, None), (4, ""), (5, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that following conditions are met."), (6, "transmit license")]
    out = {r.doc_id: r for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(0))).collect()}
    assert (out[1].n_words, out[1].n_base, out[1].first_word, out[1].base_labels, out[1].labels, out[1].score) == (6, 1, 4, "mit", "mit", 1.0)
    assert (out[2].n_base, out[2].first_word, out[2].last_word) == (2, 1, 4)
    assert (out[3].n_words, out[3].labels, out[3].first_word, out[3].score) == (0, "", None, 0.0)
    assert out[5].base_labels == "" and out[5].labels == "bsd" and out[5].score < 1
    assert out[6].n_base == 0


def test_license_spans(spark):
    mit = "/* Permission is hereby granted, free of\n * charge, to any person obtaining\n * a copy of this software and associated\n * documentation files */"
    lgpl = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public License"
    scattered = " ".join(f"{w} " + "filler " * 40 for w in licenses.TEMPLATES[1][1].split())
    rows = [(1, "Text.\nLicensed under CC BY-NC 4.0."), (2, "x\n" + mit), (3, scattered), (4, "Licensed under CC BY 4.0"), (5, "Licensed under CC BY-NC-SA\n4.0"), (6, "Released under the Apache License"), (7, lgpl), (8, "Licensed under the MIT License or the Apache License, Version 2.0"), (9, "no\n" + mit + "\n" + "filler " * 40 + "\n" + mit)]
    out = {r.doc_id: r for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert [(out[1].labels, out[1].score), (out[2].labels, out[2].score)] == [("cc-by-nc", 1.0), ("mit", 1.0)]
    assert [(m.line, m.label) for m in out[1].matches + out[2].matches + out[9].matches] == [(1, "cc-by-nc"), (1, "mit"), (1, "mit"), (6, "mit")]
    assert out[3].labels == "" and out[3].score < 0.5
    assert (out[4].labels, out[5].labels, out[6].labels, out[8].labels) == ("cc-by", "cc-by-nc-sa", "apache", "apache,mit")
    assert [m.label for m in out[7].matches] == ["lgpl"]


def test_license_without_its_name(spark):
    texts = ["This work is licensed under the General Public License, version 3", "Released under the BSD License"]
    gpl, bsd = (licenses.find_licenses(spark.createDataFrame([(t,)], "text string")).first() for t in texts)
    assert (gpl.labels, gpl.score) == ("gpl", pytest.approx(11 / 12)) and [m.label for m in gpl.matches] == ["gpl"]
    assert (bsd.labels, bsd.score, bsd.matches) == ("", 0.8, []) and [(b.label, b.containment) for b in bsd.blocks] == [("mit", 0.8)]


@pytest.mark.parametrize("seed", range(4))
def test_license_join_against_brute_force(spark, seed):
    """Every window of every text, against random templates whose words are frequent and rare alike."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(30)]
    templates = tuple((f"t{n}", " ".join(rng.choice(vocabulary[: rng.choice([8, 30])]) for _ in range(rng.randrange(1, 14)))) for n in range(9)) + (("none", "..."),)
    rows = [(None,), ("",)]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(vocabulary + ["other"] * 40) for _ in range(rng.randrange(30))]
            parts += [w for w in rng.choice(templates)[1].split() if rng.random() < 0.85]
        rows.append((" ".join(parts),))
    out = licenses.find_licenses(spark.createDataFrame(rows, "text string").repartition(3), templates).collect()
    assert len(out) == len(rows)
    for row in out:
        said, best, want = re.findall(r"v\d+|other", row.text or ""), 0.0, set()
        for label, template in templates[:-1]:
            had, width = set(template.split()), licenses.SPAN * len(template.split())
            most = max((len(had & set(said[i : i + width])) for i in range(len(said))), default=0) / len(had)
            best = max(best, most)
            want |= {(label, most)} if most >= 0.8 else set()
        assert row.score == pytest.approx(best if best >= 0.5 else 0.0)
        got = {}
        for b in row.blocks:
            got[b.label] = max(got.get(b.label, 0), b.containment)
        assert got == dict(want)


def test_license_filters_drop_pairs(monkeypatch):
    """The positional filter alone drops a pair whose shared word is the last but one of the block's."""
    tokens = np.arange(1, 9, dtype=np.uint64)
    ranks = lambda text: [np.array([int(x) for x in text.split()], np.uint64)][0]
    monkeypatch.setattr(licenses, "_hashes", lambda text: ranks(text) if text != licenses.NAMES else tokens[:0])
    table = licenses.Templates.of(["3 4 7 8"], tokens, {int(t): int(t) for t in tokens}, 0.75)
    assert table.need.tolist() == [3] and table.index(np.array([0]))[2].tolist() == [0, 1]
    run = lambda *r: licenses.block_candidates(table, 8, table.index(np.array([0])), np.zeros(len(r), int), np.arange(len(r)), np.array(r) - 1)
    assert [x.tolist() for x in run(1, 3, 4, 8)] == [[0], [0], [0]]
    assert [x.tolist() for x in run(1, 2, 4, 8)] == [[], [], []]
    counted = []
    monkeypatch.setattr(licenses.np, "bincount", lambda x, w, n: counted.append(n) or np.zeros(n))
    run(1, 2, 4, 8), run(3, 4), run(3, 4, 5, 8)
    assert counted == [0, 0, 1]


def test_routing_over_many_boxes():
    """Both rounds together reach each box that the floor allows once, and hold no more than a few arrays of bounded size."""
    rng = np.random.default_rng(5)
    n, d = 20_000, 16
    centre = np.floor(rng.normal(size=(n, d)) * 100)
    lo, hi, number = centre - rng.integers(0, 9, (n, d)), centre + rng.integers(0, 9, (n, d)), rng.permutation(n).astype(np.int32)
    q, own, floor = np.floor(rng.normal(size=(100, d)) * 100), rng.integers(0, n, 100).astype(np.int32), np.where(np.arange(100) % 3, 90_000.0, -np.inf)
    bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    want = {(r, int(s)) for r in range(100) for s in number[bound[r] >= floor[r]] if s != own[r]}
    tracemalloc.start()
    near = list(zip(*(x.tolist() for x in kdtree.routed(q, own, floor, number, lo, hi, 0, 4)), strict=True))
    far = list(zip(*(x.tolist() for x in kdtree.routed(q, own, floor, number, lo, hi, 4, None)), strict=True))
    assert tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()
    assert len(near) + len(far) == len(set(near) | set(far)) and set(near) | set(far) == want
    for r in (0, 1, 50):
        best = np.sort(np.where(number == own[r], -np.inf, bound[r]))[-4:]
        assert sorted(bound[r][np.flatnonzero(number == s)[0]] for x, s in near if x == r) == [b for b in best if b >= floor[r]]


def test_one_vector_in_half_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD", 100)
    rng = np.random.default_rng(6)
    rows = [(k, (np.ones(6) * 0.5 if k % 2 else rng.normal(size=6)).tolist()) for k in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    v = {k: np.floor(256 * np.array(e)) for k, e in rows}
    want = []
    for a in range(0, 1000, 50):
        best = sorted(((-int(v[a] @ v[b]), b) for b in v if b != a))[:5]
        want += [(a, r + 1, b, -s) for r, (s, b) in enumerate(best)]
    same([tuple(r) for r in kdtree.top_k(df).collect()], want)
    monkeypatch.setattr(kdtree, "CELLS", 7)
    monkeypatch.setattr(kdtree, "SENT", 3)
    same([tuple(r) for r in kdtree.top_k(df).collect()], want)


def test_html(spark):
    page = lambda k, body: (k, f"https://h.example.com/{k}", f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li>Menu</ul></nav><div class='ad'>Buy {k}</div>{body}<footer>Foot {k}</footer></body></html>")
    rows = [page(k, f"<article><h1>Head {k}</h1><p>One  <b>bold</b>&amp;\n two{k}<p>Three{k}<br>four<div class=x>Same on all pages</div><section id=comments>No</section></article>") for k in range(12)]
    rows += [(50, None, None), (51, "http://other.example/", ""), (52, "http://other.example/a", "<p>plain &lt;b&gt; text"), (53, "http://other.example/b", "<div><p>broken <i>markup")]
    out = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    assert out[3].text == "Head 3 One bold& two3 Three3 four Same on all pages" and out[3].n_chars == len(out[3].text)
    assert (out[50].text, out[51].text, out[52].text, out[53].text) == ("", "", "plain <b> text", "broken markup")


def test_html_sites(spark):
    """What a tenth of a large host or all of a small one repeats goes; an article is taken only as the most of a page."""
    body = lambda k: f"<div><p>Main text {k} of this page</div>"
    rows = [(k, f"http://large/{k}", body(k) + ("<div><h4>About the author</h4><ul><li>Site<li>Mail</ul></div>" if k < 12 else "")) for k in range(120)]
    rows += [(200 + k, f"http://small/{k}", body(200 + k) + "<div>Our site</div>") for k in range(4)]
    rows += [(300, "http://a/", "<article>Teaser</article><div>The long main text of the page</div>"), (301, "http://b/", "<div>Short</div><article>The text</article>")]
    rows += [(302, "http://c/", "<div>The text itself</div><article class='comment'>A reader's comment which is longer than all else here</article>")]
    rows += [(400 + k, f"http://copies/{k}", "<div>The same page</div>") for k in range(12)]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(out) == len(rows)
    assert {out[k] for k in (0, 11, 119, 200, 203)} == {f"Main text {k} of this page" for k in (0, 11, 119, 200, 203)}
    assert (out[300], out[301], out[302]) == ("Teaser The long main text of the page", "The text", "The text itself")
    assert out[400] == out[411] == "The same page"


def test_html_keeps_article_text_that_repeats(spark):
    """A sentence in a tenth or all of a host's articles stays, a copied article under other menus too; the menu goes."""
    rng = random.Random(12)
    sentence = "The same sentence in many an article."
    rows, want = [], {}
    for k in range(100):
        own = [f"Own text {k} {rng.random()} " + "that is long enough to be a paragraph of prose and no menu at all" for _ in range(3)]
        blocks = own[:1] + ([sentence] if k % 10 == 0 else []) + own[1:] + (["On every page of the host."] if k % 2 else [])
        blocks = ["Article that is copied with other menus. " * 3, "Its second paragraph, as long as the first one is. " * 2] if k >= 85 else blocks
        inner = "".join(rng.choice(["<p>{}</p>", "<div>{}</div>", "<p><b>{}</b></p>"]).format(b) for b in blocks)
        menu = "<div class=q><ul><li>Start<li>News<li>About us</ul></div>" + (f"<div><ul><li>Seen {k}<li>Next</ul></div>" if k >= 85 else "")
        rows.append((k, "http://h/%d" % k, f"<body>{menu}" + (f"<article>{inner}</article>" if k % 3 else f"<div class=text>{inner}</div>") + "</body>"))
        seen = [f"Seen {k}", "Next"] if k >= 85 and not k % 3 else []
        want[k] = " ".join(" ".join(b.split()) for b in [*seen, *blocks])
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == want


def test_html_many_quotes():
    text = lambda page: html.Page(page).text(frozenset())
    many = " ".join(f'd{k}="a>b"' for k in range(3000))
    assert text(f"<p {many}>in</p>") == "in" and text(f"<p {many} x='>in</p>") == "in" and text('<p t="a>b" u=\'c>in</p><p>it is</p>') == "in it is"


def test_html_template_step_against_brute_force(spark):
    """Sub-trees that no list names go by their counts, which are those of a plain recount; nothing else can remove them."""
    menu = "<div class='x1'><ul><li>Start<li>News</ul></div>"
    rows = [(k, f"http://s/{k}", f"<body>{menu}<section><p>Own text {k}</p>" + ("<p>Some rights</p>" if k % 2 else "") + f"</section><div>Tail {k % 2}</div></body>") for k in range(8)] + [(99, "http://s/99", f"<body>{menu}<section><p>Own text 0</p></section><div>Tail 0</div></body>")]
    rows += [(100, "http://t/1", f"<body>{menu}<p>Alone</body>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    hosted = df.select(html.host(F.col("url")).alias("host"), F.xxhash64("html").alias("page_key"), "html")
    sites, _ = html.site_trees(hosted, 0.5, 10, 3)
    want = collections.Counter()
    for _, url, page in {(html.Page(h).hash[0], u.split("/")[2], h): 0 for _, u, h in rows if u != "http://s/99"}:
        want.update((url, t) for t in html.Page(page).trees())
    assert {(r.host, r.tree): r.n for r in sites.collect()} == {k: n for k, n in want.items() if n >= 4}
    out = {r.page_id: r.text for r in html.extract(df).collect()}
    assert out[0] == "Own text 0" and out[1] == "Own text 1" and out[100] == "Start News Alone"


def test_html_names_and_malformed_pages():
    import time

    text = lambda page: html.Page(page).text(frozenset())
    assert text("<article><div class='article-header'><h1>Head</h1></div><p class='notice-board'>Board</p><p class='cookie-banner'>C</p><div id=site-footer>F</div></article>") == "Head Board"
    assert text("a <b <p>b</p>") in ("a b", "a") and text('<p title="x > y">in</p>') == "in" and text("<p title='x>in</p>") == "in" and text("1 < 2 <3") == "1 < 2 <3"
    began = time.time()
    for page in ('<a "' * 250_000, "<a \"'>" * 150_000, "<div>" * 100_000 + "deep", "<div></b>" * 100_000, "<!--" * 200_000, "<p>x" * 100_000, "<" * 1_000_000):
        html.Page(page)
    assert time.time() - began < 12
    page = html.Page("<div>" * 2000 + "in")
    assert len(page.trees()) <= html.DEEPEST and page.text(frozenset()) == "in"


def test_model_gradients():
    """Backpropagation agrees with differences, and learning lowers the loss."""
    rng = np.random.default_rng(0)
    counts = np.array([50, 30, 20, 9, 5, 3, 2, 1])
    model = recurrent.Model.start(counts, 4, 5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.p["w"] += rng.standard_normal(model.p["w"].shape) * 0.3
    ids, first = rng.integers(0, 9, 24), np.array([0, 7, 7, 24])
    grads = {}
    trainer = recurrent.Trainer(model)
    trainer._update = lambda g, n: [grads.__setitem__(k, grads.get(k, 0) + v) for k, v in g.items()]
    trainer.learn(ids, first, 2)
    for name in model.NAMES:
        flat = model.p[name].reshape(-1)
        for k in rng.integers(0, flat.size, 4):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = -recurrent.score(model, ids, first).sum()
            flat[k] = old - step
            down = -recurrent.score(model, ids, first).sum()
            flat[k] = old
            assert np.asarray(grads[name]).reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=2e-4)


def test_probabilities_add_up():
    model = recurrent.Model.start(np.array([9, 5, 3, 2, 1]), 2, 4)
    total = sum(np.exp(recurrent.score(model, np.array([1, 0, k]), np.array([0, 3]))[2]) for k in range(6))
    assert total == pytest.approx(1, abs=1e-4)


def test_groups_in_classes():
    """Words' probabilities are those of class, group and word, exponentials beyond their type included, at few logits a token."""
    model = recurrent.Model.start(np.floor(300_000 / np.arange(1, 30_001)), 4000, 4)
    cl, n = model.classes, 30_000
    rng = np.random.default_rng(0)
    used = np.minimum(n - cl.alone - recurrent.GROUP * np.arange(cl.leaves), recurrent.GROUP)
    for name in ("c", "w"):
        model.p[name][:, -1] += rng.standard_normal(len(model.p[name]))
    log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    for far in (0, 120):  # of the classes' logits
        model.p["c"][:, -1] += np.linspace(0, far, len(model.p["c"]))
        c, w = (model.p[k][:, -1].astype(float) for k in ("c", "w"))
        inside = model.p["l"].reshape(cl.leaves, recurrent.GROUP, -1)[:, :, -1].astype(float)
        groups = np.concatenate([log_softmax(w[a:b]) for a, b in zip(cl.start[:-1], cl.start[1:], strict=True)]) + log_softmax(c)[cl.of]
        want = np.concatenate([groups[: cl.alone], *(groups[cl.alone + k] + log_softmax(x[: used[k]]) for k, x in enumerate(inside)), groups[-1:]])
        got = recurrent.score(model, np.arange(n + 1), np.arange(n + 2))  # each word as a text of its own, whose state is 0
        np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-3)
        assert np.exp(got).sum() == pytest.approx(1, abs=1e-3)
    share = np.floor(300_000 / np.arange(1, 30_001)) / np.floor(300_000 / np.arange(1, 30_001)).sum()
    assert len(model.p["c"]) + (share * np.diff(cl.start)[cl.of[cl.group(np.arange(n))]]).sum() + recurrent.GROUP < 140


def test_lookup_of_any_tokens():
    """Numbers of words follow from equality alone, evenly spread hashes or not, the least and the largest too."""
    rng = np.random.default_rng(3)
    edge = np.array([0, 1, 2, 2**64 - 2, 2**64 - 1], np.uint64)
    for tokens in (np.unique(np.r_[edge, rng.integers(0, 2**64, 3000, np.uint64)]), np.arange(300, dtype=np.uint64), edge[-1:], edge[:0]):
        rng.shuffle(tokens)
        look, at = scoring.Lookup(tokens, 3), {int(t): k for k, t in enumerate(tokens)}
        asked = np.r_[tokens, edge, rng.integers(0, 2**64, 500, np.uint64)]
        for token, got in zip(asked.tolist(), look(asked).tolist(), strict=True):
            assert got == at[token] if token in at else len(tokens) <= got < len(tokens) + 3


def test_scoring(spark, docs):
    old = scoring.TABLE_WORDS, scoring.MODEL_WORDS
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 != 1]
    c = collections.Counter(t for r in train for t in [*words(low(r.text)), None])
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        toks = [*words(low(r.text)), None]
        want.append((r.doc_id, len(toks), sum(c[t] > 0 for t in toks), n, round(sum(np.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in toks), 4)))
    results = []
    for table, model in (old, (40, 20)):  # the second joins the counts of rare words
        scoring.TABLE_WORDS, scoring.MODEL_WORDS = table, model
        try:
            got = scoring.score_documents(docs, rounds=1).collect()
        finally:
            scoring.TABLE_WORDS, scoring.MODEL_WORDS = old
        same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got], want)
        results.append(sum(r.score for r in got))
    assert all(np.isfinite(results))
    assert scoring.score_documents(docs.limit(0), rounds=1).count() == 0


def test_shards_follow_from_the_corpus():
    """Weights written stay below the share; more tokens never mean fewer shards."""
    weights = 1_200_000
    counts = [scoring.shard_count(n, weights, 6) for n in (0, 1, 10**6, 2 * 10**7, 10**8, 10**10)]
    assert counts == [1, 1, 1, 3, 8, 156] and counts == sorted(counts)
    for n in (2 * 10**7, 10**8, 10**10):
        assert scoring.shard_count(n, weights, 6) * weights * 2 * 6 <= scoring.WEIGHTS_SHARE * 4 * n


def test_vocabulary_grows(spark):
    """More words are told apart in a larger corpus, and rare words are learned by their buckets."""
    assert scoring.model_words(400_000, 1 << 17) > 4 * scoring.MODEL_WORDS and scoring.model_words(900, 700) == 700
    counts = spark.createDataFrame([(k, k + 1) for k in range(50)], "token long, n long").repartition(3)
    vocabulary = np.arange(40, 50).astype(np.uint64)
    n, distinct = scoring.bucket_counts(counts, vocabulary, 4)
    of = scoring.Lookup(vocabulary, 4)(np.arange(50).astype(np.uint64))
    assert of[40:].tolist() == list(range(10)) and set(of[:40].tolist()) == {10, 11, 12, 13}
    assert distinct.tolist() == [int((of == 10 + b).sum()) for b in range(4)]
    assert n.tolist() == [sum(k + 1 for k in range(50) if of[k] == 10 + b) for b in range(4)]
