"""The corpus pipeline: each stage on its own input, against brute force, and its last columns."""

import re

import corpus_pipeline
from barlight.llm import language

SF = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near copies", "repeated passages", "benchmark", "mixture"]
    before = {r.doc_id: r for r in docs.collect()}

    told = corpus_pipeline.known_language(spark, docs, SF).cache()
    assert told.columns == docs.columns
    after = {r.doc_id: r for r in told.collect()}
    assert set(after) == {i for i, r in before.items() if r.text and any(map(str.isalpha, r.text))}
    pred = {r.doc_id: r.lang_pred for r in language.identify(docs, language.train(docs.where(language.fold_remainder(docs["doc_id"]) != 0))).collect()}
    assert all(r.lang == pred[i] and r.text == before[i].text for i, r in after.items())

    ones = corpus_pipeline.one_of_each_group(spark, told, SF).cache()
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    sets = {}
    for i, r in after.items():
        w = SPLIT.findall(low(r.text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in ones.collect()} == {i for i in ids if find(i) == i}

    cut = corpus_pipeline.without_repeats(spark, ones, SF).cache()
    texts = {r.doc_id: r.text for r in ones.collect()}
    words = {i: SPLIT.findall(t) for i, t in texts.items()}
    seen = {}
    for i, w in words.items():
        for k in range(len(w) - 34):
            seen.setdefault(tuple(w[k : k + 35]), []).append((i, k))
    gone = {i: [False] * len(w) for i, w in words.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i][k : k + 35] = [True] * 35
    want = {i: " ".join(x for x, g in zip(words[i], gone[i]) if not g) if any(gone[i]) else t for i, t in texts.items()}
    assert {r.doc_id: r.text for r in cut.collect()} == want and any(map(any, gone.values()))

    clean = corpus_pipeline.without_benchmark(spark, cut, SF).cache()
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(r.text or "")) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in clean.collect()}
    for i, text in want.items():  # what holds an item whole goes; what shares no five words of one stays
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        shared = max((len(grams & {tuple(x[k : k + 5]) for k in range(len(x) - 4)}) / max(1, len(x) - 4) for x in items if len(x) >= 5), default=0)
        assert (i in left) if shared == 0 else shared < 1 or (i not in left)

    mixed = corpus_pipeline.mixed(spark, clean, SF).collect()
    assert {r.doc_id for r in mixed} == left and all(0 <= r.taken <= 2 * r.size for r in mixed)


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
