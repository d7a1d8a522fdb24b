"""The filter audit against counting document by document."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from barlight.llm import audit


def fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text))]


def brute(rows, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        parts[s or ""].append((fails(t) + [i is not None and i > least[t]], i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = collections.Counter()
        mine = {}
        for order in itertools.permutations(range(5)):
            left = docs
            for step, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                failing = [d for d in docs if d[0][f]]
                shapley[f] += len(gone)
                name = "".join("ABCDE"[x] for x in order)
                mine[name, step + 1] = (f, [len(left), len(gone), len(failing) - len(gone), sum(sum(d[0]) == 1 for d in failing), sum(d[1] for d in gone), sum(d[2] for d in gone)])
        for (name, step), (f, counts) in mine.items():
            out[part, name, step] = (*counts, shapley[f])
    return out


def corpus():
    rng = random.Random(9)
    make = lambda n, v, extra="": " ".join(rng.choice(["%sw%d" % (rng.choice("Aabc"), k) for k in range(v)]) for _ in range(n)) + extra
    base = [make(rng.choice([10, 49, 50, 60, 200]), rng.choice([20, 60, 400]), rng.choice(["", "", " $5", " ABCDEFGHIJKLMNOP"])) for _ in range(25)] + ["", None, " \t", "x " * 20000]
    rows = [(i if i % 13 else None, rng.choice(base), rng.choice(["a", "b", "", None])) for i in range(150)]
    rows += [(500 + i, base[0], "hot") for i in range(100)] + rows[3:6] + [(3, base[0], "other"), (-5, base[1], "b")]
    labels = [(rng.randrange(160), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)] + [(None, 1, 1), (9999, 1, 0)]
    return rows, labels


@pytest.mark.parametrize("parts", [1, 7])
def test_brute_force(spark, parts):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"fails": F.lit("x"), "part": F.lit(1), "good": F.lit(2)}).repartition(parts)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("s"))
    found = audit.audit(docs, marks).collect()
    want = brute(rows, labels)
    assert len(found) == len(want) == 600 * len({s or "" for *_, s in rows})
    for r in found:
        assert tuple(r[3:]) == want[r.part, r.filter_order, r.step]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, marks).count() == 0
    one = audit.audit(spark.createDataFrame([(1, None, None)], none.schema), marks).where("filter_order = 'BACDE'").orderBy("step").collect()
    assert [(r.part, r.kept, r.removed) for r in one] == [("", 1, 0), ("", 0, 1), ("", 0, 0), ("", 0, 0), ("", 0, 0)]
