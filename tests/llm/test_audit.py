"""The filter audit against filters applied one document at a time, and its walk against a count of states."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from tickloom.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and first[t] < d,
        }
        out.append((lang or "", {f for f in bad if bad[f]}))
    return out


def brute(rows, labels):
    """Each order applied document by document."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    marked = [(part, bad, r[0] in good and r[0] is not None, r[0] in toxic and r[0] is not None) for r, (part, bad) in zip(rows, failing(rows), strict=True)]
    out, total = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {m[0] for m in marked}:
            left = [m for m in marked if m[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                fails = [m for m in every if f in m[1]]
                total[part, f] += len(gone)
                out[part, order, step] = [len(left), len(gone), len(fails) - len(gone), sum(m[1] == {f} for m in every), sum(m[2] for m in gone), sum(m[3] for m in gone)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_orders_against_brute_force(spark):
    rng = random.Random(5)
    words = ["plain", "Word", "ABC", "x#y", "né", "日本", "a", "b"] + [f"w{i}" for i in range(150)]
    texts = [rng.choice(" \n\t").join(rng.choices(words, k=rng.choice([0, 3, 99, 100, 140]))) for _ in range(40)] + [" ".join(f"w{i}" for i in range(120)), "A" * 5, "", "word " * 40_000, "#" * 9]
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts + texts[:20])]
    rows += [(None, texts[0], "en"), (None, None, "de"), (5, texts[5], "fr"), (5, texts[5], "fr"), (900, None, "en"), (901, "", None)]
    rng.shuffle(rows)
    labels = [(d, rng.randint(0, 1), rng.randint(0, 1)) for d, *_ in rows if d is not None and d % 3]
    labels = list({d: x for x in labels for d in [x[0]]}.values()) + [(None, 1, 1), (700, 1, 1), (901, None, 1)]
    docs = spark.createDataFrame([(*r, "y", 1) for r in rows], "doc_id long, text string, lang string, part string, kept int")
    assert got(audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))) == brute(rows, labels)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


@pytest.mark.parametrize("names", ["A", "AB", "ABC"])
def test_any_number_of_filters(spark, names):
    rows = spark.range(60).selectExpr("'p' AS part", "id % 2 = 0 AS good", "false AS toxic", "id", "nullif(id % 5, 4) AS five")
    made = {"A": "id % 2 = 0", "B": "id % 3 = 0", "C": "five = 0"}  # a null condition fails no row
    out = audit.audit_orders(rows, {f: made[f] for f in names})
    data = [({f for f in names if {"A": i % 2 == 0, "B": i % 3 == 0, "C": i % 5 == 0}[f]}, i % 2 == 0) for i in range(60)]
    for r in out.collect():
        before, f = r.filter_order[: r.step - 1], r.filter
        left = [d for d in data if not d[0] & set(before)]
        assert (r.removed, r.kept) == (sum(f in d[0] for d in left), sum(f not in d[0] for d in left))
        assert (r.good_lost, r.toxic_lost) == (sum(f in d[0] and d[1] for d in left), 0)
        assert r.unique_fails == sum(d[0] == {f} for d in data)


def test_each_set_of_filters_is_counted_once(spark):
    rows = spark.range(9).selectExpr("'p' AS part", "true AS good", "true AS toxic", "id")
    at = audit.edges(rows, {f: f"id % {k} = 1" for k, f in enumerate("ABCD", 2)})
    assert sorted((r.state, r.filter) for r in at.collect()) == sorted((s, f) for s in range(15) for i, f in enumerate("ABCD") if not s >> i & 1)
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # no survivors stay behind
