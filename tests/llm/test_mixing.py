"""The mix against targets found step by step, streams taken word by word, and schedules integrated in small steps."""

import re
from collections import Counter
from hashlib import md5

import numpy as np
import pytest

from tickloom.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def filled(sizes, weights, share, most):
    """What stops at its limit is taken out, one source after another, until none is above."""
    left, goals, open_ = share * sum(sizes.values()), {}, dict(weights)
    while open_:
        total = sum(open_.values())
        above = [s for s in open_ if left * open_[s] / total >= most * sizes[s]]
        if not above:
            return goals | {s: left * open_[s] / total for s in open_}
        s = above[0]
        goals[s] = most * sizes[s]
        left -= goals[s]
        del open_[s]
    return goals


def area(knots, t, steps=20_000):
    x = (np.arange(steps) + 0.5) / steps * t
    return float(np.interp(x, *zip(*knots, strict=True)).mean() * t)


def brute(rows, schedules=mixing.SCHEDULES, share=1.5, most=2):
    sources = sorted({r[2] for r in rows if r[2] is not None}) + [None] * any(r[2] is None for r in rows)
    words = [len(WORD.findall(r[1] or "")) for r in rows]
    sizes = {s: sum(n for n, r in zip(words, rows, strict=True) if r[2] == s) for s in sources}
    slots = {s: schedules[i % len(schedules)] for i, s in enumerate(sources)}
    goals = filled(sizes, {s: area(slots[s], 1) for s in sources}, share, most)
    tie = lambda r: md5(str(r[0] if r[0] is not None else "").encode()).hexdigest() + md5((r[1] or "").encode()).hexdigest()
    taken = [[] for _ in rows]
    for s in sources:
        order, at = sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: tie(rows[i])), 0
        for _ in range(most):
            for i in order:
                n = min(words[i], int(goals[s] + 1e-6) - at)
                if n > 0:
                    taken[i].append((n, (at + n / 2) / int(goals[s] + 1e-6)))
                    at += n
    return sizes, goals, words, taken, slots, tie


def check(rows, out, **how):
    sizes, goals, words, taken, slots, tie = brute(rows, **how)
    mixed = how.get("share", 1.5) * sum(words)
    want = sorted((tie(r), words[i], sizes[r[2]], [n for n, _ in taken[i]]) for i, r in enumerate(rows))
    assert sorted((r.tie, r.size, r.source_size, [c.words for c in r.copies]) for r in out) == want
    for r in out:
        s = r.row.source
        assert r.target == pytest.approx(goals[s]) and r.taken == sum(c.words for c in r.copies) <= how.get("most", 2) * r.size
    ties = Counter(r.tie for r in out)
    for r in [r for r in out if ties[r.tie] == 1][:: max(1, len(out) // 40)]:
        i = next(i for i, x in enumerate(rows) if tie(x) == r.tie and x[2] == r.row.source)
        for c, (_, part) in zip(r.copies, taken[i], strict=True):
            knots = slots[r.row.source]
            assert area(knots, c.position / mixed) / area(knots, 1) == pytest.approx(part, abs=2e-3)
    for s in goals:
        assert abs(sum(r.taken for r in out if r.row.source == s) - goals[s]) < 1 + 1e-6


def frame(spark, rows, extra="size"):
    return spark.createDataFrame([(*r, "x") for r in rows], f"doc_id long, text string, source string, `{extra}` string")


def test_mix_of_documents(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, mixing.mix_sources(frame(spark, rows)).collect())
    by = {r.row.doc_id: r for r in mixing.mix_sources(frame(spark, rows).repartition(5)).collect()}
    for r in queries.op13_source_mix(spark, SF).collect():
        assert (r.size, r.taken, r.target) == (by[r.doc_id].size, by[r.doc_id].taken, by[r.doc_id].target)


ODD = [(None, "a b", "s"), (None, "a b", "s"), (1, None, "s"), (2, "", None), (3, "x " * 50_000, None), (4, "one", "é"), (5, "one two", "z"), (5, "one two", "z"), (6, "\x1c \x0b  ", ""), (7, " ", "none"), (8, "w " * 9, "\U0001f600")]


@pytest.mark.parametrize("how", [{}, {"share": 0.5}, {"share": 3.0, "most": 4}, {"schedules": [[(0.0, 0.0), (0.25, 2.0), (0.25, 1.0), (1.0, 0.0)], [(0.0, 1.0), (1.0, 0.0)]]}])
def test_odd_rows(spark, how, monkeypatch):
    monkeypatch.setattr(mixing, "SLICES", 3)
    if "schedules" in how:  # np.interp takes the later of two rates at one time, which is what the pieces do
        assert mixing.integrated(spark, how["schedules"]).orderBy("slot").first().weight == pytest.approx(0.25 + 0.375)
    check(ODD, mixing.mix_sources(frame(spark, ODD, "a.b"), **how).collect(), **how)


def test_empty_table_and_no_words(spark):
    assert mixing.mix_sources(frame(spark, []).where("doc_id > 0")).collect() == []
    (r,) = mixing.mix_sources(frame(spark, [(1, None, None)])).collect()
    assert (r.size, r.source_size, r.target, r.taken, r.copies) == (0, 0, 0.0, 0, [])


def test_order_of_training(spark):
    rows = [(i, "word " * (1 + i % 7), f"s{i % 4}") for i in range(300)]
    mixed = mixing.mix_sources(frame(spark, rows))
    order = mixing.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and sum(r.words for r in order) == sum(r.taken for r in mixed.collect())
    first, last = order[: len(order) // 4], order[-len(order) // 4 :]
    share = lambda some, s: sum(r.words for r in some if r.row.source == s) / sum(r.words for r in some)
    assert share(first, "s0") > 1.5 * share(last, "s0") and share(last, "s2") > 1.5 * share(first, "s2")  # s0's weight falls, s2's rises


def test_one_source_is_sorted_in_many_slices(spark):
    df = frame(spark, [(i, f"w {i}", "only") for i in range(3000)])
    plan = mixing.mix_sources(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan
    assert "hashpartitioning(source" in plan and "slice" in plan
