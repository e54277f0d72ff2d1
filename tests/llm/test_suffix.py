"""Repeated byte strings against brute force."""

from collections import Counter
from hashlib import sha256

from tickloom.llm import suffix


def brute(texts: list, size: int) -> list:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def held(spark, rows, size=200):
    got = suffix.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_bytes string"), size).collect()
    return sorted((r.n_bytes, r.n_removed, r.n_spans, sha256(r.kept).hexdigest()) for r in got)


def test_fixture(spark):
    part = "".join(chr(97 + i * i % 23) + "é"[: i % 7 == 0] for i in range(400))
    texts = [None, "", "short", part, "x" * 50 + part[20:350] + "y" * 90, "ab" * 400, "z" * 199, "z" * 200, "Q" * 201, part, part[:205] + "~" + part[205:], "é" * 150]
    assert held(spark, [(i if i % 4 else None, t, "clash") for i, t in enumerate(texts)]) == sorted(brute(texts, 200))


def test_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP", 4)
    core = "".join(chr(97 + i * 7 % 26) for i in range(60))
    texts = [f"{i:04d}" * 10 + core + f"{i % 6:03d}" * 60 for i in range(40)]
    assert held(spark, list(enumerate(texts, 1)) and [(i, t, "") for i, t in enumerate(texts)]) == sorted(brute(texts, 200))


def test_empty_table(spark):
    assert held(spark, []) == []


def test_documents(spark):
    rows = [(r.doc_id, r.text, "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert held(spark, rows) == sorted(brute([r[1] for r in rows], 200))
