"""Token alignment against whole texts encoded directly, with links counted one by one."""

from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import alignment, queries

A, B = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
BOTH = alignment.Tokenizers(A, B)
ODD = [
    None, "", " ", "  ", "\n", "a", "a a a a", "It's  we'll\n\n x\t y \x1c z q 　 w", "é ́x ẛ̣", "a" * 700 + " " + "b" * 1500, "x;\r\ny);\r\n\r z\r", "12345 6١٢ 七八", " \n lead",
    "trail \n ", "日本語 текст 🙂👍🏽 a", "▁under ▁▁", "<|endoftext|> <s> </s> <0x41> [UNK]", "\x00 \x01", "a\xa0 b \xa0c", "a  b", "x​ y", "ＡＢ　Ｃ", "=" * 300, "word " * 3000, "word " * 3000,
]


def direct(texts):
    """(n_a, n_b, groups, links as a counter) of each whole text, or None."""
    out = []
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = BOTH.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = BOTH.b.encode(t) if t else []
        ta, tb = [BOTH.a_bytes[i] for i in a], [BOTH.b_bytes[i] for i in b]
        if not t or b"".join(ta) != raw or b"".join(tb) != raw:
            out.append(None)
            continue
        ends_a, ends_b = ([sum(map(len, ts[: k + 1])) for k in range(len(ts))] if len(ts) < 400 else None for ts in (ta, tb))
        if ends_a is None or ends_b is None:
            ends_a, ends_b = running(ta), running(tb)
        both = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for e in both:
            p, q = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        out.append((len(a), len(b), groups, Counter((x, y) for p, q in groups for x in p for y in q)))
    return out


def running(ts):
    out, at = [], 0
    for t in ts:
        at += len(t)
        out.append(at)
    return out


def check(rows, got):
    """rows: (doc_id, text) with distinct ids; got: doc_id -> row with groups as text."""
    made = direct([t for _, t in rows])
    count = Counter(link for m in made if m for link in m[3])
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    assert len(got) == len(rows)
    for (d, t), m in zip(rows, made, strict=True):
        r = got[d]
        if m is None:
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == (0, 0, 0, 0, 0, 0, None), t
            continue
        n_a, n_b, groups, links = m
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        assert r.groups == text, (d, t)
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, len(groups), sum(links.values())), t
        assert r.count_sum == sum(n * count[k] for k, n in links.items())
        assert r.n_best == sum(n for k, n in links.items() if count[k] == most[k[0]])


def test_whole_texts(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [*docs, *((10**6 + i, t) for i, t in enumerate(ODD))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kind string").repartition(3)
    check(rows, {r.doc_id: r for r in alignment.align_tokens(df, A, B).collect()})
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)  # many blocks, with common segments in each
    monkeypatch.setattr(alignment, "ROWS", 100)
    monkeypatch.setattr(alignment, "LONG", 3000)
    check(rows, {r.doc_id: r for r in alignment.align_tokens(df, A, B).collect()})


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    made = dict(zip(docs, direct(docs.values()), strict=True))
    for r in queries.op12_token_alignment(spark, SF).collect():
        m = made[r.doc_id]
        text = m and ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in m[2])
        assert r.groups_sha256 == (sha256(text.encode()).hexdigest() if m else "")
        assert r.n_a == (m[0] if m else 0)


def test_repeated_rows_null_ids_and_empty_table(spark):
    schema = "doc_id long, text string, block string, codes string, `a.b` string"
    out = alignment.align_tokens(spark.createDataFrame([(1, "one two", "x", "y", "z"), (1, "one two", "x", "y", "z"), (None, "one", "x", "y", "z")], schema), A, B).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in out) == [(0, 1, 3), (1, 2, 5), (1, 2, 5)]
    assert alignment.align_tokens(spark.createDataFrame([], schema), A, B).collect() == []
    assert [r.n_a for r in alignment.align_tokens(spark.createDataFrame([(1, None, "", "", "")], schema), A, B).collect()] == [0]


def test_very_long_text(spark):
    text = "".join(f"w{i * i % 9973} " for i in range(400_000)) + "é" * 200_000
    r = alignment.align_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()[0]
    ids = BOTH.a.encode(" " + text, add_special_tokens=False).ids
    assert (r.n_a, r.n_b) == (len(ids), len(BOTH.b.encode(text)))
    assert [int(x) for g in r.groups.split(";") for x in g.split("|")[0].split(",")] == ids


def test_cuts_are_only_made_where_no_merge_crosses():
    assert " " in BOTH.safe and "\n" in BOTH.safe and "\r" not in BOTH.safe  # `;\r` is a token
    assert alignment.safe_cuts([b"a b"]) == "\t\n\x0b\x0c\r"
    assert "".join(BOTH.cut(" x;\r\ny \xa0 z")) == " x;\r\ny \xa0 z"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sé9;.)\r\n\t \xa0 ▁日🙂\x1c​　"), min_size=1, max_size=40))
def test_segments_encode_as_the_whole(text):
    segments = list(BOTH.cut(" " + text))
    a, b = BOTH.encode(segments)
    assert [i for x in a for i in x] == BOTH.a.encode(" " + text, add_special_tokens=False).ids
    if "▁" not in text:
        assert [i for x in b for i in x] == BOTH.b.encode(text)


@pytest.mark.parametrize("many", [1, 3, 10_000])
def test_links_of_groups(many, monkeypatch):
    monkeypatch.setattr(alignment, "MANY", many)
    numbers, texts = BOTH.align([" " + "=" * 37, " the", "▁", " 🙂👍🏽é", " été"])
    assert numbers[:, 4].tolist() == [1, 1, 0, 1, 1] and texts[2] == ""
    some = [t for t in texts if t] + ["1,2,2|3,3;4|5,6", "7|8"]
    links, times, sizes = alignment.links_of(some)
    for t, size in zip(some, sizes.tolist(), strict=True):
        want = Counter((int(a), int(b)) for g in t.split(";") for a in g.split("|")[0].split(",") for b in g.split("|")[1].split(","))
        got = Counter()
        for link, n in zip(links[:size].tolist(), times[:size].tolist(), strict=True):
            got[link >> 32, link & (1 << 32) - 1] += n
        assert got == want
        links, times = links[size:], times[size:]
    assert not len(links)
    assert [len(x) for x in alignment.links_of([])] == [0, 0, 0]
