"""Corpus operators against brute force, the libraries themselves and planted cases; odd inputs have defined results."""

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import chunks, licenses, lines, minhash, packing, pii, quality, queries, rules, suffix, vectors

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "x"), (2, "", "x"), (None, "only one of its kind", "x"), (4, "a\nb  c\t\nd " * 5, "x"), (5, "word " * 3000, "x"), (6, "word " * 3000, "x"), (6, "word " * 3000, "x"), (7, "é" * 30_000, "x")]
CLASH = "doc_id long, text string, {} string"


def odd(spark, clash, rows=ODD):
    return spark.createDataFrame(rows, CLASH.format(clash))


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer(name))
    t.no_truncation()
    t.no_padding()
    return t


TRICKY = ["<|endoftext|> a<|endoftext|>b", "It's  we'll\n\n x\t y \x1c z q 　 w", "é ́x ẛ̣", "a" * 700 + " " + "b" * 1500, "Σ ΑΣ ΑΣ.", "12345 6١٢ 七八", " \n lead", "trail \n ", "x\n y", "<|startoftext|>y<|end", "日本語 текст 🙂👍🏽 a"]


def test_pack(spark, docs):
    tok = library("byte_bpe_50k.json")
    rows = [*docs.items(), *((10**6 + i, t) for i, t in enumerate(TRICKY)), (10**7, None), (10**7, None)]
    out = packing.best_fit_pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), queries.tokenizer("byte_bpe_50k.json")).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        assert r.length == len(r.ids) <= 1024
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d, t in rows[:-2]:
        own = sorted(by_doc[d], key=lambda r: r.piece)
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert [x for r in own for x in r.ids] == ids, d
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 1024 for r in own[1:])
    assert len(by_doc[10**7]) == 2
    for placed in by_seq.values():
        at = 0
        for o, n in sorted(placed):
            assert o == at
            at += n
        assert at <= 1024
    assert len(by_seq) <= 1.02 * sum(r.length for r in out) / 1024 + 1


def test_plan_counts():
    counts = {700: 3, 324: 2, 300: 10, 1024: 5, 1: 4}
    made = packing.plan(counts, 1024)
    assert {k: sum(r[2] for r in made if r[0] == k) for k in counts} == counts
    assert len({s for _, _, n, first, _ in made for s in range(first, first + n)}) == 5 + 3 + 3


def test_chunks(spark, docs):
    tok = library("word_bpe_49k.json")
    rows = [*docs.items(), *((10**6 + i, t) for i, t in enumerate(TRICKY)), *((2 * 10**6 + i, " ".join(TRICKY) + docs[min(docs)] + str(i)) for i in range(3)), (10**7, None)]
    out = {r.doc_id: r for r in chunks.encode_decode(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer("word_bpe_49k.json")).collect()}
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert out[d].ids == ids and out[d].n_tokens == len(ids), d
        assert out[d].decoded == tok.decode(ids, skip_special_tokens=False), d


def test_chunk_joins_are_exact():
    bpe = chunks.WordBpe(queries.tokenizer("word_bpe_49k.json"))
    text = ("The unquestionably longest  words\nand<|endoftext|>more it's " * 3).encode()
    for step in (1, 2, 3, 7, 11, len(text)):
        assert chunks.assemble(bpe, [chunks.part_of(bpe, text[i : i + step]) for i in range(0, len(text), step)]) == bpe.encode(text)


def test_chunks_are_encoded_once(spark):
    passage = "".join(f"word{x} " for x in np.random.default_rng(2).integers(0, 9999, 4000))
    rows = [(i, f"{i} own words " * 40 + passage + f" end {i}") for i in range(6)] + [(9, "alone " * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places = sum(len(cut) - 1 for _, t in rows for cut in chunks.chunk_cuts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])))
    repeated = chunks.repeated_chunks(df.select(df.doc_id.alias("did"), "text")).count()
    assert repeated >= 5 and repeated * 5 < places  # nearly all of the passage's chunks are the same six times
    tok = library("word_bpe_49k.json")
    assert {r.doc_id: r.ids for r in chunks.encode_decode(df, queries.tokenizer("word_bpe_49k.json")).collect()} == {d: tok.encode(t, add_special_tokens=False).ids for d, t in rows}


def test_digests_of_queries(spark, docs):
    tok, byte = library("word_bpe_49k.json"), library("byte_bpe_50k.json")
    for r in queries.op7_bpe_chunks(spark, SF).collect():
        ids = tok.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in queries.op4_best_fit_packing(spark, SF).collect():
        ids = [*byte.encode(docs[r.doc_id], add_special_tokens=False).ids, 2][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and len(ids) == r.length


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted((int(x) for x in np.minimum(rng.integers(1, 140, 400), 100)), reverse=True)
    room = []
    for n in lengths:  # one piece after another, each where the least room is left
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(100 - n)
    made = packing.plan({k: lengths.count(k) for k in set(lengths)}, 100)
    used = {s for _, _, n, first, _ in made for s in range(first, first + n)}
    assert len(used) == len(room) and sum(n for _, _, n, _, _ in made) == len(lengths)


def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(f"email:{m.start()}:{m.end()}")
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(f"ip:{m.start()}:{m.end()}")
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(d[::2] + [x * 2 // 10 + x * 2 % 10 for x in d[1::2]]) % 10 == 0:
            out.append(f"card:{m.start()}:{m.end()}")
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(f"phone:{m.start()}:{m.end()}")
    return out


def test_pii_base(spark, docs):
    hard = "a@b a@b.c@d.e x.y@@z.q é@é.fr b@c.d.+1 (555) 010-9999. 1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.4 4111 1111-1111 1111 4111111111111112 ++49 30 1234567 +1-2 + 3"
    rows = [*docs.items(), (10**6, hard), (10**6 + 1, None), (10**6 + 2, "é" + hard * 3)]
    found = pii.span_columns(pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(found) == len(rows)
    total = 0
    for r, (_, t) in zip(sorted(found, key=lambda r: r.doc_id), sorted(rows), strict=True):
        want = brute_spans(t or "")
        assert r.base_sha256 == sha256(",".join(want).encode()).hexdigest(), (r, want)
        assert r.spans.split(",")[: len(want)] == want or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        total += len(want)
    assert total > 20


def test_pii_terms(spark):
    rows = [(i, f"many words here and some {i} then ask Zorbulax at jo@acme.org for help with it") for i in range(4)] + [(10 + i, "ask for help with many words here at once then and it" + " Xylo" * (i > 2)) for i in range(40)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, kept string, `a.b` int")
    found = {r.did: r for r in pii.personal_spans(df).collect()}
    words = [(rows[0][1].index(w), rows[0][1].index(w) + len(w)) for w in ("some", "Zorbulax")]
    # Words with s stand in these documents only, and so do names with Z; a word or a name as such tells nothing.
    assert [(x.s, x.e) for x in found[0].more] == words and [x.level for x in found[0].more] == [2, 2]
    assert not any(found[10 + i].more for i in range(40))
    clean = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert clean[0].text == "many words here and [WORD] 0 then ask [NAME] at [EMAIL] for help with it" and clean[0].kept == "s" and clean[0]["a.b"] == 1
    assert clean[12].text == rows[6][1]


def test_pii_far_from_value(spark):
    common = "many words stand here and there "
    rows = [(1, f"Vexilor {common * 40}\n\n at jo@acme.org now Vexilor"), (2, f"jo@acme.org {common} é Vexilor"), (3, f"{common} Vexilor"), (4, f"{common} +49 30 1234567 {common} Quandry 日本語"), *((i, common + "Vera") for i in range(10, 900))]
    out = {r.did: r for r in pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows[:4]:
        assert [(x.s, x.e) for x in out[d].more] == [(m.start(), m.end()) for m in re.finditer("Vexilor", t)], d
    assert not any(out[i].more for i in range(10, 900))
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[3] == f"{common} [NAME V]" and clean[10] == common + "Vera"
    few = [(1, "Qu4x at jo@acme.org"), (2, "Qu4x and jo@acme.org once"), (3, "Qu4x is jo@acme.org too"), *((i, "many") for i in range(4, 90))]
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(few, "doc_id long, text string")).collect()}
    assert clean[1] == " at [EMAIL]" and clean[2] == " and [EMAIL] once"  # no other document has a code, nor one that starts with Q


def test_pii_ties_are_not_chance(spark):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join(f"w{x}x" for x in rng.integers(0, 3000, n))
    planted = {f"Planted{p}": [f"{words(30)} Planted{p} {words(5)} p{p}@acme.org hapax{p}n{k} {words(9)}" for k in range(3)] for p in range(8)}
    single = [f"{words(40)} only{k}once s{k}@acme.org {words(10)}" for k in range(60)]
    copied = [f"{words(30)} copied once c@acme.org Unusual text"] * 7
    texts = [*(t for some in planted.values() for t in some), *single, *copied, *(words(40) for _ in range(1500)), "Planted3 stands without an address"]
    out = {r.did: r for r in pii.personal_spans(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    marked = {(d, texts[d][x.s : x.e]) for d, r in out.items() for x in r.more}
    assert marked == {(d, w) for d, t in enumerate(texts) for w in planted if f"{w} " in t}  # no hapax, no word of one text or of its copies
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert all(clean[d] == t for d, t in enumerate(texts) if not pii.base_spans(t) and "Planted" not in t)


def test_pii_chance_is_the_hypergeometric_tail():
    from itertools import product
    from math import comb

    cases = [(c, v, n, 30) for c, v, n in product(range(1, 5), range(1, 8), range(1, 8))] + [(2, 3, 4, 10**6), (1, 30, 30, 30)]
    for c, v, n, of in cases:
        want = sum(comb(v, k) * comb(of - v, n - k) for k in range(c, min(v, n) + 1) if n - k <= of - v) / comb(of, n) if c <= min(v, n) and c >= v + n - of else 1
        assert pii.chance([c], [v], [n], of)[0] == pytest.approx(want, rel=1e-6)


def test_pii_brute(spark, docs):
    docs = docs | {10**6 + k: f"Ωmega stands {k} at zz@acme.org" for k in range(3)} | {10**6 + 3 + k: f"the Ypsilo{k}n {k} at yy@acme.org" for k in range(2)}
    own, held, n = {}, defaultdict(set), len(docs)
    low = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)

    def forms(w):
        kind = "CODE" if re.search("[0-9]", w) else "NAME" if "A" <= w[0] <= "Z" else "WORD"
        return [("word", low(w)), ("fine", kind, low(w[0])), ("coarse", kind)]

    every = defaultdict(set)
    for d, t in docs.items():
        spans = pii.base_spans(t)
        own[d] = [m for m in re.finditer(r"[^\x20\x09-\x0d]+", t) if not any(s < m.end() and m.start() < e for _, s, e in spans) and len(m[0]) >= 3 and any(map(str.isalpha, m[0]))]
        for k, s, e in spans:
            held[k, t[s:e]].add(d)
        for m in own[d]:
            for f in forms(m[0]):
                every[f].add(d)
    risky, pairs = set(), {}
    for ds in held.values():
        of = {docs[d]: d for d in ds}  # equal texts count once
        for f in {f for d in ds for m in own[d] for f in forms(m[0])} if len(of) < n else ():
            c, v = len({docs[d] for d in every[f] & ds}), len(of)
            if len(every[f]) <= n * max(len({docs[d] for d in x}) / n for x in held.values() if x & ds and len({docs[d] for d in x}) < n and x & every[f]) ** 0.9 * (1 + 1e-9):
                pairs[frozenset(of), f] = c, v, len(every[f])
    for (_, f), (c, v, k) in pairs.items():
        if np.log(c * n / v / k) >= 0.9 * np.log(n / v) - 1e-12 and c > 1 and pii.chance([c], [v], [k], n)[0] * len(pairs) <= 0.01:
            risky.add(f)
    want = {d: [(*m.span(), 1 + (forms(m[0])[1] in risky) * (1 + (forms(m[0])[2] in risky))) for m in own[d] if forms(m[0])[0] in risky] for d in docs}
    got = {r.did: r.more for r in pii.personal_spans(spark.createDataFrame([*docs.items()], "doc_id long, text string")).collect()}
    assert {d: [(x.s, x.e, x.level) for x in got[d]] for d in docs} == want and any(want.values())


def test_quality(spark, docs):
    out = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.93, (auc, np.mean([r.predicted == r.quality for r in held]))


def dense_ftrl(rows, epochs, size):
    """FTRL-proximal as published, weight by weight, over rows of (features, label, importance)."""
    z, n, w = [0.0] * size, [0.0] * size, [0.0] * size
    at = lambda i: 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - (quality.L1 if z[i] > 0 else -quality.L1)) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)
    for _ in range(epochs):
        for x, y, c in rows:
            w = [at(i) for i in range(size)]
            p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
            for i in range(size):
                g = c * (p - y) * x[i]
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA * w[i]
                n[i] += g * g
    return [at(i) for i in range(size)]


def test_ftrl_and_scores_are_as_dense(spark, monkeypatch):
    monkeypatch.setattr(quality, "BITS", 6)  # workers learn of it by the functions' globals only where they run here: so in this process
    texts = ["good words and fine prose", "bad bad bad !!!", "prose of good words", "!!! buy buy", "fine words", "buy bad !!!"]
    y = [1, 0, 1, 0, 1, 0]
    raw = "".join(texts).encode()
    offs = np.cumsum([0, *(len(t.encode()) for t in texts)])
    bounds, x, v = quality.weighted(*quality.features(np.frombuffer(raw, np.uint8), offs), len(texts))
    dense = np.zeros((len(texts), 64))
    for r in range(len(texts)):
        dense[r, x[bounds[r] : bounds[r + 1]]] = v[bounds[r] : bounds[r + 1]]
    assert np.allclose((dense**2).sum(axis=1), 1)
    rows = [(x[bounds[r] : bounds[r + 1]], v[bounds[r] : bounds[r + 1]], y[r], 1.0) for r in range(len(texts))]
    want = dense_ftrl([(dense[r].tolist(), y[r], 1.0) for r in range(len(texts))], 3, 64)
    got = quality.ftrl(rows, 3)
    assert np.allclose(got, want, atol=1e-12) and np.count_nonzero(got)


def test_score_is_the_dot_product(spark, docs):
    w = np.random.default_rng(5).standard_normal(1 << quality.BITS)
    some = [*docs.items()][:40]
    out = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(some, "doc_id long, text string"), w).collect()}
    for d, t in some:
        raw = np.frombuffer(t.encode(), np.uint8)
        counts = np.bincount(quality.features(raw, np.array([0, len(raw)]))[0], minlength=1 << quality.BITS)
        dot = w @ np.sqrt(counts) / max(1.0, np.sqrt(counts.sum()))
        assert abs(out[d] - 1 / (1 + np.exp(-dot))) < 1e-9


def test_features_of_words():
    raw = "a Bc 12x !! é, a".encode()
    x, _ = quality.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    whole, _ = quality.features(np.frombuffer(raw + b" z", np.uint8), np.array([0, len(raw) + 2]))
    assert len(x) == 6 + 5 + 6 + 5 + 5 + 4 + 3 + 2 and set(x) <= set(whole)


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"].split()
    near = " ".join(w for i, w in enumerate(mit) for w in ((w, "entirely") if i in (30, 90) else (w,)))
    texts = [(1, "pad " * 37 + near.upper() + " pad" * 50), (2, " ".join(mit[:60])), (3, "Released under the MIT\nLicense. Licensed under CC BY-NC 4.0."), (4, None), (5, "x"), (6, "pad " * 100), (None, "So: ALL rights\treserved. Or not"), (8, "all rights reserved"), (3, "All rights reserved.")]
    rows = [(d, t, "x") for d, t in texts]
    got = [(r.doc_id, r.license) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()]
    assert sorted(got, key=str) == sorted([(1, "mit"), (3, "mit-notice"), (3, "cc-by-nc-4.0-notice"), (None, "all-rights-reserved"), (3, "all-rights-reserved")], key=str)
    assert licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, license string"), {"none": "", "null": None}).collect() == []


def test_license_recall(spark):
    """Templates of all lengths in texts with words changed as far as 80 % of the shingles stay, all through the bands."""
    rng = np.random.default_rng(9)
    rows, want = [], set()
    for name, wording in licenses.TEMPLATES.items():
        words = wording.lower().split()
        k = min(len(words), licenses.K)
        full = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        for _ in range(40):
            own = list(words)
            for at in rng.permutation(len(words)):
                changed = [*own[:at], f"changed{at}", *own[at + 1 :]]
                if 100 * len(full & {tuple(changed[i : i + k]) for i in range(len(changed) - k + 1)}) < 80 * len(full) or rng.random() < 0.2:
                    break
                own = changed
            rows.append((len(rows), " ".join([*(f"pre{i}" for i in range(rng.integers(0, 60))), *own, *(f"post{i}" for i in range(rng.integers(0, 60)))])))
            want.add((len(rows) - 1, name))
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want & got) >= 0.999 * len(want), len(want - got)
    assert len({w for *_, w in (t for k, some in licenses.by_length(licenses.TEMPLATES).items() for t in licenses.template_table(some, 80, k))}) == 4


def brute_links(v, cosine=0.95):
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= cosine
    np.fill_diagonal(near, False)
    return near


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 64))
    v = np.concatenate([base, base[:100] + 0.3 * rng.standard_normal((100, 64)), base[:1] + 0.15 * rng.standard_normal((700, 64)), base[5:6], 3 * base[5:6]]).astype(np.float32)
    rows = [(i, x.tolist(), "c") for i, x in enumerate(v)] + [(5000, None, "c"), (5001, [0.0] * 64, "c"), (5002, [float("nan")] * 64, "c"), (5003, [1.0, 2.0], "c"), (None, [2.0, 4.0], "c"), (5004, [], "c")]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, cid string")).collect() if r.vec_id is not None}
    near = brute_links(v.astype(np.float64))
    links = np.array([got[i].n_links for i in range(len(v))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.999 * near.sum(), links.sum() / near.sum()
    assert got[len(v) - 1].component_id == 5 and got[5].kept and not got[len(v) - 1].kept
    assert all(got[i].n_links == 0 and got[i].kept for i in (5000, 5001, 5002, 5004)) and got[5003].n_links == 1


@pytest.mark.parametrize(("n", "dim"), [(1_100, 64), (10_000, 64), (100_000, 64), (1_000_000, 64), (10_000, 4)])
def test_isolated_pairs_meet(n, dim):
    rng = np.random.default_rng(11)
    for cosine in (0.951, 0.97, 0.99):
        x, y = vectors.pairs_at(rng, 1000, dim, cosine)
        assert vectors.Caps(dim, n).met(x, y).mean() >= 0.99, cosine


@pytest.mark.parametrize("n", [10_000, 100_000])
def test_isolated_links(spark, n):
    rng = np.random.default_rng(12)
    x, y = vectors.pairs_at(rng, 500, 64, 0.955)
    v = np.concatenate([x, y, rng.standard_normal((n - 1000, 64))]).astype(np.float32)
    table = pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), 64).cast(pa.list_(pa.float32()))})
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(table)).where("vec_id < 1000").collect()}
    assert sum(got[i].n_links == 1 == got[500 + i].n_links and got[500 + i].component_id == i for i in range(500)) >= 495


def odd_results(spark, df):
    """What each operator makes of the odd rows, in the rows' order."""
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    rows = lambda d, *c: sorted((tuple(r[x] for x in c) for r in d.collect()), key=key)
    left = lines.dedup_lines(df, min_docs=2, min_chars=4)
    return {
        "near": rows(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept"),
        "lines": sorted(((r.rest.doc_id, r.n_lines, r.n_dropped, r.text) for r in left.collect()), key=key),
        "rules": rows(rules.quality_rules(df), "doc_id", "n_words", "base_failed", "kept"),
        "pack": rows(packing.best_fit_pack(df, queries.tokenizer("byte_bpe_50k.json")), "doc_id", "piece", "length"),
        "encode": rows(chunks.encode_decode(df, queries.tokenizer("word_bpe_49k.json")), "doc_id", "n_tokens"),
        "spans": rows(pii.span_columns(pii.personal_spans(df)), "doc_id", "n_email", "spans"),
        "clean": rows(pii.sanitise(df), "doc_id", "text"),
        "licenses": rows(licenses.scan_licenses(df), "doc_id", "license"),
        "score": rows(quality.score(df, None, into="made"), "doc_id", "made"),
        "repeats": rows(suffix.drop_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans"),
    }


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, columns of clashing names."""
    names = ["score", "cid", "th", "did", "row", "rest", "t", "a.b", "n`x", "text2", "base"]
    df = spark.createDataFrame([(d, t, *[x] * len(names)) for d, t, x in ODD], "doc_id long, text string, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in names))
    got = odd_results(spark, df)
    ids = sorted((r[0] for r in ODD), key=str)
    assert got["near"] == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True), (4, 4, 4, True), (5, 1, 5, True), (6, 1, 5, False), (6, 1, 5, False), (7, 1, 7, True)], key=lambda r: str(r[0]))
    assert [(r[0], *r[1:3]) for r in got["lines"]] == sorted([(1, 1, 0), (2, 1, 0), (None, 1, 0), (4, 11, 0), (5, 1, 1), (6, 1, 0), (6, 1, 0), (7, 1, 0)], key=lambda r: str(r[0]))
    assert {r[0]: r[3] for r in got["lines"]}[5] == "" and {r[0]: r[3] for r in got["lines"]}[6] == "word " * 3000
    assert [r[:2] for r in got["rules"]] == sorted([(1, 0), (2, 0), (None, 5), (4, 20), (5, 3000), (6, 3000), (6, 3000), (7, 1)], key=lambda r: str(r[0])) and all(r[2] and not r[3] for r in got["rules"])
    byte, word = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    want, packed = defaultdict(int), defaultdict(int)
    for d, t, _ in ODD:
        want[d] += 1 + len(byte.encode(t or "", add_special_tokens=False).ids)
    for d, _, n in got["pack"]:
        packed[d] += n
    assert packed == want and sum(i == 0 for _, i, _ in got["pack"]) == len(ODD)
    assert [r[2] for r in got["pack"] if r[0] in (1, 2)] == [1, 1]
    assert got["encode"] == sorted(((d, len(word.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in ODD), key=lambda r: (str(r[0]), str(r[1])))
    assert all(r[1:] == (0, "") for r in got["spans"]) and [r[0] for r in got["spans"]] == ids
    assert got["clean"] == sorted(((d, t) for d, t, _ in ODD), key=lambda r: (str(r[0]), str(r[1])))
    assert got["licenses"] == [] and got["score"] == [(d, 0.5) for d in ids]
    assert {r[0]: r[1:] for r in got["repeats"]}[5] == (15_000, 15_000, 1) and {r[0]: r[1:] for r in got["repeats"]}[7] == (60_000, 60_000, 1) and {r[0]: r[1:] for r in got["repeats"]}[1] == (0, 0, 0)
    with pytest.raises(ValueError):
        quality.score(df, None)
    assert pii.sanitise(df).columns == df.columns and {tuple(r)[2:] for r in pii.sanitise(df).collect()} == {("x",) * len(names)}
    assert set(lines.dedup_lines(df).select("rest.*").columns) == set(df.columns) - {"text"}


def test_odd_empty_table(spark):
    assert all(v == [] for v in odd_results(spark, odd(spark, "cid", [])).values())


def test_very_long_texts(spark):
    """Texts of several megabytes, one of them a single word, give what short ones do."""
    rng = np.random.default_rng(1)
    words = " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 180_000)).translate(str.maketrans("0123456789", "abcdefghij"))
    rows = [(1, words), (2, words + " end"), (3, "x" * 400_000), (4, "a@b.de " + words[:2_200_000] + " 4111 1111 1111 1111")]
    assert len(words) > 2_300_000
    df = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string").repartition(4)
    near = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    assert [near[d].component_id for d in (1, 2, 3)] == [1, 1, 3] and near[1].n_shingles == 180_000 - 4
    tok = library("word_bpe_49k.json")
    assert {r.doc_id: r.n_tokens for r in chunks.encode_decode(df, queries.tokenizer("word_bpe_49k.json"), lambda ids, bpe: ("",), (("none", "string"),)).collect()} == {d: len(tok.encode(t, add_special_tokens=False).ids) for d, t in rows}
    assert [(r.n_email, r.n_card) for r in pii.span_columns(pii.personal_spans(df)).orderBy("doc_id").collect()] == [(0, 0)] * 3 + [(1, 1)]
    cut = {r.doc_id: r for r in suffix.drop_repeats(df).collect()}
    assert cut[1].n_removed == cut[1].n_bytes == len(words) and cut[2].n_removed == len(words) and cut[3].n_removed == 400_000 and cut[3].n_spans == 1
    assert all(0 < r.score < 1 for r in quality.score(df, np.full(1 << quality.BITS, 1e-3)).collect())
    assert {r.doc_id: r.text for r in pii.sanitise(df).collect()} == {**dict(rows), 4: rows[3][1].replace("a@b.de", "[EMAIL]").replace("4111 1111 1111 1111", "[CARD]")}
    assert {r.doc_id: r.n_words for r in rules.quality_rules(df).collect()} == {d: len(t.split()) for d, t in rows}
    byte, sizes = library("byte_bpe_50k.json"), defaultdict(int)
    for r in packing.best_fit_pack(df, queries.tokenizer("byte_bpe_50k.json"), payload=(len, "n", "long")).collect():
        sizes[r.doc_id] += r.n
    assert sizes == {d: 1 + len(byte.encode(t, add_special_tokens=False).ids) for d, t in rows}
    name, wording = max(licenses.TEMPLATES.items(), key=lambda x: len(x[1]))
    far = spark.createDataFrame([(1, f"{words} {wording} {words}"), (2, words)], "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in licenses.scan_licenses(far).collect()} >= {(1, name)} and not [r for r in licenses.scan_licenses(far).collect() if r.doc_id == 2]
    many = "\n".join(f"line number {i % 50_000} of a very long text" for i in range(80_000))
    left = {r.rest.doc_id: r for r in lines.dedup_lines(spark.createDataFrame([(i, many) for i in range(3)] + [(9, words)], "doc_id long, text string")).collect()}
    assert [left[d].n_dropped for d in (0, 1, 2, 9)] == [80_000, 80_000, 0, 0] and left[2].text == many and left[9].text == words


def test_vectors_empty(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_train_empty(spark):
    assert quality.train(odd(spark, "a", []), spark.createDataFrame([], "doc_id long, quality int")) is None

