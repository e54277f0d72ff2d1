"""Personal data: base patterns, and terms that the corpus ties so closely to a protected value that they disclose it."""

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, watch
from .common import LOWER_LUT, PLACES, U, as_struct, bloom_filter, field, materialize, may_hold, mix, quoted, text_slices, word_hashes, written

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Share of a protected value's information from which on a term discloses it.
DISCLOSES = 0.9
#: A tie must be so unlikely by chance that among all pairs tested this many are expected to look like it.
BY_CHANCE = 0.01
#: Kinds of terms, the coarser level of generalisation; the finer one has the first character as well.
CLASSES = ("WORD", "NAME", "CODE")
#: Terms that more than this share of the documents hold are looked up by a broadcast, so that no task gets all rows of one of them.
COMMON = 0.01
LETTER_LUT = np.zeros(256, bool)
LETTER_LUT[[*range(65, 91), *range(97, 123)]] = True


def emails(t: str):
    end, at = 0, t.find("@")
    while at >= 0:
        s = at
        while s > end and t[s - 1] in LOCAL_CHARS:
            s -= 1
        m = DOMAIN.match(t, at + 1) if s < at else None
        if m:
            yield s, m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def base_spans(t: str) -> list:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, s, e) for s, e in emails(t)] if "@" in t else []
    out += [(1, *m.span()) for m in IP.finditer(t) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(t):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in t:
        out += [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def free_words(data: np.ndarray, offs: np.ndarray, spans: list):
    """(hash, row, start, end, start byte, end byte) of the words that overlap none of their row's spans; start and end in code points.

    A word's hash is even; those of its generalisations are odd.
    """
    h, rows, at, to = word_hashes(data, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(rows))
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    first = points[offs]
    s, e = points[at], points[to]
    taken = sorted((first[r] + x, first[r] + y) for r, of_row in enumerate(spans) for _, x, y in of_row)
    starts, ends = (np.array([t[i] for t in taken], np.int64) for i in (0, 1))
    # Of the spans that start before a word's end, the one that reaches farthest.
    reach = np.concatenate([[0], np.maximum.accumulate(ends)])[np.searchsorted(starts, e)]
    ok = np.flatnonzero(reach <= s)
    row, s, e = row[ok], s[ok], e[ok]
    return h[ok] & ~U(1), row, s - first[row], e - first[row], at[ok], to[ok]


def levels(data: np.ndarray, at: np.ndarray, to: np.ndarray):
    """(class, hash of class and first character, hash of the class) of words: a code has a digit, a name starts with a capital A-Z."""
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57), dtype=np.int32)])
    lead = data[at]
    kind = np.where(digits[to] > digits[at], 2, np.where((lead >= 65) & (lead <= 90), 1, 0)).astype(U)
    first = LOWER_LUT[lead].astype(U)
    for k in range(1, 4):  # the other bytes of the first character
        more = lead >= (0, 0xC0, 0xE0, 0xF0)[k]
        first[more] = first[more] << U(8) | data[at[more] + k].astype(U)
    with np.errstate(over="ignore"):
        return kind.astype(np.int64), mix(kind * PLACES[20] + first * PLACES[21]) | U(1), mix(kind * PLACES[22] + U(7)) | U(1)


def is_term(data: np.ndarray, s, e, at, to) -> np.ndarray:
    """Whether words have three characters or more and a letter."""
    letters, others = (np.concatenate([[0], np.cumsum(x)]) for x in (LETTER_LUT[data], data > 127))
    ok = letters[to] > letters[at]
    for k in np.flatnonzero(~ok & (others[to] > others[at]) & (e - s >= 3)):
        ok[k] = any(map(str.isalpha, data[at[k] : to[k]].tobytes().decode()))
    return ok & (e - s >= 3)


def row_terms(data: np.ndarray, offs: np.ndarray, spans: list):
    """(term, row) of the terms of each row and of their generalisations, each once."""
    h, row, s, e, at, to = free_words(data, offs, spans)
    ok = is_term(data, s, e, at, to)
    h, row, at, to = h[ok], row[ok], at[ok], to[ok]
    _, fine, coarse = levels(data, at, to)
    terms, rows = np.concatenate([h, fine, coarse]), np.tile(row, 3)
    order = np.lexsort((terms, rows))
    terms, rows = terms[order], rows[order]
    first = np.concatenate([[True], (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])]) if len(terms) else np.zeros(0, bool)
    return terms[first], rows[first]


def keyed_texts(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(quoted(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("did"), F.xxhash64(t).alias("th"), t.alias("text"))


def texts_and_spans(col: pa.Array):
    for i, j, data, offs in text_slices(col):
        yield i, j, data, offs, [base_spans(t) for t in col.slice(i, j - i).to_pylist()]


def scan(docs: DataFrame, text: str) -> DataFrame:
    """(did, th, rid, base, values, terms) of each row: the text's hash, a number of its own, base spans, and the distinct hashes of protected
    values and, of a row that has any, of its terms and their generalisations."""
    span = pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64())])

    def run(batches):
        for batch in batches:
            for i, j, data, offs, spans in texts_and_spans(batch.column(3)):
                texts = batch.column(3).slice(i, j - i)
                values, terms = [[] for _ in spans], [[] for _ in spans]
                for r in (r for r, x in enumerate(spans) if x):
                    t = texts[r].as_py()
                    values[r] = list({xxhash.xxh3_64_intdigest(f"{k}:{t[s:e]}") - (1 << 63) for k, s, e in spans[r]})
                    own = data[offs[r] : offs[r + 1]]
                    terms[r] = row_terms(own, np.array([0, len(own)]), [spans[r]])[0].view(np.int64)
                base = pa.array([[{"kind": k, "s": s, "e": e} for k, s, e in x] for x in spans], pa.list_(span))
                some = [*(batch.column(c).slice(i, j - i) for c in range(3)), base, pa.array(values, pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(some, ["did", "th", "rid", "base", "values", "terms"])

    keyed = keyed_texts(docs, text).select("did", "th", F.monotonically_increasing_id().alias("rid"), "text")
    return keyed.mapInArrow(run, "did long, th long, rid long, base array<struct<kind:int,s:long,e:long>>, values array<long>, terms array<long>")


def occurrences(docs: DataFrame, text: str, bits: np.ndarray) -> DataFrame:
    """(did, th, term, fine, coarse, kind, s, e): where words that pass the filter stand in each row, outside its base spans, with their generalisations."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(2)):
                h, rows, _, _ = word_hashes(data, offs)
                hit = np.unique(np.repeat(np.arange(j - i), np.diff(rows))[may_hold(held.value, h)])
                spans = [[] for _ in range(j - i)]
                for r in hit:
                    spans[r] = base_spans(batch.column(2)[i + int(r)].as_py())
                if len(hit):
                    h, row, s, e, at, to = free_words(data, offs, spans)
                    ok = np.flatnonzero(may_hold(held.value, h))
                    ok = ok[is_term(data, s[ok], e[ok], at[ok], to[ok])]
                    kind, fine, coarse = levels(data, at[ok], to[ok])
                    of_row = [batch.column(c).take(pa.array(i + row[ok])) for c in (0, 1)]
                    own = (x.view(np.int64) for x in (h[ok], fine, coarse, kind, s[ok], e[ok]))
                    yield pa.RecordBatch.from_arrays([*of_row, *map(pa.array, own)], ["did", "th", "term", "fine", "coarse", "kind", "s", "e"])

    return keyed_texts(docs, text).mapInArrow(run, "did long, th long, term long, fine long, coarse long, kind long, s long, e long")


def term_counts(docs: DataFrame, text: str) -> DataFrame:
    """(term, n): rows that hold each term or generalisation outside base spans, over all rows."""

    def run(batches):
        for batch in batches:
            for _, _, data, offs, spans in texts_and_spans(batch.column(0)):
                terms, n = np.unique(row_terms(data, offs, spans)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    return docs.select(F.coalesce(quoted(text), F.lit("")).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def log_choose(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    g = np.vectorize(math.lgamma, otypes=[float])
    return g(n + 1) - g(k + 1) - g(n - k + 1)


def chance(c: np.ndarray, v: np.ndarray, n: np.ndarray, of: int) -> np.ndarray:
    """The hypergeometric tail: how likely c rows or more hold both, if v rows of `of` hold one and n the other by chance."""
    c, v, n = (np.asarray(x, float) for x in (c, v, n))
    out = np.ones(len(c))
    ok = (c <= np.minimum(v, n)) & (n <= of) & (v <= of) & (c >= v + n - of) & (c > 0)
    c, v, n = c[ok], v[ok], n[ok]
    if len(c):
        term = np.exp(log_choose(v, c) + log_choose(of - v, n - c) - log_choose(np.full(len(c), float(of)), n))
        total, k = term.copy(), c.copy()
        while (term > 1e-16 * total).any():
            term = term * (v - k) * (n - k) / ((k + 1) * (of - v - n + k + 1))
            total, k = total + term, k + 1
        out[ok] = np.minimum(total, 1)
    return out


def disclosing(rows: DataFrame, counts: DataFrame, n_docs: int, discloses: float) -> DataFrame:
    """(term): the terms and generalisations whose pointwise mutual information with a value is `discloses` of the value's information or
    more, by a tie that chance does not explain.

    PMI = log(p(value, term) / (p(value) p(term))), the value's information is -log p(value): a term counts wherever it stands outside
    base spans in a row that holds the value. Texts that are equal count once for a value and for a pair, and each for a term, so copies
    are no evidence. Values of the same texts count once. As p(value, term) <= p(value), only terms with p(term) <= p(value) **
    discloses can pass, so others go before they are paired. Of the pairs so tested those stay whose hypergeometric tail, times the
    number of all of them, is BY_CHANCE at most, and that stand in two texts: a word of one text is tied to nothing, however rare it is.
    """
    texts = rows.where("size(values) > 0").dropDuplicates(["th"])
    held = texts.select("th", F.explode("values").alias("value"))
    own = held.groupBy("value").agg(F.count("*").alias("v"), F.sum(F.xxhash64("th").cast("decimal(20,0)")).alias("docs"))
    own = own.select("value", "v", F.xxhash64("v", "docs").alias("cls"))
    held = materialize(held.join(own, "value").where(F.col("v") < n_docs).select("th", "cls", "v").distinct())
    most = held.groupBy("th").agg((F.pow(F.max("v") / n_docs, F.lit(discloses)) * n_docs * (1 + 1e-9)).alias("limit"))
    terms = texts.where("size(terms) > 0").select("th", "terms").join(most, "th").select("th", "limit", F.explode("terms").alias("term"))
    is_common = F.col("n") > COMMON * n_docs
    terms = terms.join(F.broadcast(counts.where(is_common)), "term", "left").where("n is null or n <= limit")
    rare = terms.where("n is null").drop("n").join(counts.where(~is_common), "term").where("n <= limit")
    both = rare.select("th", "term", "n").union(terms.where("n is not null").select("th", "term", "n")).join(held, "th")
    both = materialize(both.groupBy("cls", "term").agg(F.count("*").alias("c"), F.first("v").alias("v"), F.first("n").alias("n")))
    tested = max(1, both.count())
    share = (F.log(F.col("c") * n_docs) - F.log("v") - F.log("n")) / F.greatest(F.log(F.lit(n_docs) / F.col("v")), F.lit(1e-9))

    def beyond(batches):
        for batch in batches:
            c, v, n = (batch.column(k).to_numpy() for k in (1, 2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(chance(c, v, n, n_docs) * tested <= BY_CHANCE))], ["term"])

    tied = both.where((share >= discloses - 1e-12) & (F.col("c") > 1)).select("term", "c", "v", "n")
    return tied.mapInArrow(beyond, "term long").distinct()


def personal_spans(docs: DataFrame, text: str = "text", discloses: float = DISCLOSES) -> DataFrame:
    """(did, th, base, more) for each row of docs: doc_id, the text's hash, base spans, and every occurrence of a disclosing term.

    more has (s, e, level, kind): at level 1 the term's class (CLASSES[kind]) and first character together disclose nothing, at level 2
    its class, at level 3 neither can be told. Null texts are empty and have no spans; texts of any length are taken whole. Repeated rows
    get the same spans and are no evidence of a tie; rows without an id are told apart by their texts. A table without personal data, or
    without rows, gives none; a value that all rows hold, or only one text, discloses and is disclosed by nothing. Other columns are ignored.
    """
    rows = materialize(scan(docs, text))
    with watch() as made:
        counts = materialize(term_counts(docs, text))
        risky, path = written(disclosing(rows, counts, rows.count(), discloses))
    discard(docs.sparkSession, *(p for p in made if p != path))
    words, general = risky.where("term % 2 = 0"), risky.where("term % 2 <> 0")  # as many generalisations as classes and first characters
    found = occurrences(docs, text, bloom_filter(words, "term")).join(words, "term")
    for name in ("fine", "coarse"):
        found = found.join(F.broadcast(general.select(F.col("term").alias(name), F.lit(True).alias(f"{name}_tells"))), name, "left")
    level = F.when(F.col("fine_tells").isNull(), 1).when(F.col("coarse_tells").isNull(), 2).otherwise(3)
    hit = found.groupBy("did", "th").agg(F.array_sort(F.collect_set(F.struct("s", "e", level.alias("level"), F.col("kind").cast("int").alias("kind")))).alias("more"))
    hit = hit.select(F.coalesce("did", F.lit(-1)).alias("d"), F.col("did").isNull().alias("no_id"), "th", "more")
    keyed = rows.select("did", "th", "base", F.coalesce("did", F.lit(-1)).alias("d"), F.col("did").isNull().alias("no_id"))
    return keyed.join(hit, ["d", "no_id", "th"], "left").select("did", "th", "base", F.coalesce("more", F.array().cast("array<struct<s:long,e:long,level:int,kind:int>>")).alias("more"))


def span_text(name, s, e):
    return F.concat_ws(":", name, s.cast("string"), e.cast("string"))


def span_columns(found: DataFrame) -> DataFrame:
    """doc_id, the counts of base spans, the hash of their list, and the list of all spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda x: span_text(F.element_at(kinds, x["kind"] + 1), x["s"], x["e"]))
    more = F.transform("more", lambda x: span_text(F.lit("term"), x["s"], x["e"]))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(F.col("did").alias("doc_id"), *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.concat(base, more), ",").alias("spans"))


def generalised(term: str, level: int, kind: int) -> str:
    """What stands for a term: its class and first character, its class, or nothing."""
    return (f"[{CLASSES[kind]} {term[0].upper()}]", f"[{CLASSES[kind]}]", "")[level - 1]


def sanitise(docs: DataFrame, text: str = "text", discloses: float = DISCLOSES) -> DataFrame:
    """docs with personal data replaced in text: base spans by [EMAIL], [IP], [CARD], [PHONE]; a disclosing term by the least general form
    that discloses nothing, such as [NAME Z] or [NAME], and by nothing where there is none. All other columns stay, whatever their names;
    a null text stays null; repeated rows end alike."""
    found = personal_spans(docs, text, discloses).where("size(base) > 0 or size(more) > 0").select("did", "th", "base", "more").dropDuplicates(["did", "th"])
    found = found.select(F.coalesce("did", F.lit(-1)).alias("d"), F.col("did").isNull().alias("n"), F.col("th").alias("h"), "base", "more")
    d = F.col("doc_id").cast("long")
    keyed = docs.select(as_struct(docs, (text,)).alias("row"), quoted(text).alias("t"), F.coalesce(d, F.lit(-1)).alias("d"), d.isNull().alias("n"), F.xxhash64(F.coalesce(quoted(text), F.lit(""))).alias("h"))
    joined = keyed.join(found, ["d", "n", "h"], "left").select("row", "t", "base", "more")

    def run(batches):
        for batch in batches:
            out = []
            for value, base, more in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                t = value.as_py()
                cuts = [(x["s"], x["e"], f"[{KINDS[x['kind']].upper()}]") for x in base.as_py()] if base.is_valid else []
                cuts += [(x["s"], x["e"], generalised(t[x["s"]], x["level"], x["kind"])) for x in more.as_py()] if more.is_valid else []
                if cuts:
                    parts, end = [], 0
                    for s, e, mark in sorted(cuts):
                        if s >= end:  # of overlapping spans the first gives the mark
                            parts += [t[end:s], mark]
                        end = max(end, e)
                    t = "".join([*parts, t[end:]])
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "clean"])

    schema = joined.select("row").schema.add("clean", "string")
    return joined.mapInArrow(run, schema).select(*[(F.col("clean") if c == text else field("row", c)).alias(c) for c in docs.columns])
