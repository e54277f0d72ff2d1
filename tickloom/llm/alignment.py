"""Alignment of two tokenizers: texts fall into segments that neither vocabulary merges across; each distinct segment is aligned once."""

import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard
from .common import materialize, process_memo, quoted, written

#: Bytes of text in a block of documents, whose distinct segments are held at once; rows that leave together; distinct segments encoded in one call.
BLOCK_BYTES, ROWS, AT_ONCE = 12 << 20, 40_000, 4000
#: Texts of so many characters are not cut into a list at once.
LONG = 1 << 20
#: White space before which a text may be cut, where the vocabularies allow it; and all that any library could take for white space.
CUTTABLE = " \t\n\x0b\x0c\r"
BROAD = CUTTABLE + "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
DOC, SEGMENT = 0, 1
#: What stands between the numbers of a text of groups; pairs of a group from which on its distinct ids are paired.
SEPARATORS = bytes.maketrans(b",|;\n", b"    ")
MANY = 10_000


def safe_cuts(tokens: list) -> str:
    """The characters of CUTTABLE that no token (bytes) has after a character outside BROAD: no merge of these vocabularies crosses a cut before them."""
    crossed = set()
    for t in tokens:
        text = t.decode(errors="replace")
        crossed.update(b for a, b in zip(text[:-1], text[1:], strict=True) if b in CUTTABLE and a not in BROAD)
    return "".join(c for c in CUTTABLE if c not in crossed)


def cutter(safe: str):
    """The segments of a string: it is cut before runs of white space that start with a character in `safe`, after one outside BROAD."""
    broad, keep = re.escape(BROAD), re.escape("".join(c for c in BROAD if c not in safe))
    pattern = re.compile(f"(?:[{broad}]+[^{broad}]*|[^{broad}]+)(?:[{keep}][{broad}]*[^{broad}]*)*")
    return lambda text: pattern.findall(text) if len(text) < LONG else (m[0] for m in pattern.finditer(text))


class Tokenizers:
    """A byte-level BPE file (A) and a sentencepiece model (B), with the bytes of each token.

    A's split pattern ends a piece wherever white space follows another character, and looks no further back, so only its vocabulary can
    forbid a cut. B adds a space to what it encodes; segments are encoded after a letter instead, from which no merge leads into them.
    """

    GUARD = "a"

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        byte = {c: ord(c) if ord(c) < 256 else odd[ord(c) - 256] for c in pre_tokenizers.ByteLevel.alphabet()}
        entries = sorted((i, t) for t, i in self.a.get_vocab().items())
        added = set(self.a.get_added_tokens_decoder())
        self.a_bytes = {i: t.encode() if i in added else bytes(byte[c] for c in t) for i, t in entries}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.safe = safe_cuts([*(t for i, t in self.a_bytes.items() if i not in added), *self.b_bytes])
        if " " not in self.safe:
            raise ValueError("these vocabularies merge across spaces")
        self.cut = cutter(self.safe)
        self.skip = len(self.b.encode(self.GUARD))

    def encode(self, segments: list) -> tuple[list, list]:
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([self.GUARD + s for s in segments], num_threads=1)
        return a, [ids[self.skip :] for ids in b]

    def align(self, segments: list) -> tuple[np.ndarray, list]:
        """(numbers, texts): for each segment n_a, n_b, n_groups, n_links and whether its tokens' bytes are its own; its groups as text, empty if they are not."""
        a, b = self.encode(segments)
        numbers, texts = np.zeros((len(segments), 5), np.int64), []
        of_a, of_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for k, (segment, x, y) in enumerate(zip(segments, a, b, strict=True)):
            raw, ta, tb = segment.encode(), [*map(of_a, x)], [*map(of_b, y)]
            if b"".join(ta) != raw or b"".join(tb) != raw:
                texts.append("")
                continue
            groups, i, j = [], 0, 0
            if len(x) == 1 or len(y) == 1:
                groups.append((x, y))
            else:
                ends, at = {}, 0
                for n, t in enumerate(ta):
                    at += len(t)
                    ends[at] = n + 1
                at = 0
                for n, t in enumerate(tb):
                    at += len(t)
                    if to := ends.get(at):
                        groups.append((x[i:to], y[j : n + 1]))
                        i, j = to, n + 1
            numbers[k] = len(x), len(y), len(groups), sum(len(p) * len(q) for p, q in groups), 1
            texts.append(";".join([",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups]))
        return numbers, texts


def links_of(texts: list) -> tuple:
    """(links, times, sizes) of texts of groups: the pairs a << 32 | b of each text's groups, how often each stands there, and the pairs of each text.

    Pairs that repeat in a text may stand there more than once, each with its times; a group of many pairs has its distinct ids paired.
    """
    raw = "\n".join([*texts, ""]).encode()
    data = np.frombuffer(raw, np.uint8)
    after = data[(data < 48) | (data > 57)]  # what follows each number
    ids = np.fromstring(raw.translate(SEPARATORS), np.int64, sep=" ") if raw else np.zeros(0, np.int64)
    ends, middle = np.flatnonzero((after == ord(";")) | (after == ord("\n"))) + 1, np.flatnonzero(after == ord("|")) + 1
    first = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    p, q = middle - first, ends - middle
    text = np.cumsum(after[ends - 1] == ord("\n")) - (after[ends - 1] == ord("\n"))
    m = np.where(p * q > MANY, 0, p * q)
    k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    width = np.repeat(q, m)
    links, of = ids[np.repeat(first, m) + k // width] << 32 | ids[np.repeat(middle, m) + k % width], np.repeat(text, m)
    times = np.ones(len(links), np.int64)
    for g in np.flatnonzero(p * q > MANY).tolist():
        (u, cu), (v, cv) = (np.unique(ids[s:e], return_counts=True) for s, e in ((first[g], middle[g]), (middle[g], ends[g])))
        links, of = np.concatenate([links, (u[:, None] << 32 | v).ravel()]), np.concatenate([of, np.full(len(u) * len(v), text[g])])
        times = np.concatenate([times, (cu[:, None] * cv).ravel()])
    order = np.argsort(of, kind="stable")
    return links[order], times[order], np.bincount(of, minlength=len(texts))


def packed(values) -> bytes:
    """An array, or text as bytes, compressed, with its length in front. Of an array's numbers, mostly small ones, first all lowest bytes stand, then all second ones."""
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def array_of(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpacked(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def arrays_of(some: list, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(array_of(x, kind) for x in some)])


def segmented(docs: DataFrame, make, text: str) -> DataFrame:
    """(kind, block, i, segment, doc_id, codes): each document as the numbers of its segments in its block, and each block's distinct segments by number."""
    schema = "kind int, block long, i int, segment string, doc_id long, codes binary"

    names = ["kind", "block", "i", "segment", "doc_id", "codes"]

    def run(batches):
        cut, block = make().cut, TaskContext.get().partitionId() << 32
        known: dict[str, int] = {}
        size = 0

        def flush():
            segments = list(known)
            for s in range(0, len(segments), ROWS):
                some = segments[s : s + ROWS]
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, SEGMENT, np.int32)), pa.array(np.full(n, block)), pa.array(np.arange(s, s + n, dtype=np.int32)), pa.array(some, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names)

        for batch in batches:
            rows, held = [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = value.as_py() or ""
                rows.append((DOC, block, None, None, doc_id, packed(np.fromiter((known.setdefault(s, len(known)) for s in (cut(" " + raw) if raw else ())), np.int32))))
                size += len(raw)
                held += len(raw)
                full = size >= BLOCK_BYTES
                if full or held >= BLOCK_BYTES >> 2:
                    yield doc_rows(rows)
                    rows, held = [], 0
                if full:
                    yield from flush()
                    known.clear()
                    size, block = 0, block + 1
            if rows:
                yield doc_rows(rows)
        yield from flush()

    def doc_rows(rows):
        types = pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), quoted(text).alias("text")).mapInArrow(run, schema)


def aligned(segments: DataFrame, make) -> DataFrame:
    """(block, i, numbers, texts) from (segment, block, i): each distinct segment is encoded and aligned once, whatever blocks hold it.

    Rows come in the order of segments; what some batches have for one block leaves as one row of packed arrays.
    """
    names = ["block", "i", "numbers", "texts"]
    types = pa.int64(), *[pa.binary()] * 3

    def run(batches):
        both, last, held, n_held, known = make(), None, [], 0, 0

        def flush():
            blocks, i, of, numbers = (np.concatenate([h[k] for h in held]) for k in range(4))
            texts = [t for h in held for t in h[4]]
            order = np.argsort(blocks, kind="stable")
            bounds = np.flatnonzero(np.diff(blocks[order], prepend=blocks[order[0]] - 1)).tolist()
            rows = []
            for s, e in zip(bounds, [*bounds[1:], len(order)], strict=True):
                at = order[s:e]
                k = of[at]
                rows.append((int(blocks[at[0]]), packed(i[at]), packed(numbers[k]), packed("\n".join([texts[x] for x in k.tolist()]).encode())))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            distinct, of = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            new = distinct[1:] if last and distinct[0] == last[0] else distinct
            made = [last[1]] if new is not distinct else []
            made += [both.align(new[s : s + AT_ONCE]) for s in range(0, len(new), AT_ONCE)]
            numbers, texts = np.concatenate([m[0] for m in made]), [t for m in made for t in m[1]]
            last = distinct[-1], (numbers[-1:], texts[-1:])
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), of + known, numbers, texts))
            known, n_held = known + len(distinct), n_held + batch.num_rows
            if n_held >= ROWS:
                yield flush()
                held, n_held, known = [], 0, 0
        if held:
            yield flush()

    ordered = segments.repartition("segment").sortWithinPartitions("segment")
    return ordered.mapInArrow(run, "block long, i binary, numbers binary, texts binary")


RESULTS = ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups", "string")


DOC_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.string() if t == "string" else pa.int64()) for c, t in RESULTS), ("places", pa.binary()), ("numbers", pa.binary()), ("links", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))])


def compose(codes: pa.Table, parts: pa.Table, derive) -> pa.Table:
    """A block's documents from their segments: rows of kind DOC with their counts, groups and distinct links (as places in the block's list of
    links, and how often each is there), and one of kind SEGMENT with that list and the number of documents that hold each link."""
    block = (codes if codes.num_rows else parts)["block"][0].as_py()
    i, numbers = arrays_of(parts["i"].to_pylist(), np.int32), arrays_of(parts["numbers"].to_pylist(), np.int64).reshape(-1, 5)
    texts = [t for some in parts["texts"].to_pylist() for t in unpacked(some).decode().split("\n")]
    order = np.argsort(i)
    numbers, texts = numbers[order], [texts[k] for k in order.tolist()]
    links, times, sizes = links_of([t for t in texts if t])
    n = np.zeros(len(texts), np.int64)
    n[numbers[:, 4] > 0] = sizes
    distinct, of = np.unique(links, return_inverse=True)
    starts, holders, rows = np.cumsum(n) - n, np.zeros(len(distinct), np.int64), []
    for doc_id, value in zip(codes["doc_id"].to_pylist(), codes["codes"], strict=True):
        own = array_of(value.as_py(), np.int32)
        if not len(own) or not numbers[own, 4].all():
            rows.append((DOC, block, doc_id, 0, 0, 0, 0, None, packed(b""), packed(b""), None, None))
            continue
        once, many = np.unique(own, return_counts=True)
        size = n[once]
        at = np.repeat(starts[once] - np.cumsum(size) + size, size) + np.arange(size.sum())
        places, back = np.unique(of[at], return_inverse=True)
        total = np.bincount(back, weights=times[at] * np.repeat(many, size))
        holders[places] += 1
        rows.append((DOC, block, doc_id, *(many @ numbers[once, :4]).tolist(), derive(";".join(map(texts.__getitem__, own.tolist()))), packed(np.diff(places, prepend=0).astype(np.int32)), packed(total.astype(np.int64)), None, None))
    rows.append((SEGMENT, block, None, *[None] * len(RESULTS), None, None, distinct, holders))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), DOC_SCHEMA, strict=True)], schema=DOC_SCHEMA)


def valued(docs: pa.Table, links: pa.Table) -> pa.Table:
    """A block's documents with n_best and count_sum, from the counts of its links by place."""
    place = links["place"].to_numpy()
    count, best = (np.zeros(1 + int(place.max(initial=-1)), np.int64) for _ in range(2))
    count[place], best[place] = links["count"].to_numpy(), links["best"].to_numpy()
    out = []
    for places, times in zip(docs["places"], docs["numbers"], strict=True):
        p, t = np.cumsum(array_of(places.as_py(), np.int32)), array_of(times.as_py(), np.int64)
        out.append((int(best[p] @ t), int(count[p] @ t)))
    kept = docs.select(["doc_id", *(c for c, _ in RESULTS)])
    both = list(zip(*out, strict=True)) or [[], []]
    return kept.append_column("n_best", pa.array(both[0], pa.int64())).append_column("count_sum", pa.array(both[1], pa.int64()))


def same(groups: str) -> str:
    return groups


def align_tokens(docs: DataFrame, a_path: str, b_path: str, derive=same, text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) for each row of docs.

    A encodes a space and the text, B the text with the space that it adds. Where tokens of both end at one byte a group ends; groups are
    text such as `a1,a2|b1;a3|b2,b3`, passed through derive. A link is an occurrence of a token of A and one of B in one group; its count
    is the number of rows of docs that hold the two ids linked, n_best counts links that no other id of B exceeds for their id of A.
    Rows whose text is null, empty, or not what the tokens' bytes make have zeros and null groups (bytes are compared by segment, which is
    the same, as a token that is not true to its bytes is shorter than they are). Repeated rows count each; other columns are ignored.

    Documents are taken in blocks of about 12 MB, at least one document each, and become lists of numbers of distinct segments. A
    segment meets itself in other blocks by a shuffle, is encoded and aligned once there, and what a task has for a block goes back
    packed. A link meets itself once for each block in the same way, so no word or link is a hot key.
    """

    def make():
        return process_memo(f"align {a_path} {b_path}", lambda: Tokenizers(a_path, b_path))

    def composed(codes, parts):
        return compose(codes, parts, derive)

    spark = docs.sparkSession
    cut, cut_at = written(segmented(docs, make, text), "kind")
    parts, parts_at = written(aligned(cut.where(F.col("kind") == SEGMENT).select("segment", "block", "i"), make))
    discard(spark, f"{cut_at}/kind={SEGMENT}")
    codes = cut.where(F.col("kind") == DOC).select("block", "doc_id", "codes")
    results = ", ".join(f"{c} {t}" for c, t in RESULTS)
    schema = f"kind int, block long, doc_id long, {results}, places binary, numbers binary, links array<long>, holders array<long>"
    made, made_at = written(codes.groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(composed, schema), "kind")
    discard(spark, cut_at, parts_at)
    lists = made.where(F.col("kind") == SEGMENT).select("block", F.posexplode(F.arrays_zip("links", "holders")).alias("place", "x"))
    lists = lists.select("block", "place", F.col("x.links").alias("link"), F.col("x.holders").alias("n")).where("n > 0")
    counts = materialize(lists.groupBy("link").agg(F.sum("n").alias("count")))
    first = F.shiftright("link", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    known = counts.join(most, first == F.col("a")).select("link", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    links = lists.drop("n").join(known, "link").select("block", "place", "count", "best")
    left = spark.read.schema(made.schema).parquet(made_at).where(F.col("kind") == DOC).select("block", "doc_id", *(c for c, _ in RESULTS), "places", "numbers")
    return left.groupBy("block").cogroup(links.groupBy("block")).applyInArrow(valued, f"doc_id long, {results}, n_best long, count_sum long")


def digest(groups: str) -> str:
    return sha256(groups.encode()).hexdigest()
