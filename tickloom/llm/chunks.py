"""Encoding and decoding with reuse of content-defined chunks: a chunk that repeats is encoded once, joins are encoded anew."""

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard
from .common import U, bloom_filter, drop_memos, materialize, may_hold, powers, process_memo, quoted, text_slices, written

#: Bytes under the rolling hash; a chunk has about MEAN bytes, LEAST at least.
ROLL, MEAN, LEAST = 16, 1024, 256
#: Words in a worker's memo, and the longest that is kept; chunks that a task remembers to have sent.
MEMO_WORDS, MEMO_BYTES, SENT = 200_000, 64, 50_000
#: Kinds of rows of the first pass: a text that is done, a part of a text, and a chunk to encode.
DONE, PART, CHUNK = 0, 1, 2


def chunk_cuts(data: np.ndarray, offs: np.ndarray) -> list:
    """For each row, the places where a chunk starts or ends, relative to the row: where the hash of the last ROLL bytes ends in zeros."""
    at = np.zeros(0, np.int64)
    if len(data) > ROLL:
        total = np.zeros(len(data) + 1, U)
        with np.errstate(over="ignore"):
            up, down = powers(len(data), 1 << 19)
            np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
            h = (total[ROLL:] - total[:-ROLL]) * down[: len(total) - ROLL]
            h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
        at = np.flatnonzero(h >> U(32) & U(MEAN - 1) == 0) + ROLL
        at = at[at < len(data)]
        at = at[(data[at] & 0xC0) != 0x80]
    low, high = np.searchsorted(at, offs[:-1] + ROLL), np.searchsorted(at, offs[1:])
    out = []
    for s, e, i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), low.tolist(), high.tolist(), strict=True):
        found = [0]
        for x in at[i:j].tolist():
            if x - s - found[-1] >= LEAST:
                found.append(x - s)
        out.append([*found, e - s])
    return out


class WordBpe:
    """The library's ids for words between white space, as little-endian 16- or 32-bit numbers, through a memo of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.code = "H" if self.tok.get_vocab_size() <= 1 << 16 else "I"
        with open(path, encoding="utf-8") as f:
            self.joined = json.load(f)["decoder"] is None
        n = 1 + max(self.tok.get_vocab().values())
        self.digits = [str(i) for i in range(n)]
        self.tokens = [self.tok.id_to_token(i) or "" for i in range(n)]
        self.memo: dict[bytes, bytes] = {}

    def learn(self, data: bytes) -> None:
        """Encode all words of data that the memo lacks in one call."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = [w for w in set(data.split()).difference(self.memo) if len(w) <= MEMO_BYTES]
        for i in range(0, len(new), 2000):  # the library's encodings are large
            some = new[i : i + 2000]
            for w, e in zip(some, self.tok.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                self.memo[w] = array(self.code, e.ids).tobytes()

    def word(self, w: bytes) -> bytes:
        return self.memo.get(w) or array(self.code, self.tok.encode(w.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, data: bytes) -> bytes:
        words = data.split()
        try:
            return b"".join(map(self.memo.__getitem__, words))
        except KeyError:
            return b"".join(map(self.word, words))

    def ids(self, code: bytes) -> list:
        return np.frombuffer(code, "<u2" if self.code == "H" else "<u4").tolist()

    def decode(self, ids: list) -> str:
        """As the library's decode(ids, skip_special_tokens=False)."""
        return " ".join(map(self.tokens.__getitem__, ids)) if self.joined else self.tok.decode(ids, skip_special_tokens=False)


def edges(data: bytes) -> tuple | None:
    """(where the first white space is, where the last one ends); None for bytes without white space."""
    first = len(data.split(None, 1)[0]) if data and not data[:1].isspace() else 0
    if first == len(data):
        return None
    return first, len(data) if data[-1:].isspace() else len(data) - len(data.rsplit(None, 1)[-1])


def part_of(bpe: WordBpe, data: bytes) -> tuple:
    """(head, code, tail): the words that the part's ends may cut through, as bytes, and the codes of all words between; code is None
    where there is no white space, and head is all."""
    at = edges(data)
    return (data, None, b"") if at is None else (data[: at[0]], bpe.encode(data[at[0] : at[1]]), data[at[1] :])


def assemble(bpe: WordBpe, parts) -> bytes:
    """The codes of a text from its parts (head, code, tail): what two parts' ends make together is encoded anew, which is exact, as
    no token reaches over white space."""
    out, tail = [], b""
    for head, code, last in parts:
        if code is None:
            tail += head
            continue
        if tail or head:
            out.append(bpe.word(tail + head))
        out.append(code)
        tail = last
    if tail:
        out.append(bpe.word(tail))
    return b"".join(out)


def chunk_hashes(raw: bytes, start: int, cut: list) -> np.ndarray:
    """The 128-bit hashes of a row's chunks, one row each."""
    digests = b"".join([xxhash.xxh3_128_digest(raw[start + a : start + z]) for a, z in zip(cut[:-1], cut[1:], strict=True)])
    return np.frombuffer(digests, U).reshape(-1, 2)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(a, b) of every chunk that stands in more than one place of docs(did, text)."""

    def run(batches):
        drop_memos()
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0), 1 << 18):
                raw = data.tobytes()
                found = [chunk_hashes(raw, s, cut) for s, cut in zip(offs[:-1].tolist(), chunk_cuts(data, offs), strict=True)]
                h, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].view(np.int64)), pa.array(n)], ["a", "b", "n"])

    return docs.select("text").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 1").select("a", "b")


def ids_and_text(ids: list, bpe: WordBpe) -> tuple:
    return ids, bpe.decode(ids)


def encode_decode(docs: DataFrame, path: str, derive=ids_and_text, columns=(("ids", "array<int>"), ("decoded", "string")), text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, <columns>) for each row of docs: the library's ids of the text and what they decode to.

    Texts are cut where a rolling hash of their bytes says so, so equal passages give equal chunks. Chunks are counted over all texts.
    In a second pass texts without repeated chunks are encoded; of the others, what stands between repeated chunks. Each repeated chunk
    is sent on once by a task, encoded once in all, and its code joins its places by hash; then the parts of a text meet, and the
    words that cuts run through are encoded. Chunks are compared by 128-bit hashes. Null is an empty text, without tokens. Texts of any
    length are taken whole; repeated rows, null ids and other columns make no difference. derive(ids, bpe) gives the columns' values.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("did"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    repeated, folder = written(repeated_chunks(keyed))
    filter_bits = docs.sparkSession.sparkContext.broadcast(bloom_filter(repeated, "a"))
    discard(docs.sparkSession, folder)
    arrow = {"array<int>": pa.list_(pa.int32()), "string": pa.string()}
    types = [pa.int64(), *(arrow[k] for _, k in columns)]
    results = "n_tokens long, " + ", ".join(f"{c} {k}" for c, k in columns)
    place = "kind int, rid long, did long, i int, a long, b long, head binary, code binary, tail binary, "
    fields = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), *types]
    names = [*(f.split()[0] for f in place.rstrip(", ").split(", ")), "n_tokens", *(c for c, _ in columns)]
    blank = (None,) * len(types)

    def finish(bpe, code):
        ids = bpe.ids(code)
        return len(ids), *derive(ids, bpe)

    def first_pass(batches):
        bpe, sent = process_memo(f"words {path}", lambda: WordBpe(path)), set()
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(2), 1 << 19):
                raw, texts, rows = data.tobytes(), [], []
                for rid, did, s, cut in zip(batch.column(0).slice(i, j - i).to_pylist(), batch.column(1).slice(i, j - i).to_pylist(), offs[:-1].tolist(), chunk_cuts(data, offs), strict=True):
                    h = chunk_hashes(raw, s, cut)
                    own, at = [], s
                    for k in np.flatnonzero(may_hold(filter_bits.value, h[:, 0])).tolist():
                        chunk = raw[s + cut[k] : s + cut[k + 1]]
                        if edges(chunk):  # one without white space has no code of its own
                            own += [(None, at, s + cut[k]), (k, s + cut[k], s + cut[k + 1])]
                            at = s + cut[k + 1]
                    texts.append((rid, did, h, [p for p in [*own, (None, at, s + cut[-1])] if p[2] > p[1]]))
                bpe.learn(b"\n".join([raw[a:z] for *_, parts in texts for k, a, z in parts if k is None]))
                for rid, did, h, parts in texts:
                    if all(k is None for k, _, _ in parts):
                        rows.append((DONE, rid, did, None, None, None, None, None, None, *finish(bpe, bpe.encode(raw[parts[0][1] : parts[0][2]] if parts else b""))))
                        continue
                    for n, (k, a, z) in enumerate(parts):
                        if k is None:
                            rows.append((PART, rid, did, n, None, None, *part_of(bpe, raw[a:z]), *blank))
                            continue
                        key = tuple(h[k].view(np.int64).tolist())
                        rows.append((PART, rid, did, n, *key, None, None, None, *blank))
                        if key not in sent:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent.add(key)
                            rows.append((CHUNK, None, None, None, *key, None, raw[a:z], None, *blank))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), fields, strict=True)], names)

    def encode_once(batches):
        bpe, last = process_memo(f"words {path}", lambda: WordBpe(path)), None
        for batch in batches:
            keys, chunks, rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), batch.column(2), []
            new = [k for k in range(len(keys)) if keys[k] != (keys[k - 1] if k else last)]
            last = keys[-1] if keys else last
            bpe.learn(b"\n".join([chunks[k].as_py() for k in new]))
            rows = [(*keys[k], *part_of(bpe, chunks[k].as_py())) for k in new]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), fields[4:9], strict=True)], ["a", "b", "head", "code", "tail"])

    def join_parts(batches):
        bpe, held, of = process_memo(f"words {path}", lambda: WordBpe(path)), [], None
        for batch in batches:
            rows = []
            for rid, did, *part in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if of and of[0] != rid:
                    rows.append((of[1], *finish(bpe, assemble(bpe, held))))
                    held = []
                of = rid, did
                held.append(part)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), *types], strict=True)], ["doc_id", *names[9:]])
        if of:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((of[1], *finish(bpe, assemble(bpe, held))), [pa.int64(), *types], strict=True)], ["doc_id", *names[9:]])

    passed = materialize(keyed.select(F.monotonically_increasing_id().alias("rid"), "did", "text").mapInArrow(first_pass, place + results))
    chunks = passed.where(F.col("kind") == CHUNK).select("a", "b", F.col("code").alias("chunk"))
    codes = materialize(chunks.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(encode_once, "a long, b long, head binary, code binary, tail binary"))
    parts = passed.where(F.col("kind") == PART).select("rid", "did", "i", "a", "b", "head", "code", "tail")
    known = parts.where("a is not null").select("rid", "did", "i", "a", "b").join(codes, ["a", "b"]).select("rid", "did", "i", "head", "code", "tail")
    both = parts.where("a is null").drop("a", "b").unionByName(known).repartition("rid").sortWithinPartitions("rid", "i")
    joined = both.select("rid", "did", "head", "code", "tail").mapInArrow(join_parts, "doc_id long, " + results)
    done = passed.where(F.col("kind") == DONE).select(F.col("did").alias("doc_id"), *names[9:])
    return done.unionByName(joined)
