"""Best-fit packing: planned on the histogram of piece lengths; pieces then take planned slots by their rank within their length."""

import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, process_memo, quoted

SIZE, END = 1024, 2
#: Pieces kept in a worker's memo, and the longest that is kept.
MEMO_PIECES, MEMO_CHARS = 250_000, 64
#: Before a blank or newline that a solid character follows, the byte-level split pattern always ends a piece.
CUT = re.compile(r"(?=[ \n]\S)")
#: In texts of characters below this one both libraries split alike, whatever their Unicode versions.
PLAIN = "ɐ"


class ByteBpe:
    """The ids of the tokenizers library for a byte-level BPE file, as little-endian 32-bit numbers, through a memo of space-led pieces.

    Pieces that the memo lacks are merged by tiktoken with the file's own merges, which is faster for single words; texts with the
    strings of added tokens, and pieces with characters beyond Latin, go to tokenizers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [a["content"] for a in spec["added_tokens"]]
        shown = sorted(pre_tokenizers.ByteLevel.alphabet())
        odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        byte = {c: ord(c) if ord(c) < 256 else odd[ord(c) - 256] for c in shown}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo: dict[str, bytes] = {}

    def exact(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return self.exact(text)
        memo, out = self.memo, []
        for piece in CUT.split(text):
            code = memo.get(piece)
            if code is None:
                code = array("I", self.plain(piece)).tobytes() if piece.isascii() or piece and max(piece) < PLAIN else self.exact(piece)
                if len(piece) <= MEMO_CHARS:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[piece] = code
            out.append(code)
        return b"".join(out)


def cuts(n: int, size: int) -> list:
    """(start, length) of the pieces of n tokens; all but the first have the full size."""
    first = n if n <= size else n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def all_ids(ids: np.ndarray) -> list:
    return ids.tolist()


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_pieces(docs: DataFrame, path: str, size: int, end: int, payload, text: str) -> DataFrame:
    """(doc_id, piece, start, length, payload, part, place): place counts the pieces of one length in one task, which part names."""
    derive, name, kind = payload
    schema = f"doc_id long, piece int, start long, length long, {name} {kind}, part int, place long"
    arrow = pa.list_(pa.int32()) if kind == "array<int>" else pa.int64()

    def run(batches):
        bpe = process_memo(f"bytes {path}", lambda: ByteBpe(path))
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, held = [], 0

            def flush(rows):
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), arrow, pa.int32(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", name, "part", "place"])

            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(bpe.ids(value.as_py() or "") + tail, "<u4")
                for i, (s, n) in enumerate(cuts(len(ids), size)):
                    rows.append((doc_id, i, s, n, derive(ids[s : s + n]), part, int(seen[n])))
                    seen[n] += 1
                    held += n
                if held > 500_000 or len(rows) > 20_000:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), quoted(text).alias("text")).mapInArrow(run, schema)


def plan(counts: dict, size: int) -> list:
    """(length, first rank, pieces, first sequence, offset), best fit in order of falling length.

    Sequences are kept as ranges by the room that is left, so the work and the rows depend on the lengths and not on their counts.
    """
    room: dict[int, list] = {}
    out, used = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fits = [r for r in room if r >= length]
            if not fits:
                new = -(-left // (size // length))
                room[size] = [(used, new)]
                used += new
                continue
            best = min(fits)
            first, n = room[best].pop()
            take = min(n, left)
            if take < n:
                room[best].append((first + take, n - take))
            if not room[best]:
                del room[best]
            out.append((length, rank, take, first, size - best))
            if best > length:
                room.setdefault(best - length, []).append((first, take))
            rank, left = rank + take, left - take
    return out


def best_fit_pack(docs: DataFrame, path: str, size: int = SIZE, end: int = END, payload=(all_ids, "ids", "array<int>"), text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, <payload>, sequence_id, offset) for each piece of each row of docs.

    A row's tokens are its ids and end; those of more than size tokens are cut into pieces of size, the first being shorter where it must.
    Null or empty texts are the end token alone. Repeated rows and rows without a doc_id are packed each for itself; an empty table
    gives no rows; other columns are ignored. Ties between pieces of one length do not matter. payload: (function of a piece's ids, name, type).
    """
    pieces = materialize(token_pieces(docs, path, size, end, payload, text))
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length, size at most
    slots = np.array(sorted(plan(total, size)), np.int64).reshape(-1, 5)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    based = pieces.join(counts.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = based.select("doc_id", "piece", "start", "length", payload[1], (F.col("before") + F.col("place")).alias("rank"))

    def place(batches):
        keys = (slots[:, 0] << 44) + slots[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = slots[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4].copy())], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"doc_id long, piece int, start long, length long, {payload[1]} {payload[2]}, sequence_id long, offset long")
