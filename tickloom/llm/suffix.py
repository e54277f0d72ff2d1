"""Repeated byte strings: a depth-limited radix sort of the suffixes, reached through minimisers so that only suffixes that may repeat are sorted."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACES, U, materialize, mix, powers, quoted, text_slices

#: Bytes of a k-gram that anchors windows.
GRAM = 32
#: Bytes of a digit of the radix sort.
DIGIT = 50
#: Contexts of one anchor that are sorted in one task; those of a more frequent anchor take the same passes as Spark group-bys.
GROUP = 16_384
POSITION_BITS = 24
#: Windows of a very long text whose anchors are found at once.
PIECE = 1 << 21


def prefix_hash(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U) + U(1)) * powers(len(data))[0][: len(data)], out=total[1:])
    return total


def span_hash(total: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes s to e, for many spans."""
    with np.errstate(over="ignore"):
        return mix((total[e] - total[s]) * powers(len(total))[1][s])


def windows_of(offs: np.ndarray, size: int) -> np.ndarray:
    """Starts of all windows that lie in one row."""
    n = np.maximum(np.diff(offs) - size + 1, 0)
    return np.arange(n.sum()) + np.repeat(offs[:-1] - (np.cumsum(n) - n), n)


def anchors_of(data: np.ndarray, offs: np.ndarray, size: int):
    """(row, anchor, first window, number of windows, anchor's hash, context's hash): the runs of windows that share a minimiser.

    A window's minimiser is its k-gram of the least hash, the first of equal ones, so equal windows have theirs at the same place.
    The context is all that these windows cover. A very long text goes in pieces that overlap, so a run may end between two of them.
    """
    if len(offs) == 2 and len(data) >= PIECE + size:
        parts = []
        for at in range(0, len(data) - size + 1, PIECE):
            own = data[at : at + PIECE + size - 1]
            row, a, s0, *others = anchors_of(own, np.array([0, len(own)]), size)
            parts.append((row, a + at, s0 + at, *others))
        return [np.concatenate([p[i] for p in parts]) for i in range(6)]
    s = windows_of(offs, size)
    if not len(s):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, U)] * 2
    total = prefix_hash(data)
    p = np.arange(len(data) - GRAM + 1)
    with np.errstate(over="ignore"):
        grams = mix((total[GRAM:] - total[: len(p)]) * powers(len(data))[1][: len(p)])
    bits = U(max(POSITION_BITS, int(len(data)).bit_length()))
    low = (grams >> bits << bits) | p.astype(U)
    width, least = size - GRAM + 1, 1
    while 2 * least <= width:
        low = np.minimum(low[: len(low) - least], low[least:])
        least *= 2
    low = np.minimum(low[: len(low) - (width - least)], low[width - least :]) if width > least else low
    at = (low[s] & ((U(1) << bits) - U(1))).astype(np.int64)
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(s)))
    s0, a = s[first], at[first]
    with np.errstate(over="ignore"):
        context = mix(span_hash(total, s0, s0 + n - 1 + size) + n.astype(U) * PLACES[0] + (a - s0).astype(U) * PLACES[1])
    return np.searchsorted(offs, s0, "right") - 1, a, s0, n, grams[a], context


def repeated_windows(data: np.ndarray, offs: np.ndarray, group: np.ndarray, size: int):
    """(starts of windows, whether each also occurs elsewhere in its group): radix passes by digits, most significant first.

    A suffix that stands alone after a pass is dropped, and none is read beyond size bytes; what is equal after the last pass repeats.
    """
    s = windows_of(offs, size)
    total = prefix_hash(data)
    rank = mix(group[np.searchsorted(offs, s, "right") - 1].astype(np.int64).view(U) + U(1))
    alive = np.arange(len(s))
    for at in range(0, size, DIGIT):
        if not len(alive):
            break
        t = s[alive] + at
        with np.errstate(over="ignore"):
            key = mix(rank[alive] * PLACES[0] + span_hash(total, t, t + min(DIGIT, size - at)))
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        alive = alive[order[twice]]
        rank[alive] = key[twice]
    out = np.zeros(len(s), bool)
    out[alive] = True
    return s, out


def batch_of(cols: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols.values()], list(cols))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def repeated_spans(docs: DataFrame, size: int = 200) -> DataFrame:
    """(did, th, s, e): byte ranges of docs(did, th, text) that repeated windows of size bytes cover; the ranges may overlap."""

    def find(batches):
        for batch in batches:
            for i, _, data, offs in text_slices(batch.column(2)):
                row, a, s0, n, gram, context = anchors_of(data, offs, size)
                take = pa.array(row + i)
                yield batch_of({"did": batch.column(0).take(take), "th": batch.column(1).take(take), "a": a - offs[row], "s": s0 - offs[row], "n": n, "gram": signed(gram), "context": signed(context)})

    def cut(batches):
        for batch in batches:
            texts = batch.column(2)
            own, s, n = (batch.column(i) for i in (3, 4, 5))
            for r in range(len(batch)):
                text, gram, start, count = memoryview(texts[r].as_buffer()), own[r].values, s[r].values, n[r].values
                parts = [bytes(text[x : x + c - 1 + size]) for x, c in zip(start.to_pylist(), count.to_pylist(), strict=True)]
                d = len(parts)
                yield batch_of({"did": pa.repeat(batch.column(0)[r], d), "th": pa.repeat(batch.column(1)[r], d), "gram": gram, "s": start, "hot": batch.column(6)[r].values, "known": batch.column(7)[r].values, "bytes": pa.array(parts, pa.binary())})

    def sort(batches):
        held, rows, last = [], 0, None

        def flush():
            nonlocal rows
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                rows = 0
                data, offs = whole(t.column("bytes").chunk(0))
                s, twice = repeated_windows(data, offs, t.column("gram").to_numpy(), size)
                twice &= ~t.column("known").to_numpy()[np.searchsorted(offs, s, "right") - 1]
                s = s[twice]
                row = np.searchsorted(offs, s, "right") - 1
                if len(s):
                    new = np.concatenate([[True], (row[1:] != row[:-1]) | (s[1:] > s[:-1] + size)])
                    a, z = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(s)) - 1
                    r = row[a]
                    at = t.column("s").to_numpy()[r] - offs[r]
                    yield batch_of({"did": t.column("did").to_numpy()[r], "th": t.column("th").to_numpy()[r], "s": s[a] + at, "e": s[z] + size + at})

        for batch in batches:
            gram = batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(gram)) + 1), len(gram)]
            start = 0
            for x in cuts[:-1]:  # a group stays together
                if rows + x - start >= GROUP and (x or gram[0] != last):
                    held.append(batch.slice(start, x - start))
                    yield from flush()
                    start = x
            held.append(batch.slice(start))
            rows += len(batch) - start
            last = gram[-1] if len(gram) else last
        yield from flush()

    depths = [*range(DIGIT, size, DIGIT), size]

    def spell(batches):
        for batch in batches:
            data, offs = whole(batch.column(6))
            s = windows_of(offs, size)
            row = np.searchsorted(offs, s, "right") - 1
            total, gram = prefix_hash(data), batch.column(2).to_numpy().view(U)[row]
            digits = {f"h{d}": signed(mix(span_hash(total, s, s + d) ^ gram)) for d in depths}
            take = pa.array(row)
            yield batch_of({"did": batch.column(0).take(take), "th": batch.column(1).take(take), "known": batch.column(5).take(take), "s": batch.column(3).to_numpy()[row] + s - offs[row], **digits})

    anchors = docs.mapInArrow(find, "did long, th long, a long, s long, n long, gram long, context long")
    # The first digit is the anchor. What is joined is written first, so that AQE can split the rows of a frequent one.
    common = materialize(anchors.select("gram").groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"))
    met = materialize(anchors.join(common, "gram").select("did", "th", "s", "n", "gram", "context"))
    contexts = met.groupBy("gram", "context").agg(F.count("*").alias("c"), F.min(F.struct("did", "th", "s", "n")).alias("one"))
    contexts = materialize(contexts)
    full = met.join(contexts.where("c > 1").select("gram", "context"), ["gram", "context"]).select("did", "th", "s", (F.col("s") + F.col("n") - 1 + size).alias("e"))
    varied = materialize(contexts.groupBy("gram").agg(F.count("*").alias("v")).where("v > 1"))
    asked = contexts.join(varied, "gram").select("one.*", "gram", (F.col("v") > GROUP).alias("hot"), (F.col("c") > 1).alias("known"))
    asked = asked.groupBy("did", "th").agg(*(F.collect_list(c).alias(c) for c in ("gram", "s", "n", "hot", "known")))
    pieces = docs.join(asked, ["did", "th"]).select("did", "th", F.col("text").cast("binary"), "gram", "s", "n", "hot", "known")
    pieces = materialize(pieces.mapInArrow(cut, "did long, th long, gram long, s long, hot boolean, known boolean, bytes binary"))
    cold = pieces.where("not hot").select("did", "th", "gram", "s", "known", "bytes").repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, "did long, th long, s long, e long")
    hot = pieces.where("hot").mapInArrow(spell, "did long, th long, known boolean, s long, " + ", ".join(f"h{d} long" for d in depths))
    for d in depths:  # what stands alone after a pass goes
        hot = materialize(hot)
        twice = materialize(hot.groupBy(f"h{d}").agg(F.count("*").alias("c")).where("c > 1").select(f"h{d}"))
        hot = hot.join(twice, f"h{d}").select("did", "th", "known", "s", *(f"h{e}" for e in depths if e > d))
    hot = hot.where("not known").select("did", "th", "s", (F.col("s") + size).alias("e"))
    return full.unionByName(cold).unionByName(hot)


def whole(col: pa.Array):
    """(bytes, offsets) of a binary column without nulls."""
    _, _, data, offs = next(text_slices(col, 1 << 62))
    return data, offs


def drop_repeats(docs: DataFrame, size: int = 200, text: str = "text") -> DataFrame:
    """(doc_id, text, n_bytes, n_removed, n_spans, kept) for each row of docs; kept is what is left, as bytes.

    Every byte that a string of size bytes covers which also starts anywhere else, in the same row or another, is removed; a
    repeated row is another place, with or without a doc_id. Null is an empty text; texts of any length are taken whole. Extra columns
    are ignored. Strings are compared by 64-bit hashes of 50-byte digits within groups that share a 32-byte string.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    keyed = keyed.select("*", F.coalesce("doc_id", F.lit(-1)).alias("did"), F.xxhash64("text").alias("th"))
    spans = repeated_spans(keyed.select("did", "th", "text"), size).groupBy("did", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    joined = keyed.join(spans, ["did", "th"], "left").select("doc_id", F.col("text").cast("binary"), F.col("spans.s").alias("s"), F.col("spans.e").alias("e"))

    def rebuild(batches):
        for batch in batches:
            ids, texts, starts, ends = batch.columns
            out = []
            for r in range(len(batch)):
                text = memoryview(texts[r].as_buffer())
                parts, removed, spans, at = [], 0, 0, 0
                if starts[r].is_valid:
                    s, e = starts[r].values.to_numpy(), ends[r].values.to_numpy()
                    order = np.argsort(s)
                    s, e = s[order], np.maximum.accumulate(e[order])
                    new = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                    for a, z in zip(s[new].tolist(), e[np.append(new[1:], len(s)) - 1].tolist(), strict=True):
                        parts.append(text[at:a])
                        removed, spans, at = removed + z - a, spans + 1, z
                parts.append(text[at:])
                out.append((len(text), removed, spans, b"".join(parts)))
                if sum(x[0] for x in out[-64:]) > 4 << 20 or len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([ids.slice(r + 1 - len(out), len(out)), *map(pa.array, zip(*out, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([ids.slice(len(batch) - len(out)), *map(pa.array, zip(*out, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(rebuild, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
