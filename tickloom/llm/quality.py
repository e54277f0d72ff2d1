"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal, scored as sparse dot products."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import PLACES, U, as_struct, drop_memos, field, mix, quoted, text_slices, word_hashes

BITS = 18
#: At most about so many labelled rows are learnt from, in so many shards that are trained apart and averaged.
SAMPLE, SHARDS, EPOCHS = 16_000, 8, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.05
#: Fewer rows than this for each shard are trained in fewer shards.
SHARD_ROWS = 1000
#: Bytes of text whose features are made at once.
SLICE = 1 << 18
#: Classes of bytes in a word's shape: letters, digits, each sign for itself.
SHAPES = np.arange(256, dtype=np.uint8)
SHAPES[48:58] = 48
SHAPES[65:91] = 65
SHAPES[97:123] = 97
SHAPES[128:] = 97
SAME = (1, 2, 3, 4)


def features(data: np.ndarray, offs: np.ndarray):
    """(index, row): a word, a pair of words, a word's shape, a pair of shapes, and whether a word is that of some places before."""
    h, rows, s, e = word_hashes(data, offs, lower=False)
    n = np.diff(rows)
    row = np.repeat(np.arange(len(n)), n)
    if not len(h):
        return np.zeros(0, np.int64), row
    # A shape is the set of classes of its bytes and its length up to 12, so unseen words of one kind are alike.
    classes = SHAPES[data]
    ends = np.minimum(np.column_stack([s, e]).ravel(), len(data) - 1)
    inside = [np.add.reduceat((classes == c).astype(np.int32), ends)[::2] for c in (97, 65, 48)]
    if e[-1] == len(data):  # the last word's own end cannot be named
        inside = [np.append(x[:-1], np.count_nonzero(classes[s[-1] :] == c)) for x, c in zip(inside, (97, 65, 48), strict=True)]
    low, up, digit = inside
    sign = e - s - low - up - digit
    last = data[e - 1].astype(U) * ~np.isin(classes[e - 1], (97, 65, 48))
    kind = np.minimum(low, 1) + 2 * np.minimum(up, 2) + 8 * np.minimum(digit, 3) + 32 * np.minimum(sign, 3)
    with np.errstate(over="ignore"):
        shape = mix(kind.astype(U) * PLACES[5] + last * PLACES[6] + np.minimum(e - s, 12).astype(U))
        coarse = mix(kind.astype(U) * PLACES[7] + last)
        after = row[1:] == row[:-1]
        parts = [(h, row), (mix(h[1:] * PLACES[0] + h[:-1] * PLACES[1])[after], row[1:][after]), (shape, row), (mix(coarse[1:] * PLACES[2] + coarse[:-1] * PLACES[3])[after], row[1:][after])]
        for k in SAME:
            inside = row[k:] == row[:-k]
            same = (h[k:] == h[:-k])[inside]
            parts.append((mix(U(k) * PLACES[9] + same.astype(U)), row[k:][inside]))
    x, r = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    return (x & U((1 << BITS) - 1)).astype(np.int64), r


def weighted(x: np.ndarray, r: np.ndarray, n_rows: int):
    """(row bounds, index, value): each row's counts as square roots, scaled to length 1."""
    key, count = np.unique(r.astype(np.int64) << BITS | x, return_counts=True)
    row, value = key >> BITS, np.sqrt(count)
    norm = np.sqrt(np.bincount(row, count, n_rows))
    return np.searchsorted(row, np.arange(n_rows + 1)), key & ((1 << BITS) - 1), value / norm[row]


def ftrl(rows: list, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal (McMahan et al. 2013) over rows of (index, value, label, weight), one after another."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weight(i):
        zi = z[i]
        return -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2) * (np.abs(zi) > L1)

    for _ in range(epochs):
        for i, v, y, c in rows:
            w = weight(i)
            g = c * (1 / (1 + np.exp(-np.clip(w @ v, -30, 30))) - y) * v
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weight(np.arange(1 << BITS))


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """Weights learnt from about `sample` labelled rows at most, none held out; None if there are none.

    The rows are those of least hash of doc_id. Each of SHARDS tasks runs FTRL over its rows in a fixed order; the weights are averaged.
    Labels other than 0 and 1 and rows without a doc_id are not learnt from; null texts are empty; of repeated rows and rows of one
    doc_id each is learnt from with each of its labels; texts of any length are taken whole.
    """
    usable = labels.where(quoted(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), quoted(label).cast("int").alias("y"))
    many = usable.count()
    if not many:
        return None
    keep = 1 << 30 if many <= sample else (sample << 30) // many
    shards = max(1, min(SHARDS, min(many, sample) // SHARD_ROWS))
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    chosen = usable.where(hashed < keep).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text")).where(hashed < keep).join(chosen, "doc_id")

    def fit(batches):
        drop_memos()
        groups = {}
        for batch in batches:
            shard, ys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, j, data, offs in text_slices(batch.column(3), SLICE):
                bounds, x, v = weighted(*features(data, offs), j - i)
                for k in range(j - i):
                    a, b = bounds[k], bounds[k + 1]
                    groups.setdefault(int(shard[i + k]), []).append((int(ids[i + k]), x[a:b].astype(np.int32), v[a:b].astype(np.float32), int(ys[i + k])))
        for _, held in sorted(groups.items()):
            held.sort(key=lambda r: r[0] * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            good = sum(r[3] for r in held)
            scale = {1: 1.0, 0: min(4.0, max(1.0, good / max(1, len(held) - good)))}
            w = ftrl([(x, v.astype(np.float64), y, scale[y]) for _, x, v, y in held])
            i = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64()), pa.array([i.astype(np.int32)], pa.list_(pa.int32())), pa.array([w[i]], pa.list_(pa.float64()))], ["n", "i", "w"])

    total, count = np.zeros(1 << BITS), 0
    for r in rows.select("shard", "y", "doc_id", "text").repartition(shards, "shard").mapInArrow(fit, "n long, i array<int>, w array<double>").collect():  # SHARDS rows of 2**BITS numbers at most
        total[r.i] += np.array(r.w) * r.n
        count += r.n
    return total / max(count, 1)


def score(docs: DataFrame, weights: np.ndarray | None, text: str = "text", into: str = "score") -> DataFrame:
    """docs with one more column, the probability of label 1: 0.5 for empty or null texts, and throughout if nothing was learnt.

    Each row is scored by its whole text alone, so repeated rows score alike, and null ids and other columns make no difference. The
    name of the column must be a new one.
    """
    if into in docs.columns:
        raise ValueError(f"docs has a column {into} of its own: name another")
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        drop_memos()
        w = sent.value
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(1), SLICE):
                if w is None:
                    out = np.full(j - i, 0.5)
                else:
                    bounds, x, v = weighted(*features(data, offs), j - i)
                    dots = np.concatenate([[0.0], np.cumsum(w[x] * v)])
                    out = 1 / (1 + np.exp(-(dots[bounds[1:]] - dots[bounds[:-1]])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(out)], ["rest", "t", "score"])

    packed = docs.select(as_struct(docs, (text,)).alias("rest"), quoted(text).alias("t"))
    scored = packed.mapInArrow(run, StructType([*packed.schema.fields, StructField("score", DoubleType())]))
    return scored.select(*[(F.col("t") if c == text else field("rest", c)).alias(c) for c in docs.columns], F.col("score").alias(into))
