"""Near-duplicate vectors: each one's best filters of a product code, a join on filters, verification and counts by blocks."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, quoted

COSINE = 0.95
#: Filters of each vector at least, vectors of a filter on average, and blocks of the product code.
TIMES, BUCKET, PARTS = 20, 10, 3
#: Share of simulated pairs at the least cosine that must have a filter in common, and how many are simulated.
RECALL, PAIRS = 0.998, 4000
#: Members of a bucket that meet in one task; larger buckets are dealt out in pairs of blocks.
BLOCK = 256
SEED = 20_240_601


class Caps:
    """Filter directions c1 + c2 + c3 of a product code on three groups of coordinates of randomly turned vectors.

    Each vector takes the `times` filters that it scores best on, wherever it lies, so that no vector is left with few. The codes grow with
    the number of vectors, so that a filter holds about BUCKET of them, and `times` grows until RECALL of the simulated pairs at the least
    cosine share a filter. As vectors are turned at random, this depends on a pair's cosine alone, not on how the others are spread.
    """

    def __init__(self, dim: int, n: int, cosine: float = COSINE):
        rng = np.random.default_rng(SEED)
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.groups = [g for g in np.array_split(np.arange(dim), min(PARTS, dim)) if len(g)]
        share = min(0.25, BUCKET / max(n, 1))
        x, y = pairs_at(rng, PAIRS, dim, cosine)
        self.times = TIMES
        while True:
            k = max(4, math.ceil((self.times / share) ** (1 / len(self.groups))))
            codes = [rng.standard_normal((k, len(g))) for g in self.groups]
            # A group of one coordinate has two directions only.
            codes = [np.unique(c / np.linalg.norm(c, axis=1, keepdims=True), axis=0) / math.sqrt(len(codes)) for c in codes]
            self.codes = codes
            if self.times >= math.prod(map(len, codes)) or self.met(x, y).mean() >= RECALL:
                break
            self.times += 4

    def best(self, x: np.ndarray) -> np.ndarray:
        """The filters that each unit vector scores best on, one row each, in falling order; of equal ones the first."""
        y = x @ self.turn
        score, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for g, c in zip(self.groups, self.codes, strict=True):
            part = y[:, g] @ c.T
            order = np.argsort(-part, axis=1, kind="stable")[:, : self.times]
            part = np.take_along_axis(part, order, 1)
            # The a-th of one list and the b-th of the other have a * b - 1 sums before them that are no less.
            a, b = np.nonzero(np.outer(np.arange(1, score.shape[1] + 1), np.arange(1, part.shape[1] + 1)) <= self.times)
            score, code = score[:, a] + part[:, b], code[:, a] * len(c) + order[:, b]
            order = np.argsort(-score, axis=1, kind="stable")[:, : self.times]
            score, code = np.take_along_axis(score, order, 1), np.take_along_axis(code, order, 1)
        return code

    def met(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether x and y of each row share a filter."""
        both = np.sort(np.concatenate([self.best(x), self.best(y)], axis=1), axis=1)
        return (both[:, 1:] == both[:, :-1]).any(axis=1)


def pairs_at(rng, n: int, dim: int, cosine: float):
    """n random pairs of unit vectors at a cosine; of one dimension, equal ones."""
    x, y = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim == 1:
        return x, x
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * y


def unit(col: pa.Array, dim: int) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(vectors: DataFrame, column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors(vec_id, column); other columns are ignored.

    Vectors are linked at a cosine, in double precision, of `cosine` or more. Those that are null, empty, zero, or hold null or non-finite
    components link with nothing, and so do vectors of other lengths than the most frequent one with those of that length (each length
    is its own space). Rows without a vec_id link like others but are no component's name unless alone; repeated rows count apart.
    Equal vectors (by 128-bit hashes of their directions) are one class; classes meet in shared caps. A pair of a block is counted in the least of the caps that it shares.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.select(quoted(column)).dtypes[0][1] == "array<float>" else "array<double>"
    v = quoted(column).cast(kind)
    peak = F.array_max(F.transform(v, lambda x: F.abs(x)))
    sound = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (peak > 0)
    scaled = F.transform(v, lambda x: x / peak)
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(sound, v).alias("v"), F.when(sound, F.xxhash64(scaled)).alias("a"), F.when(sound, F.xxhash64(F.lit(1), scaled)).alias("b"))
    classes = keyed.where("a is not null").groupBy("a", "b").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    # A class has a number of its own, fixed when the table is written.
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), "*"))
    links = None
    for dim, n in [(r.d, r.n) for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()]:
        found = materialize(linked(classes.where(F.size("v") == dim), dim, n, cosine))
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = spark.createDataFrame([], "cid long, more long, other long")
    comp = connected_components(links.where("other is not null").select(F.col("cid").alias("src"), F.col("other").alias("dst")))
    totals = links.where("other is null").groupBy("cid").agg(F.sum("more").alias("more"))
    named = classes.select("cid", "a", "b", "copies", "least").join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_class = materialize(named.join(names, "comp").join(totals, "cid", "left").select("a", "b", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = keyed.select("vec_id", "a", "b").join(per_class, ["a", "b"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))


def linked(classes: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    """(cid, more, null): links found in a block from the class's vector to vectors of others; (cid, null, other): a forest of the links."""
    caps = classes.sparkSession.sparkContext.broadcast(Caps(dim, n, cosine))

    def filters(batches):
        for batch in batches:
            for s in range(0, len(batch), 128):
                part = batch.slice(s, 128)
                code = caps.value.best(unit(part.column(1), dim))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(code) + 1, dtype=np.int32) * code.shape[1]), pa.array(code.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["cid", "v", "copies", "codes"])

    coded = materialize(classes.select("cid", "v", "copies").mapInArrow(filters, f"cid long, v {classes.schema['v'].dataType.simpleString()}, copies long, codes array<long>"))
    met = coded.select("cid", F.explode("codes").alias("code"))
    sizes = met.groupBy("code").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    # A member of block b meets the blocks before it and after it, each pair of blocks in one task.
    ones = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    dealt = met.join(sizes, "code").select("cid", "code", blocks.alias("blocks"), own.alias("own")).select("cid", "code", "own", F.explode(ones).alias("p")).select("cid", "code", "own", "p.i", "p.j")
    full = dealt.join(coded, "cid").select("code", "i", "j", "own", "cid", "copies", "v", "codes")
    return full.repartition("code", "i", "j").sortWithinPartitions("code", "i", "j").mapInArrow(block_links(dim, cosine), "cid long, more long, other long")


def block_links(dim: int, cosine: float):
    def of_block(code, i, j, own, cid, copies, v, codes):
        order = np.lexsort((cid, own))
        own, cid, copies, v, codes = own[order], cid[order], copies[order], v[order], [codes[o] for o in order]
        m = len(cid)
        dots = v @ v.T
        near = dots >= cosine
        # Sums in another order may differ in the last digit: pairs at the edge are decided on exact sums.
        edge = np.argwhere(np.triu(np.abs(dots - cosine) < 1e-12, 1))
        for a, b in edge:
            near[a, b] = near[b, a] = math.fsum(v[a] * v[b]) >= cosine
        np.fill_diagonal(near, False)
        if i != j:
            near &= own[:, None] != own[None, :]
        if not near.any():
            return None
        below = [c[c < code] for c in codes]
        names, at = np.unique(np.concatenate(below), return_inverse=True) if any(len(b) for b in below) else (np.zeros(0), np.zeros(0, np.int64))
        first = near
        if len(names):
            member = np.zeros((m, len(names)), np.float32)
            member[np.repeat(np.arange(m), [len(b) for b in below]), at] = 1
            first = near & (member @ member.T == 0)
        more = (first * copies[None, :]).sum(axis=1)
        label = np.arange(m)
        while True:
            low = np.minimum(label, np.where(near, label[None, :], m).min(axis=1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        return cid, more, cid[label]

    def run(batches):
        held, key = [], None

        def flush():
            if held:
                cols = [np.concatenate([h[c] for h in held]) for c in range(4)]
                out = of_block(*key, *cols[:3], cols[3], [c for h in held for c in h[4]])
                held.clear()
                if out:
                    cid, more, other = out
                    some, tied = more > 0, other != cid
                    none = lambda k: pa.nulls(k, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([cid[some], cid[tied]])), pa.concat_arrays([pa.array(more[some]), none(int(tied.sum()))]), pa.concat_arrays([none(int(some.sum())), pa.array(other[tied])])], ["cid", "more", "other"]
                    )

        for batch in batches:
            code, i, j, own, cid, copies = (batch.column(c).to_numpy() for c in range(6))
            v, codes = unit(batch.column(6), dim), [c.values.to_numpy() for c in batch.column(7)]
            new = np.flatnonzero((np.diff(code) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for s, e in zip([0, *new], [*new, len(code)], strict=True):
                if s == e:
                    continue
                if key != (code[s], i[s], j[s]):
                    yield from flush()
                    key = (code[s], i[s], j[s])
                held.append((own[s:e], cid[s:e], copies[s:e], v[s:e], codes[s:e]))
        yield from flush()

    return run
