"""Shared pieces: scratch tables, connected components, and vectorised words and shingles over Arrow text columns."""

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import discard, scratch_dir

WORD_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE_BYTES = 2 << 20
U = np.uint64


#: Delete a job's shuffle files when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Settings of the session for the jobs run inside; dots in names are given as double underscores."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, *by: str) -> tuple[DataFrame, str]:
    """(df as read again from Parquet in the shared scratch folder, the path), which cuts the lineage; in folders of `by`, if given."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    with session_conf(spark, **{CLEANUP.replace(".", "__"): "true"}):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, *by: str) -> DataFrame:
    return written(df, *by)[0]


def quoted(name: str) -> Column:
    """The column of that very name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_struct(df: DataFrame, without: tuple = ()) -> Column:
    """All columns of df but some as one struct, so that their names clash with none."""
    return F.struct(*([quoted(c) for c in df.columns if c not in without] or [F.lit(1).alias("_")]))


def field(struct: str, name: str) -> Column:
    return F.col(struct).getField(name)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges(src, dst): comp is the smallest node reachable.

    Alternating large-star and small-star steps until every component is a star around its smallest node. The least neighbours are
    written before they are joined: then both sides of the join are plain shuffles, and AQE splits the edges of a hub. Tables of earlier
    rounds are deleted.
    """
    spark, old = edges.sparkSession, []

    def keep(df: DataFrame) -> DataFrame:
        df, path = written(df)
        old.append(path)
        return df

    def oriented(e: DataFrame) -> DataFrame:
        return e.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()

    def is_stars(e: DataFrame) -> bool:
        chained = e.join(e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src")
        forked = e.groupBy("src").agg(F.count("*").alias("n")).where("n > 1").select("src")
        return not chained.union(forked).limit(1).count()

    e = keep(oriented(edges))
    while not is_stars(e):
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = keep(both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m")))
        large = keep(oriented(both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))))
        least = keep(large.groupBy("src").agg(F.min("dst").alias("m")))
        small = large.join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        e = keep(oriented(small.union(least.select("src", F.col("m").alias("dst")))))
        discard(spark, *old[:-1])
        del old[:-1]
    return e.select(F.col("src").alias("node"), F.col("dst").alias("comp")).union(e.select(F.col("dst").alias("node"), F.col("dst").alias("comp")).distinct())


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int, least: int = SLICE_BYTES + (SLICE_BYTES >> 2)) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i up to n at least."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, least)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _powers[name] = np.cumprod(np.concatenate([np.ones(1, U), np.full(size, b, U)]))
    return _powers["up"], _powers["down"]


def text_slices(col: pa.Array, max_bytes: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets of each row and the end) of a string column, nulls as empty; a slice has about max_bytes, one row at least."""
    col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"").cast(pa.large_binary())
    if not len(col):
        return
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


SPACE_LUT = np.zeros(256, bool)
SPACE_LUT[list(WORD_SPACE)] = True
LOWER_LUT = np.arange(256, dtype=np.uint8)
LOWER_LUT[65:91] += 32


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = True):
    """(hash of each word, first word of each row and the end, start byte, end byte); words are [^\\x20\\x09-\\x0D]+, by A-Z lower-cased.

    Worked through in pieces that end between words, so that a very long text needs no more than its own words and a piece's room.
    """
    n, at, parts = len(data), 0, []
    while at < n:
        to = min(at + SLICE_BYTES, n)
        row_end = int(offs[np.searchsorted(offs, to)]) if to < n else n
        while to < row_end:  # to the next white space, or to the row's end
            gap = np.flatnonzero(SPACE_LUT[data[to : min(to + 4096, row_end)]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(to + 4096, row_end)
        inside = offs[np.searchsorted(offs, at, "right") : np.searchsorted(offs, to)]
        h, s, e = _piece_hashes(data[at:to], inside - at, lower)
        parts.append((h, s + at, e + at))
        at = to
    if not parts:
        return np.zeros(0, U), np.zeros(len(offs), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, s, e = (np.concatenate([p[i] for p in parts]) for i in range(3)) if len(parts) > 1 else parts[0]
    return h, np.searchsorted(s, offs), s, e


def _piece_hashes(data: np.ndarray, cuts: np.ndarray, lower: bool):
    """(hash, start, end) of the words of a piece, cut at `cuts` as well."""
    solid = ~SPACE_LUT[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[cuts] = solid[cuts]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cuts - 1] = solid[cuts - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U)
        np.cumsum(((LOWER_LUT[data] if lower else data).astype(U) + U(1)) * up[: len(data)], out=total[1:])
        return mix((total[e] - total[s]) * down[s] + (e - s).astype(U)), s, e


#: Odd multipliers, one for each place in a shingle.
PLACES = (np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.uint64) << U(1)) | U(1)


def shingle_hashes(h: np.ndarray, rows: np.ndarray, k: int):
    """(hash, row) of every k-word shingle; a row of fewer words has its whole sequence as one; a row without words has none."""
    counts = np.diff(rows)
    n = len(h)
    with np.errstate(over="ignore"):
        total = np.zeros(max(n - k + 1, 0), U)
        for j in range(k):
            total += h[j : n - k + 1 + j] * PLACES[j] if n >= k else total
        row_of = np.repeat(np.arange(len(counts)), np.maximum(counts - k + 1, 0))
        lengths = np.maximum(counts - k + 1, 0)
        at = np.arange(len(row_of)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(rows[:-1], lengths)
        out = mix(total[at])
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            tail = np.array([sum(int(h[rows[r] + j]) * int(PLACES[j]) for j in range(counts[r])) + 0x51ED * int(counts[r]) & (1 << 64) - 1 for r in short], U)
            out, row_of = np.concatenate([out, mix(tail + U(BASE))]), np.concatenate([row_of, short])
            order = np.argsort(row_of, kind="stable")
            out, row_of = out[order], row_of[order]
    return out, row_of


def distinct_in_rows(x: np.ndarray, row_of: np.ndarray, n_rows: int):
    """Distinct values of each row, sorted: (values, bounds of each row)."""
    bounds = np.searchsorted(row_of, np.arange(n_rows + 1))
    parts = [np.unique(x[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


#: Bits for each key of a filter that is broadcast, its most bits, and its hashes; what passes it must be confirmed by a join.
FILTER_BITS, MOST_BITS, HASHES = 16, 1 << 28, 3


def bloom_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of hashes, as words of 64 bits; its words are made on the executors. It has MOST_BITS at most, so its size is bounded."""
    size = min(MOST_BITS, 1 << max(16, (FILTER_BITS * keys.count()).bit_length()))
    at = keys.select(F.explode(F.array(*[F.shiftrightunsigned(column, 18 * j + 1).bitwiseAND(F.lit(size - 1)) for j in range(HASHES)])).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether hashes may be among the filter's keys."""
    ok = np.ones(len(h), bool)
    for j in range(HASHES):
        at = (h >> U(18 * j + 1)) & U(len(bits) * 64 - 1)
        ok &= (bits[at >> U(6)] >> (at & U(63))) & U(1) > 0
    return ok


#: Things that a worker keeps at once; a further one takes the place of the oldest.
KEPT = 2


def _memo() -> dict:
    """One dict for each Python process. This package travels with the tasks by value, so its own globals are new in each of them; sys.modules is not."""
    import sys
    from types import ModuleType

    return sys.modules.setdefault("_tickloom_worker", ModuleType("_tickloom_worker")).__dict__.setdefault("memo", {})


def process_memo(name: str, make):
    """What make() gave at the first call in this Python worker; later tasks of the worker find it again."""
    memo = _memo()
    if name not in memo:
        while len(memo) >= KEPT:
            del memo[next(iter(memo))]
        memo[name] = make()
    return memo[name]


def drop_memos() -> None:
    """Free what earlier tasks of this Python worker kept, before work that needs room of its own."""
    _memo().clear()
