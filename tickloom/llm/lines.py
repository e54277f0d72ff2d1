"""Line dedup: levelled sorted runs of line hashes, compacted as they grow in number, and a merge anti-join that drops lines."""

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import discard, scratch_dir
from .common import as_struct, materialize, quoted, session_conf

STRIPPED = b" \t\n\x0b\x0c\r"
#: Stands for a null doc_id: below every id that a document may have.
NO_ID = -(1 << 63)
MIN_CHARS, MIN_DOCS = 20, 3
#: Batches into which a table is dealt, at least and at most, lines from which on it is dealt into more, and runs of one level that are compacted to one of the next.
BATCHES, MOST_BATCHES, BATCH_LINES, FAN_IN = 4, 64, 50_000_000, 2
#: Let joins use that a bucket of one file is sorted; the tables' order and size change nothing else.
SORTED_BUCKETS = {"spark__sql__legacy__bucketedTableScan__outputOrdering": "true", "spark__sql__sources__bucketing__autoBucketedScan__enabled": "false"}


def key_of(line: bytes) -> bytes:
    """The line stripped of white space at both ends, with A-Z lower-cased."""
    return line.strip(STRIPPED).lower()


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(did, th, i, a, b): the 128-bit hash of each line's key of min_chars code points or more, i the line's place in docs(did, th, text)."""

    def run(batches):
        for batch in batches:
            texts, out = batch.column(2), []
            for r in range(len(batch)):
                for i, line in enumerate(bytes(texts[r].as_buffer()).split(b"\n")):
                    key = key_of(line)
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                        out.append((r, i, xxhash.xxh3_128_digest(key)))
                if len(out) >= 50_000 or r == len(batch) - 1 and out:
                    row, place, digests = zip(*out, strict=True)
                    h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    take = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(place, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], ["did", "th", "i", "a", "b"])
                    out = []

    return docs.select("did", "th", F.col("text").cast("binary")).mapInArrow(run, "did long, th long, i int, a long, b long")


class LineRuns:
    """Runs of (a, b, n, top): a line's hash, the documents that hold it, the largest doc_id among them.

    Each run is a table in buckets of the hash, each bucket one sorted file, so that a batch, once dealt and sorted, is merge-anti-joined
    with all runs without a further shuffle or sort. ingest() anti-joins a batch with every run: lines that none holds make a run of level 0; the
    others' counts are added beside the runs, so that each hash is in one run only. Where a level has fan_in runs, they are compacted
    to one of the next level, so that n batches leave about log(n) runs; counts beside them are summed up as soon as there are fan_in
    tables of them, so that they hold a line once or twice. The documents of a batch must be in no other.
    """

    COLUMNS = "a long, b long, n long, top long"

    def __init__(self, spark: SparkSession, path: str | None = None, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.path, self.fan_in, self.levels, self.again, self.made = spark, path or scratch_dir(spark), fan_in, [], [], 0
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "tickloom_lines_" + uuid.uuid4().hex

    def _write(self, rows: DataFrame) -> str:
        """rows(a, b, n, top), dealt by hash already, as a bucketed table; its name."""
        name, self.made = f"{self.name}_{self.made}", self.made + 1
        with session_conf(self.spark, **SORTED_BUCKETS):
            rows.write.bucketBy(self.buckets, "a", "b").sortBy("a", "b").option("path", f"{self.path}/{name}").format("parquet").saveAsTable(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            discard(self.spark, f"{self.path}/{name}")

    def _union(self, names: list) -> DataFrame:
        """The rows of tables, read as plain files: Spark 4.1 takes a union of bucketed scans for bucketed, but does not align the buckets."""
        both = self.spark.createDataFrame([], self.COLUMNS)
        return self.spark.read.schema(self.COLUMNS).parquet(*[f"{self.path}/{n}" for n in names]) if names else both

    def _merge(self, names: list) -> DataFrame:
        return self._union(names).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def held(self) -> DataFrame:
        """(a, b, n, top) of each line, as counted in the batch that brought it first."""
        return self._union([run for level in self.levels for run in level])

    def merged(self) -> DataFrame:
        """(a, b, n, top) over all batches."""
        return self._merge([*(run for level in self.levels for run in level), *self.again])

    def ingest(self, lines: DataFrame) -> None:
        """Add a batch of lines (did, a, b)."""
        counted = lines.groupBy("a", "b").agg(F.countDistinct("did").alias("n"), F.max("did").alias("top"))
        batch = self._write(counted.repartition(self.buckets, "a", "b"))
        runs = [run for level in self.levels for run in level]
        if runs:
            new = self.spark.table(batch)
            for run in runs:
                new = new.join(self.spark.table(run).select("a", "b").hint("merge"), ["a", "b"], "left_anti")
            new = self._write(new)
            self.again.append(self._write(self.spark.table(batch).join(self.spark.table(new).select("a", "b").hint("merge"), ["a", "b"], "left_anti")))
            self._drop(batch)
            batch = new
            if len(self.again) >= self.fan_in:
                summed = self._write(self._merge(self.again).repartition(self.buckets, "a", "b"))
                self._drop(*self.again)
                self.again = [summed]
        self._add(0, batch)

    def _add(self, level: int, run: str) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            runs, self.levels[level] = self.levels[level], []
            compact = self._write(self._union(runs).repartition(self.buckets, "a", "b"))
            self._drop(*runs)
            self._add(level + 1, compact)

    def close(self) -> None:
        """Forget and delete all tables."""
        self._drop(*(run for level in self.levels for run in level), *self.again)
        self.levels, self.again = [], []


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, text: str = "text", batch_lines: int = BATCH_LINES) -> DataFrame:
    """(rest, text, n_lines, n_dropped) for each row of docs; rest is a struct of its other columns, text what is left.

    Texts are split at \\n; a line's key is the line stripped of [\\x20\\x09-\\x0D] with A-Z lower-cased. A key of min_chars code points or
    more that min_docs documents or more hold loses all lines but those in the largest doc_id that holds it. Null or empty texts are one
    empty line; texts of any length are taken whole. Rows of one doc_id are one document, and repeated rows end alike; rows without an id
    are one document together, below all others. Keys are compared by 128-bit hashes. Columns may have any names. The table is dealt into
    batches of about batch_lines lines, into larger ones where that would make more than MOST_BATCHES.
    """
    spark = docs.sparkSession
    t = F.coalesce(quoted(text), F.lit(""))
    keyed = docs.select(as_struct(docs, (text,)).alias("rest"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), t.alias("text"), F.xxhash64(t).alias("th"))
    n_lines = keyed.agg(F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()[0] or 0
    batches = min(max(BATCHES, -(-n_lines // batch_lines)), MOST_BATCHES)
    of = F.pmod(F.xxhash64("did"), F.lit(batches)).cast("int").alias("batch")
    lines = materialize(line_hashes(keyed, min_chars).select("*", of), "batch")  # a folder for each batch: all of them together are read once
    runs = LineRuns(spark)
    for b in range(batches):
        runs.ingest(lines.where(F.col("batch") == b).select("did", "a", "b"))
    common = materialize(runs.merged().where(F.col("n") >= min_docs).select("a", "b", "top"))
    runs.close()
    dropped = lines.join(common, ["a", "b"]).where("did <> top").groupBy("did", "th").agg(F.collect_set("i").alias("drop"))
    joined = keyed.join(dropped, ["did", "th"], "left").select("rest", F.col("text").cast("binary").alias("text"), "drop")

    def rebuild(parts):
        for batch in parts:
            for s in range(0, len(batch), 256):
                part = batch.slice(s, 256)
                texts, n, k = [], [], []
                for t, d in zip(part.column(1), part.column(2), strict=True):
                    split = bytes(t.as_buffer()).split(b"\n")
                    gone = set(d.values.to_pylist()) if d.is_valid else ()
                    texts.append(b"\n".join([x for i, x in enumerate(split) if i not in gone]) if gone else bytes(t.as_buffer()))
                    n.append(len(split))
                    k.append(len(gone))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(k, pa.int64())], ["rest", "text", "n_lines", "n_dropped"])

    schema = joined.select("rest").schema.add("text", "string").add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(rebuild, schema)
