"""Tables that stay: batches merged into a partitioned table, of which only what changes is written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import kept
from .bars import merge_store
from .sinks import write_partitions


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at path, empty where none is yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def upsert(new: DataFrame, path: str, by: str, key: str, maps: tuple = ("data",)) -> list:
    """Merge a batch (by, key, maps) into the Parquet table at path, whose folders are the values of `by`; the values whose folders were replaced.

    A key that the table has gets the batch's map entries over its own, a new key its row; see merge_store. Only folders that the batch
    names are read, and only those in which a row differs afterwards are written, so a batch that comes again leaves every file as it
    is. The merged rows are written aside first: what replaces the folders is a copy whose input no longer changes, by Spark's
    committer, folder by folder; if it fails between two folders the same batch completes it. Names of the batch's folders
    pass the driver, as those of any write do. A key stands once in a batch; a null `by` is a folder of its own.
    """
    spark = new.sparkSession
    new = kept(new.select(by, key, *maps))
    named = [r[0] for r in new.select(by).distinct().collect()]
    inside = F.col(by).isin([n for n in named if n is not None])
    old = stored(spark, path, new.schema).where(inside | F.col(by).isNull() if None in named else inside)
    # Keys are unique within a folder: both go into one, so that the merge joins on one column.
    both = F.struct(F.col(by), F.col(key)).alias("_k")
    value = F.to_json(F.struct(*[F.array_sort(F.map_entries(m)).alias(m) for m in maps]), {"ignoreNullFields": "false"})
    was = old.select(both, *maps)
    merged = merge_store(was, new.select(both, *maps), "_k", maps)
    seen = merged.join(was.select("_k", value.alias("_was")), "_k", "left")
    rows = kept(seen.select("_k.*", *maps, (F.col("_was").isNull() | (F.col("_was") != value)).alias("_new")))
    changed = [r[0] for r in rows.where("_new").select(by).distinct().collect()]
    if changed:
        known = [c for c in changed if c is not None]
        write_partitions(rows.drop("_new").where(F.col(by).isin(known) | (F.col(by).isNull() & F.lit(None in changed))), path, [by], [key])
    return changed
