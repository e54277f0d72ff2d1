"""Symbol mappings that land as files, taken in once each: all that is there, then the query ends."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import normalize_us
from ..operators.sinks import write_partitions
from ..schema import MAPPING_COLUMNS, texts


def read_mapping_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(texts(MAPPING_COLUMNS)).option("header", True)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(folder)


def take_in(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]):
    """Run each(batch, id) over what has landed since the checkpoint. A batch may run again after a failure: each must replace, not add."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def contracts_sink(path: str, venue: str, as_of: str) -> Callable[[DataFrame, int], None]:
    """Contracts of each batch in a partition of its own, which a repeated batch replaces."""

    def each(batch: DataFrame, batch_id: int) -> None:
        good, _ = normalize_us(batch, venue, as_of)
        write_partitions(good.withColumns({"date": F.lit(as_of), "batch": F.lit(batch_id)}), path, ["date", "exchange", "batch"])

    return each


def captured(stream: DataFrame, max_rows: int, live_seconds: int) -> DataFrame:
    """The mapping columns and reason: of each symbol asked for the first max_rows mappings that start within live_seconds of its first one.

    A mapping without an instrument is set apart with a reason and counts for nothing; other symbols go on. How many a symbol has and when
    it began is kept from batch to batch in the checkpoint, so a stream that starts again goes on counting. Within a batch
    the earliest count, by start_ts (one that is no time comes with the first) and instrument; a task holds max_rows rows of a symbol at most, however many come.
    """
    names = [*MAPPING_COLUMNS, "reason"]
    out = texts(names)

    def capture(key, frames, state):
        import heapq

        import pandas as pd

        n, first = state.get if state.exists else (0, None)
        least, apart = [], []
        for df in frames:
            bad = df["instrument_id"].fillna("").str.strip() == ""
            apart.append(df[bad].assign(reason="no instrument"))
            for row in df[~bad].sort_values(["start_ts", "instrument_id"]).head(max_rows - n).itertuples(index=False):
                key_of = row.start_ts or "", row.instrument_id
                if len(least) < max_rows - n:
                    heapq.heappush(least, _Last(key_of, row))
                elif least and key_of < least[0].key:
                    heapq.heapreplace(least, _Last(key_of, row))
            if len(apart[-1]):
                yield apart.pop()[names].fillna("")
        rows = [x.row for x in sorted(least, key=lambda x: x.key)]
        if rows:
            at = pd.to_datetime(pd.Series([r.start_ts for r in rows]), errors="coerce")
            micros = at.astype("datetime64[us]").astype("int64")
            first = int(micros[at.notna()].min()) if first is None and at.notna().any() else first
            rows = [r for r, t, known in zip(rows, micros, at.notna(), strict=True) if not known or t < first + live_seconds * 10**6]
            state.update((n + len(rows), first))
            if rows:
                yield pd.DataFrame(rows).assign(reason="")[names].fillna("")

    return stream.groupBy("stype_in_symbol").applyInPandasWithState(capture, out, "n long, first long", "append", "NoTimeout")


class _Last:
    """A row in a heap whose top is the latest one."""

    def __init__(self, key, row):
        self.key, self.row = key, row

    def __lt__(self, other):
        return self.key > other.key


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Rows of each batch in a partition of its own, which a repeated batch replaces."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_partitions(batch.withColumn("batch", F.lit(batch_id)), path, ["batch"])

    return each


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """At most so many captured rows: a cap that the capture asks for."""
    return df.limit(rows)
