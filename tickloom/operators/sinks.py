"""Writes that can be repeated: partitions are replaced as a whole, so a second run leaves the same data."""

import re
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REQUIRED
from ..scratch import discard, kept, move, scratch_dir
from ..sources.files import landed
from .database import load

#: Bytes of a file that a task holds while it copies.
COPY_BYTES = 8 << 20
#: Tasks that copy, at most.
COPY_TASKS = 2000


def write_partitions(df: DataFrame, path: str, by: list, sort: list | None = None, kind: str = "parquet", every: list | None = None, **options: str) -> None:
    """Replace the partitions of `by` that df has rows for, others stay; an empty df leaves all as it is.

    every: the values of `by`, as tuples, that the run stands for; those without rows are replaced too, by a table without rows (with a
    header, if it is CSV). Those are the folders that the write gave no new files, so df is computed once and not written aside.
    """
    spark = df.sparkSession
    folders = ["/".join([path.rstrip("/"), *(f"{c}={v}" for c, v in zip(by, values, strict=True))]) for values in every or []]
    before = {f: set(landed(spark, f)) for f in folders}
    out = df.sortWithinPartitions(*by, *sort) if sort else df
    writer = _csv(out.write) if kind == "csv" else out.write
    writer.mode("overwrite").options(partitionOverwriteMode="dynamic", **options).partitionBy(*by).format(kind).save(path)
    for folder in (f for f in folders if before[f].issuperset(landed(spark, f))):
        none = df.limit(0).drop(*by).write.mode("overwrite").options(**options)
        (_csv(none) if kind == "csv" else none).format(kind).save(folder)


def copy_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(name, length, sha256) of the files of a folder and those below it, copied byte by byte under the same names into another folder.

    Spark lists the files, empty ones too, and deals out their names; tasks stream them from store to store in pieces, which no row has to
    hold, into a hidden folder of the target and move each into place when it is whole, so that a task may run twice. Stores are those
    that Arrow opens (local or mounted folders, HDFS, S3, GCS); on local ones the time of the last change stays. Files of the target
    that the source lacks stay.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).inputFiles()
    found = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, min(len(names), COPY_TASKS)))
    plain, hidden = (lambda p: re.sub(r"^[a-z0-9]+:/+", "/", p).rstrip("/")), f"_copying-{uuid4().hex}"
    root, onto = plain(source), target.rstrip("/")

    def run(batches):
        import os
        from hashlib import sha256

        import pyarrow as pa
        from pyarrow import fs

        def opened(uri):
            return (fs.LocalFileSystem(), plain(uri)) if re.match(r"(file:)?/", uri) else fs.FileSystem.from_uri(uri)

        for batch in batches:
            rows = []
            for path in map(unquote, batch.column(0).to_pylist()):
                name = plain(path)[len(root) + 1 :] or os.path.basename(path)
                here, at = opened(path)
                there, made = opened(f"{onto}/{hidden}/{uuid4().hex}")
                _, final = opened(f"{onto}/{name}")
                there.create_dir(os.path.dirname(made))
                there.create_dir(os.path.dirname(final))
                digest, n = sha256(), 0
                with here.open_input_stream(at) as src, there.open_output_stream(made) as dst:
                    while piece := src.read(COPY_BYTES):
                        dst.write(piece)
                        digest.update(piece)
                        n += len(piece)
                if isinstance(there, fs.LocalFileSystem):
                    changed = here.get_file_info(at).mtime_ns
                    os.utime(made, ns=(changed, changed))
                there.move(made, final)
                rows.append((name, n, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["name", "length", "sha256"])

    done = kept(found.mapInArrow(run, "name string, length long, sha256 string"))
    discard(spark, f"{onto}/{hidden}")
    return done


def write_basket(df: DataFrame, path: str, date: str, basket: str) -> None:
    """One basket of a day as CSV; an empty result replaces an older one too."""
    write_csv(df.drop("date", "basket"), f"{path.rstrip('/')}/date={date}/basket={basket}")


def write_baskets(df: DataFrame, path: str, date: str) -> None:
    """All baskets of a day in one pass, each in a folder of its own."""
    _csv(df.drop("date").write.mode("overwrite").partitionBy("basket")).csv(f"{path.rstrip('/')}/date={date}")


def write_aggregates(contracts: DataFrame, baskets: DataFrame, path: str) -> None:
    """The day's contracts and baskets as two CSV tables."""
    for name, df in (("contracts", contracts), ("baskets", baskets)):
        write_csv(df, f"{path.rstrip('/')}/{name}.csv")


def push_day(contracts: DataFrame, basket_documents: DataFrame, url: str, day: str, mirror: str = "public", **properties) -> None:
    """contracts and baskets into the day's schema and the baskets' own one, and into the schema that always holds the latest: all at once, see load."""
    required = tuple(c for c in ("date", "exchange", *REQUIRED) if c in contracts.columns)
    tables = []
    for schema in (dated_schema(day), mirror):
        tables += [(schema, "contracts", contracts, required, ()), (schema, "baskets", basket_documents, ("basket", "scripts"), ("scripts",))]
    tables.append((f"{dated_schema(day)}_baskets", "baskets", basket_documents, ("basket", "scripts"), ("scripts",)))
    load(contracts.sparkSession, tables, url, **properties)


def _cell(c):
    """A value as a cell of a CSV line, in quotes where it must be; null is blank."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[,"\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def write_matrices(minutes: DataFrame, prices: DataFrame, path: str, measures: tuple = ("underlying_ltp", "straddle_3atm", "vt_3atm")) -> list:
    """One CSV file for each underlying, days to expiry and day, {path}/{U}_{n}dte/{U}_matrix_{day}.csv; the files' names.

    minutes(underlying, dte, day, ts, <measures>) are the lines, prices(underlying, dte, day, ts, symbol, mid) the further cells: each
    file has a column for every symbol that has a price in it, in order, so files differ in their columns and no list of symbols is
    needed. A symbol's first price at a ts counts, by value; prices of no minute go. All files are lines of one table, ordered within
    their file by one job, written aside and moved into place by name; a file that exists is replaced. A file is one task's.
    """
    spark, key = minutes.sparkSession, ["underlying", "dte", "day"]
    one = prices.where("symbol IS NOT NULL AND mid IS NOT NULL").groupBy(*key, "ts", "symbol").agg(F.min("mid").alias("mid"))
    cells = one.groupBy(*key, "ts").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "mid"))).alias("_m"))
    symbols = one.join(minutes.select(*key, "ts"), [*key, "ts"], "left_semi").groupBy(*key).agg(F.array_sort(F.collect_set("symbol")).alias("_s"))
    wide = minutes.join(cells, [*key, "ts"], "left").join(symbols, key, "left").withColumn("_s", F.coalesce("_s", F.array().cast("array<string>")))
    values = F.transform("_s", lambda s: _cell(F.try_element_at("_m", s)))
    line = F.array_join(F.concat(F.array(_cell(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), *[_cell(F.col(c)) for c in measures]), F.coalesce(values, F.transform("_s", lambda s: F.lit("")))), ",")
    head = F.array_join(F.concat(F.array(F.lit("ts"), *map(F.lit, measures)), F.transform("_s", _cell)), ",")
    heads = wide.groupBy(*key).agg(F.any_value("_s").alias("_s")).select(*key, F.lit(None).cast("timestamp").alias("ts"), head.alias("line"))
    u = F.col("underlying")
    folder, file = F.concat(u, F.lit("_"), "dte", F.lit("dte")), F.concat(u, F.lit("_matrix_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv"))
    lines = wide.select(*key, "ts", line.alias("line")).unionByName(heads).select(folder.alias("_folder"), file.alias("_file"), "ts", "line")
    aside = scratch_dir(spark)
    lines.repartition("_folder", "_file").sortWithinPartitions("_folder", "_file", F.col("ts").asc_nulls_first(), "line").select("_folder", "_file", "line").write.partitionBy("_folder", "_file").text(aside)
    made = [unquote(f) for f in spark.read.text(aside).inputFiles()]
    names = []
    for f in made:  # one for each matrix: as many renames as files
        folder, file = re.search(r"/_folder=([^/]*)/_file=([^/]*)/", f).groups()
        names.append(f"{unquote(folder)}/{unquote(file)}")
        move(spark, f, f"{path.rstrip('/')}/{names[-1]}")
    discard(spark, aside)
    return sorted(names)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, quotes doubled; nulls are blank."""
    _csv(df.write.mode("overwrite")).csv(path)


def _csv(writer):
    return writer.options(header=True, escape='"', emptyValue="", nullValue="")


def write_bars(df: DataFrame, path: str) -> None:
    """Bars by underlying, in order of time within each file."""
    write_partitions(df, path, ["underlying"], ["ts"])


def latest_view(df: DataFrame, name: str) -> None:
    """A view of the latest date's rows."""
    latest = df.agg(F.max("date").alias("date"))
    df.join(F.broadcast(latest), "date", "left_semi").createOrReplaceTempView(name)  # one row


def dated_schema(day: str) -> str:
    """The database schema of a day given as eight digits."""
    if len(day) != 8 or not day.isdigit():
        raise ValueError("a day is YYYYMMDD")
    return f"v4_{day}"


def safe_identifier(name: str) -> str:
    """A name of letters, digits and underscores, not led by a digit."""
    out = re.sub(r"[^A-Za-z0-9_]", "_", name.strip()).lower()
    if not out:
        raise ValueError("an empty name")
    return f"_{out}" if out[0].isdigit() else out
