"""Raw files as DataFrames: all text, nothing inferred, bad rows set apart. Only Spark's readers open them, so any store will do."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.symbols import parent_symbol, side_letter
from ..schema import BARS, CONTRACT_COLUMNS, CONTRACT_FIELDS, DEFINITIONS, EXCHANGE_FILE_COLUMNS, MAPPING_COLUMNS, MASTER_ALIASES, MASTER_COLUMNS, texts
from .lines import by_header, cells, header, numbered_lines

CORRUPT = "_corrupt"
#: Fixed value: stands for all symbols of a venue in a request.
ALL_SYMBOLS = "ALL_SYMBOLS"


def _csv(spark: SparkSession, path, columns: list, header: bool) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine with reason and the number of filled cells); a row of too many or too few cells is bad."""
    schema = StructType([*texts(columns).fields, StructField(CORRUPT, StringType())])
    df = spark.read.schema(schema).options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, escape='"', enforceSchema=True).csv(path)
    df = df.withColumns({"source_file": F.col("_metadata.file_name"), "source_block": F.col("_metadata.file_block_start"), "ordinal": F.monotonically_increasing_id()})
    # The filter reads the cells too, as Spark refuses a plan that reads the record only.
    cells = F.size(F.array_compact(F.array(*[F.col(c) for c in columns])))
    bad = df.where(F.col(CORRUPT).isNotNull() & (cells >= 0)).select(F.col(CORRUPT).alias("record"), "source_file", F.lit("wrong number of cells").alias("reason"), cells.alias("filled"))
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "source_block")
    filled = F.lit(False)
    for c in columns:
        filled = filled | (F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    return good.where(filled), bad


def read_master(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of the Indian master's files, in the 21 columns; each file may have an older header, this one's names, or none.

    ordinal is a row's line in its file; source_path and ordinal order the rows as the files have them.
    """
    return by_header(numbered_lines(spark, path, header(MASTER_COLUMNS, MASTER_ALIASES)), MASTER_COLUMNS)


def read_mappings(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """The US symbol mappings with their header; NA and the like stay text."""
    return _csv(spark, path, MAPPING_COLUMNS, True)


def read_exchange_file(spark: SparkSession, path) -> DataFrame:
    """The exchange's own header file; a missing path gives no rows, and missing columns are null."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.options(header=True, escape='"').csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], texts(EXCHANGE_FILE_COLUMNS))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in EXCHANGE_FILE_COLUMNS])


def _folder(key: str):
    """The value of a key=value folder on a file's path, null without one."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path"), rf"/{key}=([^/]*)/", 1), F.lit(""))


def read_lines(spark: SparkSession, path, comments: bool = True) -> DataFrame:
    """(name, ordinal, value): the lines of symbol lists, trimmed, without blank ones and, if comments, those that start with #.

    name is that of a folder name=..., or of the file. Lists are short: ordinal orders the lines of a file.
    """
    name = F.coalesce(_folder("name"), F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))
    lines = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(name.alias("name"), F.split(F.regexp_replace("value", "^﻿", ""), r"\r?\n").alias("v"))
    rows = lines.select("name", F.posexplode("v").alias("ordinal", "value")).select("name", "ordinal", F.trim("value").alias("value"))
    return rows.where((F.col("value") != "") & ~(F.lit(comments) & F.col("value").startswith("#")))


def read_underlyings(spark: SparkSession, path) -> DataFrame:
    """(ordinal, exchange, symbol) of EXCHANGE|SYMBOL lines or bare symbols, upper-cased; a line of another form raises when it is read."""
    v = F.split(F.upper("value"), r"\|")
    rows = read_lines(spark, path).select("ordinal", v.alias("v"))
    ok = (F.size("v") <= 2) & ~F.exists("v", lambda x: F.trim(x) == "")
    rows = rows.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad line: "), F.concat_ws("|", "v")))))
    return rows.select("ordinal", F.when(F.size("v") == 2, F.trim(F.get("v", F.lit(0)))).alias("exchange"), F.trim(F.element_at("v", -1)).alias("symbol"))


def read_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """Normalized CSV files of a folder, plain or compressed by gzip, as typed contracts; exchange is that of a folder exchange=..., or the file name up to its first hyphen.

    Texts that are blank stay empty texts; a number that is blank or none is null.
    """
    reader = spark.read.schema(texts(CONTRACT_COLUMNS)).options(header=True, escape='"', nullValue="\u0000", emptyValue="", recursiveFileLookup=True, pathGlobFilter="*{.csv,.csv.gz}")
    df = reader.csv(folder).withColumns({"_file": F.col("_metadata.file_name"), "_exchange": _folder("exchange")})
    df = df.where(~F.col("_file").endswith(".stripped.csv") & ~F.col("_file").endswith(".stripped.csv.gz") & ~F.col("_file").startswith("NSE-"))
    typed = [(F.coalesce(c, F.lit("")) if t.typeName() == "string" else F.trim(F.col(c)).try_cast(t)).alias(c) for c, t, _ in CONTRACT_FIELDS]
    return df.select(F.coalesce("_exchange", F.split("_file", "-")[0]).alias("exchange"), *typed)


def read_baskets(spark: SparkSession, folder: str, columns: list) -> DataFrame:
    """basket and columns, as text, of all basket files of a day: basket is that of a folder basket=..., or the file's name."""
    reader = spark.read.options(header=True, escape='"', nullValue="\u0000", emptyValue="", recursiveFileLookup=True, pathGlobFilter="*.csv")
    df = reader.schema(texts(columns)).csv(folder)
    return df.select(F.coalesce(_folder("basket"), F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)).alias("basket"), *[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def read_bars(spark: SparkSession, path: str, underlyings: list | None = None, since: str | None = None) -> DataFrame:
    """Landed minute bars, in folders underlying=...; the underlyings and the first day asked for reach the scan."""
    df = spark.read.schema(BARS).parquet(path)
    df = df.where(F.col("underlying").isin(underlyings)) if underlyings else df
    return df.where(F.col("ts") >= F.lit(since).cast("timestamp")) if since else df


def read_definitions(spark: SparkSession, path: str, expiry: str | None = None) -> DataFrame:
    """Landed option definitions: (raw_symbol, strike, side, expiration), with expiry those of one day only."""
    df = spark.read.schema(DEFINITIONS).parquet(path)
    df = df.where((F.col("expiration") >= F.lit(expiry).cast("timestamp")) & (F.col("expiration") < F.date_add(F.lit(expiry).cast("date"), 1).cast("timestamp"))) if expiry else df
    return df.select("raw_symbol", F.col("strike_price").alias("strike"), side_letter(F.col("raw_symbol")).alias("side"), "expiration")


def venue_symbols(spark: SparkSession, path, venue: str, all_symbols: bool = False) -> DataFrame:
    """(ordinal, symbol, stype_in) of a venue's symbol list, bare roots as parents of their options; with all_symbols the one name for all."""
    kind = default_stype_in(venue, all_symbols)
    if all_symbols:
        return spark.createDataFrame([(0, ALL_SYMBOLS)], "ordinal int, symbol string").withColumn("stype_in", F.lit(kind))
    symbol = parent_symbol(F.col("value")) if venue.lower() in ("xcme", "xcbo") else F.col("value")
    return read_lines(spark, path, comments=False).select("ordinal", symbol.alias("symbol"), F.lit(kind).alias("stype_in"))


def default_stype_in(venue: str, all_symbols: bool = False) -> str:
    """How a venue's symbols are asked for."""
    return "parent" if venue.lower() == "xcbo" or (venue.lower() == "xcme" and not all_symbols) else "raw_symbol"


def read_resolved(spark: SparkSession, path, mapping: str = "map<string,array<struct<s:string,d0:string,d1:string>>>") -> DataFrame:
    """Symbol resolutions as JSON, {symbol: [{s, d0, d1}]}, flattened to mapping rows."""
    each = spark.read.text(path, wholetext=True).select(F.from_json("value", mapping).alias("m")).select(F.explode("m").alias("symbol", "spans")).select("symbol", F.explode("spans").alias("x"))
    return each.select(F.col("x.s").alias("instrument_id"), F.col("symbol").alias("stype_in_symbol"), F.col("x.s").alias("stype_out_symbol"), F.lit("raw_symbol").alias("stype_in"), F.lit("instrument_id").alias("stype_out"), F.col("x.d0").alias("start_ts"), F.col("x.d1").alias("end_ts"))


def read_matrices(spark: SparkSession, glob: str) -> DataFrame:
    """Matrix files, or folders of files, {symbol}_{n}dte/{symbol}_matrix_{day}.csv: (underlying, dte, trade_date, ts, underlying_ltp, straddle, vt); ts or timestamp may be the first column's name."""
    wanted = "straddle_3atm vt_3atm underlying_ltp".split()
    df = spark.read.options(header=True).csv(glob)
    if missing := [c for c in wanted if c not in df.columns] or ([] if {"ts", "timestamp"} & set(df.columns) else ["ts"]):
        raise ValueError(f"missing columns: {missing}")
    path, place, day = F.col("_metadata.file_path"), r"/([^/]+)_(\d+)dte/", r"_matrix_(\d{4})-?(\d{2})-?(\d{2})"
    ts = F.coalesce(*[F.col(c) for c in ("timestamp", "ts") if c in df.columns]).cast("timestamp")
    return df.select(
        F.regexp_extract(path, place, 1).alias("underlying"), F.regexp_extract(path, place, 2).try_cast("int").alias("dte"),
        F.concat_ws("-", *[F.regexp_extract(path, day, i) for i in (1, 2, 3)]).try_cast("date").alias("trade_date"), ts.alias("ts"), *[F.col(c).try_cast("double").alias(c) for c in wanted],
    )


def read_matrix_cells(spark: SparkSession, glob: str) -> DataFrame:
    """(underlying, dte, trade_date, ts, name, value) of all cells of matrix files that hold a number; each file's first line names its columns."""
    path, place, day = "source_path", r"/([^/]+)_(\d+)dte/", r"_matrix_(\d{4})-?(\d{2})-?(\d{2})"
    lines = numbered_lines(spark, glob, cells).where("line_no > head.line_no AND trim(value) <> ''")
    pairs = lines.select(path, F.arrays_zip(F.col("of_head").alias("name"), cells(F.col("value")).alias("value")).alias("c"))
    each = pairs.select(path, F.get("c", F.lit(0))["value"].alias("ts"), F.explode(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0)))).alias("c"))
    return each.select(
        F.regexp_extract(path, place, 1).alias("underlying"), F.regexp_extract(path, place, 2).try_cast("int").alias("dte"), F.concat_ws("-", *[F.regexp_extract(path, day, i) for i in (1, 2, 3)]).try_cast("date").alias("trade_date"),
        F.col("ts").try_cast("timestamp").alias("ts"), F.col("c.name").alias("name"), F.col("c.value").try_cast("double").alias("value"),
    ).where("value IS NOT NULL")


def landed(spark: SparkSession, path) -> list:
    """The names of all files below a folder, none where there is no such folder; no file is opened."""
    from pyspark.errors import AnalysisException

    try:
        return [unquote(n) for n in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def landed_partitions(spark: SparkSession, path, keys: list) -> DataFrame:
    """The distinct values of key=value folders in which files stand, as text, from the listing alone: no file is opened."""
    found = spark.createDataFrame([(n,) for n in landed(spark, path)], "path string")
    return found.select(*[F.url_decode(F.replace(F.regexp_extract("path", rf"/{k}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))).alias(k) for k in keys]).distinct()


def first_of(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key in a total order; the plan has a limit below the shuffle, so a frequent key does not meet in one task."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
