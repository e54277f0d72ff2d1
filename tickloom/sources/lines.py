"""Lines of text files with their numbers, and their cells; files of one folder may each have their own header."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import kept

#: The place of a line in its file; with the file's path it orders the lines of a folder.
PLACE = ["source_path", "line_no"]


def numbered_lines(spark: SparkSession, path, of_head: Callable | None = None) -> DataFrame:
    """(source_path, source_file, source_block, line_no, value, head): all lines of a folder's files, numbered from 0 in each file.

    head is the file's first line that is not blank, and where it stands; of_head makes a column `of_head` of its text, once for each file. A
    byte order mark goes. The lines are written once, with their block and an id that rises within the block; a row for each block then tells
    how many lines stand before it, and no task sees more than the blocks of a file. These rows are tables of their own, whose size is known
    when they meet the lines: while they are small, the lines are not shuffled. Line ends are CR, LF or both, also within quotes.
    """
    raw = spark.read.text(path)
    value = F.regexp_replace("value", "^\ufeff", "")
    lines = kept(
        raw.select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"), F.monotonically_increasing_id().alias("id"), value.alias("value")),
        compression="zstd",
    )
    at = ["source_path", "source_file", "source_block"]
    blocks = lines.groupBy(*at).agg(F.count("*").alias("n"), F.min("id").alias("first"), F.min(F.when(F.trim("value") != "", F.col("id"))).alias("id"))
    file = Window.partitionBy("source_path")
    before = F.sum("n").over(file.orderBy("source_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    blocks = kept(blocks.withColumn("before", before).withColumn("of_head", F.min(F.when(F.col("id").isNotNull(), F.col("source_block"))).over(file)))
    heads = lines.join(blocks.where("source_block = of_head").select("source_path", "source_block", "id", (F.col("before") - F.col("first")).alias("_add")), ["source_path", "source_block", "id"])
    heads = heads.select("source_path", F.struct((F.col("id") + F.col("_add")).alias("line_no"), "value").alias("head"), *([of_head(F.col("value")).alias("of_head")] if of_head else []))
    starts = blocks.select("source_path", "source_block", (F.col("before") - F.col("first")).alias("_add")).join(heads, "source_path", "left")
    joined = lines.join(kept(starts), ["source_path", "source_block"])
    return joined.select("source_path", "source_file", "source_block", (F.col("id") + F.col("_add")).alias("line_no"), "value", "head", *(["of_head"] if of_head else []))


def cells(line: Column) -> Column:
    """The cells of a comma-separated line; those in quotes lose them, doubled quotes become one. A quote that is not closed is text.

    The patterns are possessive, which Java matches in a loop: others recurse, and thousands of quotes in a cell would end the task. They
    are matched only on lines that have a quote, and on cells that begin with one and have more than text and doubled quotes to the last.
    """
    quoted = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'
    each = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'), F.lit(1))
    inner = lambda c: F.concat(F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, quoted, 2))
    within = lambda c: F.substring(c, F.lit(2), F.length(c) - 2)
    whole = lambda c: (F.length(c) > 1) & c.endswith('"') & ~F.contains(F.replace(within(c), F.lit('""'), F.lit("")), F.lit('"'))
    bare = lambda c: F.when(whole(c), F.replace(within(c), F.lit('""'), F.lit('"'))).when(c.rlike(quoted), inner(c)).otherwise(c)
    return F.when(F.contains(line, F.lit('"')), F.transform(each, lambda c: F.when(c.startswith('"'), bare(c)).otherwise(c))).otherwise(F.split(line, ","))


def header(columns: list, aliases: dict) -> Callable:
    """For of_head: whether a file's first line is a header, how many cells its lines have, and the place of each of the columns in them.

    That line is a header if any cell of it is one of aliases, names in lower case by which columns were known; then its cells name the
    columns in any order, the last of two like names counts, unknown names are left out, and a column that it lacks has its place beyond the
    end. A file without one has the columns as they are.
    """
    known = F.create_map(*[F.lit(x) for k, c in ({c.lower(): c for c in columns} | aliases).items() for x in (k, c)])

    def of_head(text: Column) -> Column:
        titles = F.transform(cells(text), lambda c: F.lower(F.trim(c)))
        headed = F.exists(titles, lambda c: c.isin(list(aliases)))
        own = F.when(headed, F.transform(titles, lambda c: known[c])).otherwise(F.array(*map(F.lit, columns)))
        places = F.array(*[F.size(own) - F.array_position(F.reverse(own), c).cast("int") for c in columns])
        return F.struct(headed.alias("headed"), F.size(own).alias("width"), places.alias("places"))

    return of_head


def by_header(lines: DataFrame, columns: list) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of numbered lines as columns, each file's ordered as its `header` of these columns says, which is in of_head.

    A line of more or fewer cells than its file's is set apart with its place and the number of cells that hold something; blank lines and
    lines of blank cells go. Empty cells are null.
    """
    rows = lines.where(~(F.col("of_head.headed") & (F.col("line_no") == F.col("head.line_no"))) & (F.trim("value") != ""))
    split = rows.select("source_path", "source_file", "line_no", "value", F.col("of_head.width").alias("_width"), F.col("of_head.places").alias("_places"), cells(F.col("value")).alias("_cells"))
    fits = F.size("_cells") == F.col("_width")
    some = F.col("value").rlike('[^, "]') | (F.trim(F.array_join("_cells", "")) != "")
    own = F.when(fits & some, F.transform("_places", lambda i: F.nullif(F.get("_cells", i), F.lit(""))))
    bad = split.where(~fits).select(F.col("value").alias("record"), "source_path", "source_file", "line_no", F.lit("wrong number of cells").alias("reason"), F.size(F.filter("_cells", lambda c: c != "")).alias("filled"))
    # Exploded, an array of one, as conditions on the columns would else be pushed below the split, which each of them would then repeat. Above
    # it stands no more than a column's place in the row: code that is too long for Java's compiler runs many times slower.
    good = split.select("source_path", "source_file", "line_no", own.alias("_own")).select("source_path", "source_file", "line_no", F.explode(F.array("_own")).alias("_row")).where("_row IS NOT NULL")
    return good.select(*[F.get("_row", F.lit(i)).alias(c) for i, c in enumerate(columns)], "source_path", "source_file", F.col("line_no").alias("ordinal")), bad
