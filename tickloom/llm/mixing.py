"""Mixing sources to target weights by a curriculum: weights that change over training, demand that is inverted, documents in order of position."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_struct, materialize, quoted

#: The weight of the first, second, third source and so on, repeating, at times of training from 0 to 1, linear in between. They integrate to 3, 1 and 2.
SCHEDULES = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 1.0), (0.5, 2.0), (1.0, 3.0)]]
#: Of all words, the share that the mix takes; how often it takes a document at most.
SHARE, MOST = 1.5, 2
#: Slices of a source's order: so many at least, and more where a slice would have more rows than this.
SLICES, SLICE_ROWS = 1024, 20_000


def integrated(spark: SparkSession, schedules: list) -> DataFrame:
    """(slot, weight, pieces): the integral of each schedule, and its linear pieces with what was integrated before each."""
    knots = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({s}, {k}, {float(t)}D, {float(r)}D)" for s, some in enumerate(schedules) for k, (t, r) in enumerate(some)) + " AS v(slot, k, at, rate)")
    after = Window.partitionBy("slot").orderBy("k")
    span, rise = F.lead("at").over(after) - F.col("at"), F.lead("rate").over(after) - F.col("rate")
    parts = knots.select("slot", "k", "at", "rate", span.alias("span"), (rise / F.when(span > 0, span)).alias("slope"), (span * (F.col("rate") + rise / 2)).alias("area")).where("span > 0")
    parts = parts.withColumn("before", F.sum("area").over(after.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("area"))
    return parts.groupBy("slot").agg(F.sum("area").alias("weight"), F.sort_array(F.collect_list(F.struct("before", "at", "rate", "slope"))).alias("pieces"))


def targets(sizes: DataFrame, schedules: list, share: float, most: int) -> DataFrame:
    """(source, source_size, target, mixed, weight, pieces) of sizes(source, source_size).

    Sources take the schedules in order of their names' code points, null last, in turns. What sources may not take beyond `most` times their
    size goes to the others by weight. In the order of size by weight the sources that stop are the first ones, so sums before and after
    each one tell. This table has a row for each source, and its windows are one task.
    """
    everything, to_here = Window.partitionBy(), Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slot = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules)
    s = sizes.withColumn("slot", slot).join(integrated(sizes.sparkSession, schedules), "slot").withColumn("most", F.col("source_size").cast("double") * most)
    s = s.withColumn("ratio", F.col("source_size") / F.col("weight")).withColumn("all", F.sum("source_size").over(everything) * F.lit(share))
    left = F.col("all") - (F.sum("most").over(to_here) - F.col("most"))
    heavy = F.sum("weight").over(everything) - F.sum("weight").over(to_here) + F.col("weight")
    s = s.withColumn("stops", F.col("most") * heavy <= F.col("weight") * left)
    rest = F.col("all") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(everything)
    shared = F.sum(F.when(~F.col("stops"), F.col("weight")).otherwise(0)).over(everything)
    s = s.withColumn("target", F.when(F.col("stops"), F.col("most")).otherwise(rest * F.col("weight") / shared))
    return s.select("source", "source_size", "target", F.col("all").alias("mixed"), "weight", "pieces")


def mix_sources(docs: DataFrame, schedules: list = SCHEDULES, share: float = SHARE, most: int = MOST, source: str = "source", text: str = "text") -> DataFrame:
    """(row, size, source_size, target, taken, copies, tie): what the mix takes of each row of docs, and where in training each copy stands.

    size: words [^\\x20\\x09-\\x0D]+ of the text, 0 for null. A source's documents stand in a row in the order of the MD5 of doc_id, then of the text;
    the mix takes the row's words from its start, over again after its end, up to the whole words of the target, so a document
    that the end runs through gives its first words. copies: (words, position) of each time a document is taken. position is the word of
    the whole mix at which the source's demand, its weight's integral over time scaled to its target, reaches the middle of the copy.

    A source's row is cut into slices by MD5: sums over slices give each slice's start, and only a slice's own rows are sorted in one task,
    however large the source. Rows with equal doc_id and text are interchangeable; a table with few distinct ones would fill few
    slices. An empty table gives no rows, a source without words a target of 0; row holds all columns of docs.
    """
    slices = max(SLICES, docs.count() // SLICE_ROWS)
    doc_key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        as_struct(docs).alias("row"), quoted(source).cast("string").alias("source"), F.regexp_count(F.coalesce(quoted(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.concat(doc_key, F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary"))).alias("tie"),
    )
    sized = sized.withColumn("slice", F.expr(f"shiftright(cast(conv(substr(tie, 1, 8), 16, 10) as bigint) * {slices}, 32)"))
    sums = materialize(sized.groupBy("source", "slice").agg(F.sum("size").alias("words")))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, share, most)
    before = F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    starts = sums.select(F.col("source").alias("s"), F.col("slice").alias("i"), before.alias("before"))
    starts = starts.join(goals, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    inside = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = sized.withColumn("inside", inside).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("i")))
    placed = placed.withColumn("need", F.floor("target")).withColumn("start", F.col("before") + F.col("inside"))
    copy = f"""transform(sequence(0L, {most - 1}L), e -> named_struct('start', start + e * source_size, 'words', greatest(0L, least(size, need - start - e * source_size))))"""
    done = "weight * (c.start + c.words / 2D) / need"
    piece = f"element_at(filter(pieces, (p, i) -> i = 0 OR p.before <= {done}), -1)"
    ahead = F.expr(f"transform(copies, c -> named_struct('words', c.words, 'piece', {piece}, 'ahead', {done}))")
    placed = placed.withColumn("copies", F.filter(F.expr(copy), lambda c: c["words"] > 0)).withColumn("copies", ahead)
    y = "(c.ahead - c.piece.before)"
    time = f"c.piece.at + if({y} > 0, 2 * {y} / (c.piece.rate + sqrt(greatest(0D, c.piece.rate * c.piece.rate + 2 * c.piece.slope * {y}))), 0D)"
    copies = F.expr(f"transform(copies, c -> named_struct('words', c.words, 'position', cast(floor(({time}) * mixed) as bigint)))")
    return placed.select("row", "size", "source_size", "target", F.expr("aggregate(copies, 0L, (a, c) -> a + c.words)").alias("taken"), copies.alias("copies"), "tie")


def training_order(mixed: DataFrame) -> DataFrame:
    """(row, size, source_size, target, taken, words, position, tie): a row for each copy that the mix takes, range-sorted by position."""
    return mixed.select("row", "size", "source_size", "target", "taken", F.inline("copies"), "tie").orderBy("position", "tie")
