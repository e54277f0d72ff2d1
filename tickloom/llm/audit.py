"""Filter interaction audit: every order of some filters, run as one depth-first walk over the sets of filters already applied."""

from itertools import permutations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import scratch_dir
from .common import materialize, quoted

WORD = r"[^\x20\x09-\x0D]+"
#: The failure condition of each filter, over the columns of measures().
FILTERS = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_upper > 10 * n_chars",
    "D": "has_symbol",
    "E": "is_copy",
}
COUNTS = "kept", "removed", "good_lost", "toxic_lost"


def measures(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """(part, n_words, n_distinct, n_upper, n_chars, has_symbol, is_copy, good, toxic) of each row of docs, written once.

    A null text is empty; equal texts are found by their SHA-256. is_copy: a smaller doc_id of the table has the same text; a row without
    a doc_id is no copy and makes none. A label of any row of labels for the doc_id counts. The joins go by doc_id, and least ids are
    found by partial aggregation, so texts that a third of the rows share make no large group.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("t"))
    split = text.select("*", F.array_remove(F.split(F.translate("t", "\t\n\x0b\x0c\r", " " * 5), " "), "").alias("w"))
    found = materialize(
        split.select(
            "doc_id", "part", F.sha2("t", 256).alias("digest"), F.size("w").cast("long").alias("n_words"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
            F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"), F.length("t").cast("long").alias("n_chars"), F.col("t").rlike(r"[#$%&*|]").alias("has_symbol"),
        )
    )
    first = found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    both = found.join(first, ["doc_id", "digest"], "left").join(known, "doc_id", "left")
    marks = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return materialize(both.select("part", "n_words", "n_distinct", "n_upper", "n_chars", "has_symbol", (F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("is_copy"), *marks))


def edges(rows: DataFrame, filters: dict) -> DataFrame:
    """(state, filter, part, kept, removed, good_lost, toxic_lost) for each set of applied filters and each further filter.

    state has a bit for each applied filter; kept counts the rows before the further filter. The trie of all orders is walked depth
    first; a prefix's state depends on its set of filters alone, so each set's survivors are filtered and counted once. Survivors are
    persisted while the walk is below them, len(filters) - 1 of them at most; a lost executor's share is filtered again from `rows`. Counts go
    to a shared folder, a folder for each state. A part without survivors has no row.
    """
    spark, names, folder, seen = rows.sparkSession, list(filters), scratch_dir(rows.sparkSession), set()
    fails = {f: F.coalesce(F.expr(c), F.lit(False)) for f, c in filters.items()}

    def visit(state: int, survivors: DataFrame) -> None:
        seen.add(state)
        left = [(i, f) for i, f in enumerate(names) if not state >> i & 1]
        further = len(left) > 1
        if further:
            survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        marks = {"removed": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
        counts = survivors.groupBy("part").agg(F.count("*").alias("kept"), *[F.count_if(fails[f] & c).alias(m + f) for _, f in left for m, c in marks.items()])
        each = F.array(*[F.struct(F.lit(f).alias("filter"), quoted(f"removed{f}").alias("removed"), quoted(f"good{f}").alias("good_lost"), quoted(f"toxic{f}").alias("toxic_lost")) for _, f in left])
        counts.select("part", "kept", F.inline(each)).write.parquet(f"{folder}/state={state}")
        for i, f in left:
            if further and state | 1 << i not in seen:
                visit(state | 1 << i, survivors.where(~fails[f]))
        if further:
            survivors.unpersist()

    visit(0, rows)
    return spark.read.schema("part string, kept long, filter string, removed long, good_lost long, toxic_lost long, state int").parquet(folder)


def audit_orders(rows: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order and step.

    rows: (part, good, toxic) and what the failure conditions of filters, SQL by one-letter name, refer to; a condition that is null does
    not fail a row. kept counts the rows after the step, removed those that go in it, redundant those failing its filter that went
    earlier, unique_fails those that fail no other filter; shapley sums removed over all orders. Zeros are given, and an empty table has
    no part and so no rows. The rows of the result are parts times orders times filters; the counts never pass through the driver.
    """
    names, spark = list(filters), rows.sparkSession
    at = edges(rows, filters)
    walk = [("".join(order), k + 1, f, sum(1 << names.index(g) for g in order[:k])) for order in permutations(names) for k, f in enumerate(order)]
    steps = spark.createDataFrame(walk, "filter_order string, step int, filter string, state int")
    root = at.where("state = 0").select("part", "filter", F.col("removed").alias("fails"))
    others = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(names) for x in (f, (1 << len(names)) - 1 - (1 << i))]), F.col("filter"))
    alone = at.groupBy("part", "filter").agg(F.sum(F.when(F.col("state") == others, F.col("removed")).otherwise(0)).alias("unique_fails"))
    weight = steps.groupBy("state", "filter").agg(F.count("*").alias("orders"))
    value = at.join(F.broadcast(weight), ["state", "filter"]).groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    whole = root.join(alone, ["part", "filter"]).join(value, ["part", "filter"]).join(F.broadcast(steps), "filter").join(at, ["part", "state", "filter"], "left").na.fill(0, list(COUNTS))
    return whole.select(
        "part", "filter_order", "step", "filter", (F.col("kept") - F.col("removed")).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", filters: dict = FILTERS) -> DataFrame:
    """audit_orders over documents; their parts are the values of a column, null as an empty string. Other columns make no difference."""
    return audit_orders(measures(docs, labels, quoted(part)), filters)
