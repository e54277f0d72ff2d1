"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted

SPACE = r"[ \t\n\x0B\f\r]"
#: Frequent function words of the four languages; a text of prose has some.
STOP_WORDS = (
    "the of and to in is that it for was on are with as by be this at from or an have not "
    "le la les de des et un une du est que en pour dans sur "
    "der die das und ist von zu den mit für ein eine im des auf "
    "el los las y un una por con para del se es"
).split()
WINDOW = 8

#: (name, measure over the columns of measures(), least, most); a text outside any range is rejected. None: no bound.
THRESHOLDS = [
    ("length in words", "n_words", 20, None),
    ("mean word length", "word_chars / n_words", 1.5, 16.0),
    ("symbols to characters", "n_symbols / word_chars", None, 0.05),
    ("stop words to words", "n_stop_words / n_words", 0.02, None),
    ("words with a letter", "n_letter_words / n_words", 0.6, None),
    ("repeated lines to lines", "n_dup_lines / n_lines", None, 0.5),
    ("bullet lines to lines", "n_bullet_lines / n_lines", None, 0.9),
    ("ellipsis lines to lines", "n_ellipsis_lines / n_lines", None, 0.5),
]
#: More than this percentage of words in repeated windows fails a text.
REPEAT_PERCENT = 30


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the measured columns of each row. The arrays are columns of their own, each read twice, so that they are computed once."""
    d = docs.select(F.col("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("t"))
    d = d.select("doc_id", "t", F.filter(F.split("t", SPACE + "+"), lambda x: x != "").alias("w"), F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("l"))
    d = d.select("*", F.size("w").alias("n"), F.transform("w", lambda x: F.xxhash64(x)).alias("h1"))
    left = F.col("n")
    for i, step in enumerate((1, 2, 4)):  # hashes of 2, 4 and 8 words
        left, h = left - step, f"h{step}"
        pair = F.zip_with(F.slice(h, 1, left), F.slice(h, 1 + step, left), lambda a, b: F.xxhash64(a, b))
        d = d.select(*[c for c in d.columns if c not in ("h1", "h2") or c == h], F.when(F.col("n") >= WINDOW, pair).alias(f"h{2 * step}")).drop(h)
    d = d.select("*", F.when(F.size("h8") > F.size(F.array_distinct("h8")), F.array_sort(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("sorted")).drop("h8")
    m = F.size("sorted")
    equal = F.zip_with(F.slice("sorted", 1, m - 1), F.slice("sorted", 2, m - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    d = d.select("*", F.when(m > 0, F.sort_array(F.array_distinct(F.flatten(equal)))).alias("at")).drop("sorted")
    nexts = F.concat(F.slice("at", 2, F.size("at")), F.array(F.element_at("at", -1) + WINDOW))
    covered = F.aggregate(F.zip_with("at", nexts, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(0), lambda s, x: s + x)
    stop = F.size(F.filter("w", lambda x: x.isin(STOP_WORDS)))
    letters = F.size(F.filter("w", lambda x: x.rlike(r"\p{L}")))
    return d.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        stop.cast("long").alias("n_stop_words"),
        letters.cast("long").alias("n_letter_words"),
        F.size(F.filter("l", lambda x: x.rlike(r"^[ \t]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("l", lambda x: x.rlike(r"(\.\.\.|…)[ \t\r]*$"))).cast("long").alias("n_ellipsis_lines"),
    )


def verdict_sql(thresholds=THRESHOLDS) -> str:
    """The threshold table as one SQL condition, true if all measures are in range; one with a zero denominator counts as in range."""
    parts = []
    for _, measure, least, most in thresholds:
        top, _, below = measure.partition(" / ")
        parts += [f"{top} >= {least} * {below or 1}"] if least is not None else []
        parts += [f"{top} <= {most} * {below or 1}"] if most is not None else []
    return " AND ".join(parts)


def quality_rules(docs: DataFrame, thresholds=THRESHOLDS, text: str = "text") -> DataFrame:
    """The columns of measures(), base_failed and kept, for each row of docs.

    Words are [^\\x20\\x09-\\x0D]+; a null or empty text has none, and fails. base_failed: fewer than 20 words, or more than 30 % of them in
    8-word windows found twice or more in the text (compared by 64-bit hashes). kept: not base_failed, and within all thresholds.
    Rows are judged one by one, so that repeated rows, null ids and extra columns make no difference.
    """
    m = measures(docs, text).withColumn("base_failed", F.expr(f"n_words < 20 OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"))
    return m.withColumn("kept", F.expr(f"NOT base_failed AND ({verdict_sql(thresholds)})"))
