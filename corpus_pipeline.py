"""The corpus pipeline: quality classifier, line dedup, near-dedup, PII and packing, each stage over all that its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import lines, minhash, packing, pii, quality, queries
from tickloom.llm.common import as_struct, field, materialize, quoted, written
from tickloom.scratch import discard, watch

#: Documents scored below this probability of being good go.
LEAST_SCORE = 0.3


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that docs has not."""
    while name in docs.columns:
        name += "_"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, does not reject.

    Every row is judged by its own text: repeated rows and rows without a doc_id as well; empty and null texts stay, as do all rows where
    nothing is labelled. All columns stay as they are, a column `score` among them.
    """
    weights, into = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), fresh(docs, "score")
    return quality.score(docs, weights, into=into).where(quoted(into) >= LEAST_SCORE).select(*map(quoted, docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that three documents or more hold, except in the last that holds them; see dedup_lines for odd rows."""
    left = lines.dedup_lines(docs)
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[made.get(c, field("rest", c)).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least doc_id and, of its rows, the least text hash.

    Rows go by doc_id and text, so where a doc_id stands for several texts only those go that are copies. A row that repeats with its
    doc_id and text stays once; documents without words and rows without a doc_id stay.
    """
    marked = materialize(minhash.near_duplicates(docs).where("component is not null").select("doc_id", "th", "component").distinct())
    winners = marked.groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("w")).select("w.doc_id", "w.th")
    gone = marked.select("doc_id", "th").join(winners, ["doc_id", "th"], "left_anti")
    rows = docs.select(as_struct(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    left = rows.where("doc_id is not null").join(gone, ["doc_id", "th"], "left_anti")
    once = left.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("th"))).where("n = 1")
    return once.select("row").unionByName(rows.where("doc_id is null").select("row")).select(*[field("row", c).alias(c) for c in docs.columns])


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and the terms that disclose it replaced; repeated rows alike, null texts stay null."""
    clean = pii.sanitise(docs)
    made = {"n_chars": F.length("text").cast("long")}
    return clean.select(*[made.get(c, quoted(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 1024; each row for itself, whatever its doc_id, an empty or null text as the end token alone."""
    return packing.best_fit_pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES = [("quality classifier", keep_good), ("line dedup", drop_lines), ("MinHash near-dedup", drop_copies), ("PII", hide_personal_data), ("best-fit packing", pack)]
#: SQL can express neither the classifier nor the tokens; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. What a stage wrote for itself is deleted once its result is written; the last one's tables stay for the reader."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for i, (_, stage) in enumerate(STAGES):
        if i == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with watch() as made:
            docs, path = written(stage(spark, docs, sf_dir))
        discard(spark, *held, *(p for p in made if p != path))
        held = [path]
    return docs
