"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, audit, chunks, licenses, lines, minhash, mixing, packing, pii, quality, rules, suffix, vectors


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked at a similarity of 0.85 on 3-word shingles."""
    return minhash.near_duplicates(documents(spark, sf_dir), k=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    cols = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    return rules.quality_rules(documents(spark, sf_dir)).select(*cols)


_LIST = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i : i + 7], ' ')) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM k, range(8) AS t(o) WHERE c > 1 GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  len(list_filter(w, lambda x: x IN ({_LIST}))) AS n_stop_words, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
  len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) AS n_bullet_lines, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS n_ellipsis_lines
  FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > {rules.REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ({rules.verdict_sql()}) AS kept FROM f
"""


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: repeated strings of 200 bytes removed."""
    return suffix.drop_repeats(documents(spark, sf_dir)).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256: lines found in three documents stay in the last only."""
    left = lines.dedup_lines(documents(spark, sf_dir))
    return left.select("rest.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, top IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY 1
"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: quality as labels mark it, learnt from rows that are not held out."""
    docs = documents(spark, sf_dir)
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select("doc_id", "text"), weights).select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, license, n_shared, n_template: license wordings that a document holds."""
    return licenses.scan_licenses(documents(spark, sf_dir))


def _words(name: str, col: str) -> str:
    return f"regexp_extract_all(translate(coalesce({col}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS {name}"


_LENGTHS = licenses.by_length(licenses.TEMPLATES)
_VALUES = ", ".join(f"('{n}', {k}, '" + t.replace("'", "''") + "')" for k, some in _LENGTHS.items() for n, t in some.items())
_SHINGLES = "unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g"
OP3_SQL = f"""
WITH t AS (SELECT DISTINCT license, k, {_SHINGLES} FROM (SELECT license, k, {_words('w', 'wording')} FROM (VALUES {_VALUES}) AS v(license, k, wording))),
n AS (SELECT license, count(*) AS n_template FROM t GROUP BY 1),
d AS (SELECT DISTINCT doc_id, k, {_SHINGLES} FROM (SELECT doc_id, unnest({sorted(_LENGTHS)}) AS k, {_words('w', 'text')} FROM documents))
SELECT doc_id, license, count(*) AS n_shared, any_value(n_template) AS n_template FROM d JOIN t USING (k, g) JOIN n USING (license)
GROUP BY 1, 2 HAVING 100 * count(*) >= {licenses.PERCENT} * any_value(n_template)
"""


def tokenizer(name: str) -> str:
    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: documents in sequences of 1024 tokens."""
    return packing.best_fit_pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), payload=(packing.crc32, "ids_crc32", "long"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: personal data and the terms that disclose it."""
    return pii.span_columns(pii.personal_spans(documents(spark, sf_dir)))


def _digests(ids: list, bpe) -> tuple:
    return sha256(" ".join(map(bpe.digits.__getitem__, ids)).encode()).hexdigest(), sha256(bpe.decode(ids).encode()).hexdigest()


def op7_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts encoded and decoded with reuse of chunks."""
    columns = ("ids_sha256", "string"), ("decoded_sha256", "string")
    return chunks.encode_decode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), _digests, columns)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors linked at a cosine of 0.95."""
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM s a JOIN s b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0 WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.x = vec_id) AS n_links, min(root) AS component_id, min(root) = vec_id AS kept
FROM embeddings JOIN r ON node = vec_id GROUP BY vec_id
"""


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: five filters in all orders."""
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("filter")


OP11_SQL = r"""
WITH l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
c AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [a.i, b.i, c3.i, e.i, g.i] AS p FROM c a, c b, c c3, c e, c g WHERE len(list_distinct([a.i, b.i, c3.i, e.i, g.i])) = 5),
s AS (SELECT array_to_string(list_transform(p, lambda x: chr(65 + x::INT)), '') AS filter_order, k AS step, p[k] AS i, (1 << p[k])::INT AS bit, coalesce(list_sum(list_transform(p[: k - 1], lambda x: (1 << x)::INT)), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS k)),
r AS (SELECT part, filter_order, step, i, sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost FROM m, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley FROM r
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: two tokenizers aligned by bytes."""
    found = alignment.align_tokens(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), derive=alignment.digest)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.coalesce("groups", F.lit("")).alias("groups_sha256"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, position: sources mixed by a curriculum, documents in the order of their first copy in training."""
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", F.expr("get(copies, 0).position").alias("position"), "tie").orderBy(F.col("position").asc_nulls_last(), "tie").drop("tie")


OP13_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(doc_id::VARCHAR, '')) || md5(coalesce(text, '')) AS tie FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS slot FROM d GROUP BY 1),
w AS (SELECT *, [3.0, 1.0, 2.0][slot + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS mixed FROM s),
u AS (SELECT *, mixed - (sum(most) OVER o - most) AS lefts, sum(weight) OVER () - sum(weight) OVER o + weight AS heavy FROM w WINDOW o AS (ORDER BY source_size / weight, source ROWS UNBOUNDED PRECEDING)),
v AS (SELECT *, most * heavy <= weight * lefts AS stops FROM u),
t AS (SELECT *, CASE WHEN stops THEN most ELSE (mixed - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ()) * weight / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () END AS target FROM v),
p AS (SELECT d.*, source_size, target, mixed, weight, slot, floor(target)::BIGINT AS need, (sum(size) OVER (PARTITION BY d.source ORDER BY tie ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, greatest(0, least(size, need - start)) AS once, greatest(0, least(size, need - start - source_size)) AS again FROM p),
q AS (SELECT *, CASE WHEN once > 0 THEN weight * (start + once / 2.0::DOUBLE) / need END AS y FROM c),
k AS (SELECT *, CASE slot WHEN 0 THEN 2 * y / (4.5::DOUBLE + sqrt(20.25::DOUBLE - 6 * y)) WHEN 1 THEN 2 * y / 2
  ELSE CASE WHEN y < 0.75 THEN 2 * y / (1 + sqrt(1 + 4 * y)) ELSE 0.5::DOUBLE + 2 * (y - 0.75::DOUBLE) / (2 + sqrt(4 + 4 * (y - 0.75::DOUBLE))) END END AS time FROM q)
SELECT doc_id, size, source_size, target, (once + again)::BIGINT AS taken, floor(time * mixed)::BIGINT AS position FROM k
"""


def queries() -> dict:
    own = (
        op1_minhash_dedup, op2_quality_classifier, op3_license_scan, op4_best_fit_packing, op5_pii, op6_quality_rules, op7_bpe_chunks, op8_embedding_dedup,
        op9_suffix_dedup, op10_line_dedup, op11_filter_audit, op12_token_alignment, op13_source_mix,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict:
    return {"op1_minhash_dedup": OP1_SQL, "op3_license_scan": OP3_SQL, "op6_quality_rules": OP6_SQL, "op8_embedding_dedup": OP8_SQL, "op10_line_dedup": OP10_SQL, "op11_filter_audit": OP11_SQL, "op13_source_mix": OP13_SQL}
