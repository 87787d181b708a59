"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import ann, bpe, collocations, common, hard_negatives, language_id, line_dedup, mixing, ngram_join, packing, pii, quality_rules, substring_dedup, token_store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"))


def op2_balanced_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_equal(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed (lines taken out) and the text that stays, of every document."""
    out = line_dedup.rewrite(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__removed").cast("long").alias("n_removed"), "text")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_folder(spark)
    shards = token_store.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_store.digest(spark, folder, shards)


def op6_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block and slots: source, block (within source and epoch), epoch, slot, release, deadline."""
    plan = mixing.schedule(table(spark, sf_dir, "documents"))
    return plan.select(
        F.col("__id").alias("doc_id"), F.expr("if(__source = '', null, substring(__source, 2))").alias("source"),
        F.col("__block").alias("block"), F.col("__epoch").alias("epoch"), F.col("__slot").alias("slot"),
        F.col("__release").alias("release"), F.col("__deadline").alias("deadline"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("mark")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top(collocations.mine(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_balanced_posting_lists": op2_balanced_posting_lists,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_store": op5_token_store,
    "op6_pfair_mixing": op6_pfair_mixing,
    "op7_language_id": op7_language_id,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_bpe_transducer": op13_bpe_transducer,
}

ORACLES: dict[str, str] = {
    "op11_phrase_collocations": """
WITH words AS (
  SELECT lang, doc, piece, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
    SELECT lang, doc, piece, regexp_extract_all(p, '[^ \\t]+') AS w FROM (
      SELECT lang, doc, unnest(ps) AS p, generate_subscripts(ps, 1) AS piece FROM (
        SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+') AS ps
        FROM documents WHERE text IS NOT NULL)))),
runs AS (
  SELECT lang, word AS w1, lead(word) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY doc, piece ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, 1 AS k, c.f AS a, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON (x.lang, x.w1) = (c.lang, c.w1) JOIN f1 y ON (y.lang, y.w1) = (c.lang, c.w2)
  WHERE c.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w1 = c.w1 AND f3.w2 = c.w2 AND 100 * f3.f >= 50 * c.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w2 = c.w1 AND f3.w3 = c.w2 AND 100 * f3.f >= 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 1, c.f, x.f, y.f
  FROM f3 c JOIN f1 x ON (x.lang, x.w1) = (c.lang, c.w1) JOIN f2 y ON (y.lang, y.w1, y.w2) = (c.lang, c.w2, c.w3)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.f, x.f, y.f
  FROM f3 c JOIN f2 x ON (x.lang, x.w1, x.w2) = (c.lang, c.w1, c.w2) JOIN f1 y ON (y.lang, y.w1) = (c.lang, c.w3)),
scored AS (SELECT *, (1000000::hugeint * a * a) // (l::hugeint * r) AS s FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY s, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY s DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, s::bigint AS score
FROM weakest JOIN n USING (lang) QUALIFY rank <= 2000
""",
    "op12_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT DISTINCT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::bigint AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other)::integer AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score QUALIFY rank <= 3
""",
}
