"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_automaton, chunk_dedup, collision_links, html_extract, language_id, mixing, near_dedup, nearest, quality,
               spelling, suffix_dedup, toxicity, whitening)
from .common import fold, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return f
    return register


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


@query("op4_exact_dedup", EXACT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op6_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "n_blocks")


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = language_id.fit(docs.filter(~held_out))
    return (language_id.identify(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "lang_pred", "score", "ambiguous"))


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe_automaton.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    # grades: 0 poor, 1 well written but toxic, 2 well written and clean
    rating = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    model = quality.fit(docs, labels, rating, keep=~held_out)
    return (quality.grade(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "expected_grade", "p_tail", "selected"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    model = toxicity.fit(docs, labels, keep=~held_out)
    return (toxicity.score(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                    F.size("spans").alias("n_spans"), "spans"))


@query("op5_nearest")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op10_html")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.fit(pages))


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op11_spelling")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN low l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


@query("op13_near_embeddings", LINKS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_links.link(table(spark, sf_dir, "embeddings"))
