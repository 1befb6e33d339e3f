"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

1. A text is normalised (white space deleted) and cut into chunks at
   content-defined boundaries: a chunk ends after the first ``boundary``
   match at least ``low`` characters into it, or after ``high`` characters.
   Boundaries depend on the characters around them only.
2. Chunks are deduplicated to *verified* identifiers: the distinct chunk
   texts are grouped by their 64-bit hash; a hash with one text is its
   identifier, a hash that several texts share gets a number per text. The
   chunk texts are moved once, and equal chunks (copies) before that only
   once per task.
3. A recipe is the ordered list of a document's chunk identifiers. Equal
   normalised texts have equal recipes and, as identifiers are verified,
   equal recipes have equal texts. Only recipes (8 bytes a chunk) are
   compared and joined, never the long documents.

The group's row with the most code points in the original text stays, then
the one with the smallest id. Hot groups: counting and choosing are partial
aggregates; the join back is on the recipe, which adaptive execution splits
where one group is large.

Edge cases: a null text counts as empty; all empty texts form one group; a
null id sorts after all others; of repeated rows (same id and text) one
stays; texts shorter than ``low`` are one chunk; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, cut, text_or_empty


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text_col), F.lit(SPACE_CLASS + "+"), F.lit(""))


def chunk_pattern(low: int, high: int, boundary: str) -> str:
    return f"(?s).{{{low},{high}}}?{boundary}|.{{1,{high}}}"


def chunks(norm: Column, low: int, high: int, boundary: str) -> Column:
    """The chunks of a normalised text, in order; their concatenation is the text."""
    return F.regexp_extract_all(norm, F.lit(chunk_pattern(low, high, boundary)), F.lit(0))


#: A boundary: a letter whose code point is 3 modulo 8, then one whose code point is 4 or 5 modulo 8 (ASCII
#: and Latin-1 letters). Texts without such letters are cut every ``high`` characters.
BOUNDARY = "[cksCKSãëóû][delmtuDELMTUäåìíôõüý]"


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = 128, high: int = 1024,
                 boundary: str = BOUNDARY, chunk_hash=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, n_chunks.

    ``chunk_hash`` maps a chunk to a long; a poor one costs time, not correctness.
    """
    norm = docs.select(F.col(id_col).alias("_id"), F.char_length(text_or_empty(text_col)).alias("_len"),
                       normalised(text_col).alias("_norm"))
    cutup = norm.select("_id", "_len", F.sha2("_norm", 256).alias("text_sha256"),
                        chunks(F.col("_norm"), low, high, boundary).alias("_chunks"))

    # distinct chunk texts; those that share a hash with another text are numbered
    texts = (norm.select(F.explode(chunks(F.col("_norm"), low, high, boundary)).alias("_chunk"))
             .select(chunk_hash(F.col("_chunk")).alias("_hash"), "_chunk").distinct())
    shared = texts.groupBy("_hash").agg(F.count("*").alias("_texts")).filter("_texts > 1").select("_hash")
    numbered = cut(texts.join(shared, "_hash", "left_semi")
                   .withColumn("_no", F.row_number().over(Window.partitionBy("_hash").orderBy("_chunk"))))
    recipes = _recipes(cutup, numbered, chunk_hash)

    summary = recipes.groupBy("_recipe").agg(
        F.max(F.struct("_len", F.bitwise_not("_id").alias("_rev"))).alias("_best"), F.count("*").alias("group_size"))
    summary = summary.select("_recipe", F.bitwise_not(F.col("_best._rev")).alias("keep_id"),
                             F.col("_best._len").alias("_keep_len"), "group_size")
    # repeated rows of one id: the longest (any of equal ones) stands for it
    same = Window.partitionBy("_id", "text_sha256").orderBy(F.col("_len").desc())
    rows = recipes.withColumn("_copy", F.row_number().over(same))
    kept = F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_len") == F.col("_keep_len")) & (F.col("_copy") == 1)
    return rows.join(summary, "_recipe").select(
        F.col("_id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256",
        F.size("_recipe").cast("long").alias("n_chunks"))


def _recipes(cutup: DataFrame, numbered: DataFrame, chunk_hash) -> DataFrame:
    """Documents with their lists of verified identifiers.

    An identifier is the chunk's hash, or (hash, number) written as one
    decimal for chunks whose hash is shared. Hash sharing among 64-bit values
    is so rare that ``numbered`` is nearly always empty; it is joined only to
    the documents' chunks with a shared hash.
    """
    plain = cutup.select("_id", "_len", "text_sha256",
                         F.transform("_chunks", lambda c: chunk_hash(c).cast("string")).alias("_recipe"), "_chunks")
    if numbered.isEmpty():
        return cut(plain.select("_id", "_len", "text_sha256",
                                F.transform("_chunks", lambda c: chunk_hash(c)).alias("_recipe")))
    plain = cut(plain.withColumn("_row", F.struct("_id", "_len", "text_sha256")))
    hot = (plain.select("_row", F.posexplode("_chunks").alias("_pos", "_chunk"))
           .withColumn("_hash", chunk_hash(F.col("_chunk")))
           .join(numbered, ["_hash", "_chunk"]).select("_row", "_pos", F.concat_ws(":", F.col("_hash"), F.col("_no")).alias("_ident"))
           .distinct().groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_ident"))).alias("_named")))
    joined = plain.join(hot.withColumnRenamed("_row", "_other"), F.col("_row").eqNullSafe(F.col("_other")), "left")
    return joined.select("_id", "_len", "text_sha256", F.transform(
        "_recipe", lambda ident, i: F.coalesce(F.element_at("_named", i), ident)).alias("_recipe"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col, **settings).filter("kept")
    kept = cut(kept.select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")))
    if docs.groupBy(id_col).count().filter("count > 1").isEmpty():
        return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)
    # ids that repeat: also by content, and one of the rows that repeat both
    own = docs.withColumn("__own", F.sha2(normalised(text_col), 256))
    own = own.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha")), "left_semi")
    first = Window.partitionBy(id_col, "__own").orderBy(F.char_length(text_col).desc_nulls_last(), *docs.columns)
    return own.withColumn("__copy", F.row_number().over(first)).filter(F.col("__copy") == 1).select(*docs.columns)
