"""Corpus preparation: five stages from ``documents`` to token counts and digests.

language ID -> exact dedup -> near-duplicate groups -> mixing to source
targets -> BPE encoding. Each stage takes (spark, docs, sf_dir) and returns
a DataFrame that is written before the next one reads it; all but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelife.llm import bpe_automaton, chunk_dedup, language_id, mixing, near_dedup
from devicelife.llm.common import cut, fold, ship, table

#: The mix and the near-duplicate groups have no SQL form.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts whose language is ambiguous go."""
    ship(spark)
    model = language_id.fit(docs.filter(fold("doc_id", 4) != 2))
    named = language_id.identify(docs, model, keep=tuple(docs.columns), names=("__lang", "__score", "__ambiguous"))
    return named.filter((F.col("__lang") != language_id.UND) & ~F.col("__ambiguous")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (white space aside) stays."""
    ship(spark)
    return chunk_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    ship(spark)
    return near_dedup.one_of_each_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each whole use of a document, and one for words taken besides."""
    ship(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text."""
    import public_tokenizers
    ship(spark)
    return bpe_automaton.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("exact dedup", exact), ("near dedup", near), ("mixing", mixture), ("BPE encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
