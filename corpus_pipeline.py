"""Corpus pipeline: documents in, packed training sequences out.

``STAGES`` are run one after the other, each on what its predecessor kept:
language identification, exact dedup, MinHash near-dedup, redaction of personal
data, best-fit packing. Each takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``documents``.

Decisions go back to the rows by a digest of id and text, so null or repeated
ids and extra columns need no special care; of rows that repeat both, the dedup
stages keep one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settlebook.llm import exact, langid, near, packing, pii
from settlebook.llm.scratch import Scratch, table
from settlebook.operators.split import split_by_keys

KEY = "_settlebook_key"  # a name that no input column has
LEAST_SCORE = 0.3  # a text scored lower is in none of the learned languages


def _digest() -> Column:
    return F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))


def _ordered(docs: DataFrame) -> DataFrame:
    """Texts with a key in the order of their ids (documents without one last) that also names the row."""
    return docs.select(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", _digest().alias("digest")).alias("key"), "text")


def _kept(docs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that a dedup operator kept, once each.

    Only digests that it dropped or that rows repeat need a shuffle; rows of
    others stay where they are. A bitmap tells them apart.
    """
    seen = found.groupBy(F.col("key.digest").alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    marked = scratch.save(seen.where("n > 1 OR NOT kept").select("digest", "kept"), "marked")
    scratch.keep_only("marked")
    plain, others = split_by_keys(docs.withColumn(KEY, _digest()), KEY, marked, "digest")
    dropped = marked.where("NOT kept").select(F.col("digest").alias(KEY))
    return plain.unionByName(others.join(dropped, KEY, "left_anti").dropDuplicates([KEY])).drop(KEY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letters, or a score below ``LEAST_SCORE``."""
    return langid.only_known(docs, langid.fit(docs), LEAST_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each normalised text, that with the smallest id."""
    scratch = Scratch(spark, "pipeline-exact")
    return _kept(docs, exact.dedup(_ordered(docs), scratch, key="key"), scratch)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates (0.8 of five-word shingles), that with the smallest id."""
    scratch = Scratch(spark, "pipeline-near")
    return _kept(docs, near.link(_ordered(docs), scratch, key="key", size=5), scratch)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.redact(docs, Scratch(spark, "pipeline-pii"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences of 2048 ids."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces, Scratch(spark, "pipeline-packing"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("redaction", redaction), ("packing", packed)]

ORACLE_SQL = None  # a learned network, MinHash components and boosted trees: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; every stage is written and read again before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
