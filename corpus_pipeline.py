"""A corpus from raw documents to token ids, stage by stage.

Every stage takes all documents that its predecessor kept, as they were written, and returns the documents it
keeps with all their columns; the last returns their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import bpe, decontaminate, line_runs, lsh_forest, quality
from layercake.llm.common import settle, table

# Neighbour votes and byte-pair merges have no counterpart in SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go."""
    space = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.scored(docs, space, "_score")
    # Without labels nothing is known against any document.
    return (scored.filter(F.col("_score") >= quality.CUT) if space else scored).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat go from all but one; the length follows the text."""
    changed = F.col("_n_dropped") > 0
    kept = line_runs.drop_repeated_lines(docs)
    new = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast(docs.schema["n_chars"].dataType)}
    return kept.select(
        *[F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in docs.columns]
    )


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays of every group of near duplicates (five words, 0.8).

    Only rows whose own text is a copy go: different texts below one id, or without an id, are documents of their own, those
    without an id behind all others.
    """
    key = F.xxhash64("text")
    texts = docs.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    if texts.filter("doc_id IS NULL OR low <> high").isEmpty():
        extra = lsh_forest.near_duplicates(docs).filter(~F.col("kept")).select("doc_id")
        return docs.join(extra.distinct(), "doc_id", "left_anti").select(docs.columns)
    keyed = docs.select(F.col("doc_id").alias("_id"), key.alias("_k")).distinct()
    # Numbered in the order of the ids, so that the smallest stays.
    ranked = keyed.orderBy(F.col("_id").asc_nulls_last(), "_k").withColumn("_node", F.monotonically_increasing_id())
    ranked = settle(ranked, "text-numbers")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_k"))
    numbered = settle(docs.join(ranked, same).select(F.col("_node").alias("doc_id"), "text"), "numbered-texts")
    copies = lsh_forest.near_duplicates(numbered).filter(~F.col("kept")).select(F.col("doc_id").alias("_node")).distinct()
    return docs.join(ranked.join(copies, "_node", "left_semi"), same, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the bytes they decode to."""
    vocabulary = bpe.read_vocabulary()
    return bpe.digests(bpe.decode(bpe.encode(docs, vocabulary), vocabulary), keep_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
