"""The registered queries of this subpackage: every operator at work on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import (
    bpe, chunk_reuse, decontaminate, language, line_runs, lm_scoring, lsh_forest, pivots, quality, rotation, shards,
    spelling, token_counts,
)
from layercake.llm.common import settle, table


def op1_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op2_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_repeated_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after first guesses, counts in parts, a part sent twice, and a part withdrawn and restored."""
    docs = table(spark, sf_dir, "documents")
    counts = settle(
        token_counts.count_tokens(docs, bpe.read_vocabulary(), "byte_bpe_multi_50k"), "token-counts"
    ).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)))
    rollup = token_counts.Rollup(spark, dict(docs.dtypes)["doc_id"])
    part = [counts.filter(F.col("part") == i) for i in range(3)]
    rollup.commit("guesses", part[0].withColumn("n_tokens", F.ceil(F.col("n_bytes") / 4)))
    for i in (0, 1, 1, 2):
        rollup.commit(f"counts-{i}", part[i])
    rollup.commit("withdrawn", gone=part[2])
    rollup.commit("restored", part[2])
    return rollup.totals()


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary()
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary))


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return lm_scoring.word_cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), typo_every=97)


def op12_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = chunk_reuse.ByteBpe.read()
    encoded = chunk_reuse.encode(table(spark, sf_dir, "documents"), tokenizer)
    return bpe.digests(chunk_reuse.decode(encoded, tokenizer))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = rotation.restored(rotation.transform(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


QUERIES = {
    query.__name__: query
    for query in (
        op1_lsh_forest, op2_pivot_index, op3_quality, op4_language_fusion, op5_byte_shards, op6_line_dedup,
        op7_token_rollup, op8_byte_bpe, op9_cross_entropy_difference, op10_decontamination, op11_spelling_variants,
        op12_chunk_reuse, op13_fill_in_middle,
    )
}
