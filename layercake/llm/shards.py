"""Contiguous shards of equal bytes from global prefix sums, in DataFrame functions.

The documents are put in one total order (digest of the text, then id, so copies lie side by side) by a
range partitioning of narrow rows. The totals of the partitions, one small row each, give every
partition its first byte; running sums inside the partitions give every document its own. A
document belongs to the shard in whose equal share of all bytes its first byte falls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layercake.llm.common import settle

SHARDS = 40
# Bytes of a record beside its text (fixed by the contract).
OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` (from 0 in each shard) for every row.

    ``size``: UTF-8 bytes of the text plus ``overhead``. No two shards differ by more than twice the largest
    row. Equal texts are neighbours: only a cut that falls among copies parts them, so a group of
    copies of any size is balanced too. A null text has size ``overhead``, CRC 0 and comes first; null ids
    come first among copies; equal rows come out in any order among themselves, each with a slot of its
    own. An empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.md5("text").alias("digest"),
    )
    # Written, so that the partitions stay as they are when an executor is lost.
    placed = settle(
        narrow.repartitionByRange(n, "digest", "doc_id", "size").withColumn("part", F.spark_partition_id()), "placed"
    )
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition, however many documents there are.
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(W.partitionBy()).alias("all_bytes"),
    )
    in_part = W.partitionBy("part").orderBy(F.col("digest").asc_nulls_first(), F.col("doc_id").asc_nulls_first())
    running = placed.withColumn(
        "upto", F.sum("size").over(in_part.rowsBetween(W.unboundedPreceding, W.currentRow))
    ).withColumn("nth", F.row_number().over(in_part))
    first_byte = F.col("bytes_before") + F.col("upto") - F.col("size")
    positions = settle(
        running.join(F.broadcast(offsets), "part").select(
            "doc_id", "size", "text_crc32",
            F.floor(first_byte.cast("decimal(38,0)") * shards / F.col("all_bytes")).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        ),
        "positions",
    )
    firsts = positions.groupBy("shard").agg(F.min("place").alias("first_place"))
    return positions.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
