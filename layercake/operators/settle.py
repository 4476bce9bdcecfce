"""Write an intermediate result once, where several branches of a job read it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from layercake.session import INTERMEDIATE_CODEC, shared_dir


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as parquet in the shared folder.

    Cuts lineage: executors lost later cost a re-read, and the branches that follow prune columns
    on their own instead of recomputing the scan.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.mode("overwrite").option("compression", INTERMEDIATE_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
