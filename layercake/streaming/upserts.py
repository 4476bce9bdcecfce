"""A file stream cleaned by a model and upserted into a table, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from layercake.operators.incremental import new_rows, read_upserted, upsert_table


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None,
    source_format: str = "parquet", **options: str,
) -> DataFrame:
    """Rows of the files that arrive in a folder, each file once."""
    reader = spark.readStream.schema(schema).format(source_format).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def upsert_stream(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    key: str,
    checkpoint: str,
    on_schema_change: str = "fail",
    partition_by: str | None = None,
    mark: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Take what is there, upsert it, stop. Started again, it goes on after the last batch.

    A batch is written as one version, so one that is repeated after a failure finds the table as it was, or
    replaces the same keys. With ``mark`` (source column, target column) rows at or below the target's
    high-water mark are ignored, as in the batch load.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if mark is not None:
            batch = new_rows(batch, read_upserted(batch.sparkSession, target), *mark)
        upsert_table(transform(batch), target, key, on_schema_change, partition_by)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

