"""Incremental loading: high-water marks, schema policies, upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.operators.settle import settle
from layercake.sources import catalog
from layercake.sources.footers import stored_max


class SchemaChanged(ValueError):
    """The batch's columns differ from the target's and the policy is ``fail``."""


class RepeatedKey(ValueError):
    """A batch holds the same key twice."""


def high_water_mark(target: DataFrame, column: str, stored: bool = False) -> Any:
    """Largest value of the column in the target, None for an empty one: a single value.

    ``stored`` says that the target is a table as it was written; the mark is then read from the footers of its files.
    """
    return stored_max(target, column) if stored else target.agg(F.max(column)).first()[0]


def new_rows(
    source: DataFrame, target: DataFrame | None, source_col: str, target_col: str, stored: bool = False
) -> DataFrame:
    """Source rows strictly above the target's mark; all of them while the target is empty.

    The mark enters the filter as a literal, so it reaches the scan and whole row groups and files
    below it are skipped. Rows at or below the mark that arrive later are not taken.
    """
    mark = None if target is None else high_water_mark(target, target_col, stored)
    if mark is None:
        return source
    kind = source.schema[source_col].dataType
    return source.where(F.col(source_col) > F.lit(mark).cast(kind))


def reconcile(target: DataFrame, batch: DataFrame, policy: str) -> DataFrame:
    """The target in the batch's columns.

    ``fail`` raises unless names and types agree. ``sync`` adds new columns (NULL in old rows) and
    drops vanished ones.
    """
    if policy == "fail":
        have = {f.name: f.dataType for f in target.schema.fields}
        got = {f.name: f.dataType for f in batch.schema.fields}
        if have != got:
            changed = sorted(set(have.items()) ^ set(got.items()), key=str)
            raise SchemaChanged(f"columns changed: {changed}")
        return target.select(*batch.columns)
    if policy != "sync":
        raise ValueError(f"policy must be 'fail' or 'sync', not {policy!r}")
    columns = [
        F.col(f.name).cast(f.dataType) if f.name in target.columns else F.lit(None).cast(f.dataType)
        for f in batch.schema.fields
    ]
    return target.select(*[c.alias(f.name) for c, f in zip(columns, batch.schema.fields)])


def _require_unique(batch: DataFrame, key: str) -> None:
    repeated = batch.groupBy(key).count().where("count > 1").limit(5).collect()
    if repeated:
        raise RepeatedKey(f"{key} repeats in the batch, for example {[r[0] for r in repeated]}")


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    on_schema_change: str = "fail",
    check_keys: bool = True,
) -> DataFrame:
    """Target rows whose key is not in the batch, and the batch. The first run is the batch."""
    if check_keys:
        _require_unique(batch, key)
    if target is None:
        return batch
    kept = reconcile(target, batch, on_schema_change).join(batch.select(key), key, "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


def read_upserted(spark: SparkSession, target: str) -> DataFrame | None:
    """The table that ``upsert_table`` keeps; None if there is none yet."""
    return catalog.read(spark, target)


def upsert_table(
    batch: DataFrame,
    target: str,
    key: str,
    on_schema_change: str = "fail",
    partition_by: str | None = None,
    key_decides_partition: bool = False,
    properties: Mapping[str, object] | None = None,
    buckets: catalog.Buckets | None = None,
    keys: Sequence[str] = (),
) -> None:
    """Upsert a batch into a table of the catalog, given by name or by folder (read it with ``read_upserted``).

    Only partitions that receive rows or hold a replaced key are rewritten, into new folders; the next version
    takes the others over as they are. A run that dies leaves the last version, and repeating a batch gives the
    same table. Replaced keys are looked up between the smallest and the largest key of the batch, which the
    scan skips files by; not at all where the key decides the partition. Under ``sync`` old rows of
    other partitions show new columns as NULL; a changed type rewrites the whole table. ``buckets`` hold from the first
    run on. ``keys`` are columns of surrogate keys.
    """
    spark = batch.sparkSession
    batch = settle(batch, "batch")
    _require_unique(batch, key)
    before = catalog.newest(spark, target)
    if before is None:
        catalog.commit(batch, target, partition_by, None, properties=properties, buckets=buckets, keys=keys)
        return
    held = catalog.rows(spark, before)
    old = {f.name: f.dataType for f in held.schema.fields}
    same_types = all(old.get(f.name, f.dataType) == f.dataType for f in batch.schema.fields)
    touched = None
    if partition_by and partition_by in old and same_types:
        # Folder names: no more than the table has folders and the batch has partitions.
        names = batch.select(catalog.folder_of(F.col(partition_by)).alias("folder"))
        if not key_decides_partition:
            low, high = batch.agg(F.min(key), F.max(key)).first()
            there = held.select(key, catalog.folder_of(F.col(partition_by)).alias("folder"))
            there = there.where(F.col(key).between(F.lit(low), F.lit(high)) | F.col(key).isNull())
            names = names.union(there.join(batch.select(key), key, "left_semi").select("folder"))
        touched = {row[0] for row in names.distinct().collect()}
    merged = upsert(catalog.rows(spark, before, touched), batch, key, on_schema_change, check_keys=False)
    catalog.commit(merged, target, partition_by, before, touched, properties, before.buckets, keys)


def replace_table(
    rows: DataFrame, target: str, partition_by: str | None = None, properties: Mapping[str, object] | None = None,
    buckets: catalog.Buckets | None = None, keys: Sequence[str] = (),
) -> None:
    """Make ``rows`` the whole table. ``keys`` are columns of surrogate keys."""
    before = catalog.newest(rows.sparkSession, target)
    catalog.commit(rows, target, partition_by, before, properties=properties, buckets=buckets, keys=keys)
