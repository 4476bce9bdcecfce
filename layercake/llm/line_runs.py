"""Line deduplication with levelled sorted runs of line hashes, in DataFrame functions.

A run has one row per line key of some batches: its hash (128 bits), the number of documents that hold it and the
largest id among them. It is a table in buckets by the hash, sorted in each. Each batch becomes such a table and meets the
runs in merge anti-joins, one after the other and without a shuffle: the keys that are left are the batch's new lines
and make its run; what the batch adds to the counts of known keys goes beside it. Both come to level 0. Once a level has ``fanout`` of them they are merged into one run of the next
level, so there are never more than ``fanout`` times the number of levels, and a key is rewritten once per level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm.common import ascii_lower, broadcast_within, settle
from layercake.session import shared_dir

# Fixed by the contract: what is stripped from a line, and which keys count.
BLANKS = " \t\n\x0b\x0c\r"
MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2

_RUN = "h1 long, h2 long, n_docs long, keeper {kind}"


def lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_keys(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per long line: ``doc_id``, ``k`` (hash of the text), ``pos``, ``h1``, ``h2``, ``first`` in its document."""
    keys = F.transform(lines(F.col("text")), line_key)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("k"), F.posexplode(keys).alias("pos", "key"))
        .filter(F.length("key") >= min_length)
        .select("doc_id", "k", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    )


class LineRuns:
    """The runs of one corpus, in the shared folder (or under ``root``), known to the catalog while the session lasts.

    Null ids count as documents and are below every other id.
    """

    def __init__(self, spark: SparkSession, kind: str, root: str | None = None, fanout: int = FANOUT) -> None:
        self.spark, self.kind, self.fanout = spark, kind, fanout
        self.root = root or shared_dir(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # By level, the tables of each run: new keys, and additions to known ones.
        self.levels: list[list[list[str]]] = []
        spark.sql("CREATE SCHEMA IF NOT EXISTS layercake")
        # Spark 4.1 takes a union of bucketed scans for bucketed but only appends their partitions, so sums over
        # it would be wrong without a shuffle.
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")

    def add(self, keys: DataFrame) -> DataFrame:
        """Add the run of a batch of ``line_keys`` and return it: the keys that no earlier batch had.

        A line that a document repeats counts once in it.
        """
        once = keys.groupBy("h1", "h2", "doc_id", "k").agg(F.lit(1).alias("one"))
        counted = once.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        batch = self.spark.table(self._write(counted))
        if not self.levels:
            self._place([self._write(batch)], 0)
            return batch
        new = self._write(self.new_lines(batch))
        more = self._write(self._without(batch, new))
        self._place([new, more], 0)
        return self.spark.table(new)

    def total(self) -> DataFrame:
        """All runs merged: ``h1``, ``h2``, ``n_docs``, ``keeper``."""
        return self._merged(self._tables())

    def seen_before(self, keys: DataFrame, min_docs: int = 1) -> DataFrame:
        """Lines of ``keys`` whose hash lies in the runs, with ``n_docs`` and ``keeper``.

        A very common line is split like any skewed join key, as both sides are shuffled where the common keys are too
        many to broadcast.
        """
        heavy = settle(self.total().filter(F.col("n_docs") >= min_docs), "common-lines")
        return keys.join(broadcast_within(heavy, 64), ["h1", "h2"])

    def new_lines(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` that no run holds (merge anti-joins)."""
        return reduce(self._without, self._tables(), keys)

    def _without(self, keys: DataFrame, name: str) -> DataFrame:
        return keys.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")

    def _tables(self) -> list[str]:
        return [name for level in self.levels for run in level for name in run]

    def _place(self, run: list[str], level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged([name for run in self.levels[level] for name in run]))
            self.levels[level] = []
            self._place([merged], level + 1)

    def _merged(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], _RUN.format(kind=self.kind))
        runs = reduce(DataFrame.unionByName, [self.spark.table(name) for name in names])
        return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def _write(self, run: DataFrame) -> str:
        name = f"run_{uuid.uuid4().hex}"
        dealt = run.select("h1", "h2", "n_docs", "keeper").repartition(self.buckets, "h1", "h2")
        dealt.write.format("parquet").option("path", f"{self.root}/{name}").bucketBy(
            self.buckets, "h1", "h2"
        ).sortBy("h1", "h2").saveAsTable(f"layercake.{name}")
        return f"layercake.{name}"


def repeated_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """Lines to drop: ``doc_id``, ``k``, ``drops`` (sorted positions), from runs fed batch by batch."""
    keys = settle(line_keys(docs, min_length), "line-keys")
    runs = LineRuns(docs.sparkSession, docs.schema["doc_id"].dataType.simpleString())
    for i in range(batches):
        runs.add(keys.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    return (
        runs.seen_before(keys, min_docs).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "k").agg(F.array_sort(F.collect_set("pos")).alias("drops"))
    )


def drop_repeated_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """All columns of ``docs`` with ``_kept`` (text), ``_n_lines`` and ``_n_dropped``.

    A line's key is the line stripped of blanks at both ends, A-Z in lower case. Keys of at least
    ``min_length`` code points that at least ``min_docs`` documents hold lose their lines in all
    documents but the one with the largest id. Null and empty texts have one empty line and are kept as
    an empty text. Rows that repeat an id count as further documents; rows that are equal altogether
    count as one, and all rows with the largest id keep the line. Only ``doc_id`` and ``text`` matter.
    """
    drops = repeated_lines(docs, min_length, min_docs, batches).select(
        F.col("doc_id").alias("_id"), F.col("k").alias("_k"), F.col("drops").alias("_drops")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_k"))
    parts = lines(F.col("text"))
    starts = F.array_prepend(F.transform("_drops", lambda p: p + 1), F.lit(0))
    ends = F.array_append(F.col("_drops"), F.size(parts))
    segments = F.zip_with(starts, ends, lambda start, end: F.slice(F.col("_lines"), start + 1, end - start))
    joined = docs.join(drops.hint("shuffle_hash"), same, "left").withColumn("_lines", parts)
    return joined.select(
        *[docs[name] for name in docs.columns],
        F.when(F.col("_drops").isNull(), F.coalesce(docs["text"], F.lit("")))
        .otherwise(F.array_join(F.flatten(segments), "\n")).alias("_kept"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.size(F.coalesce("_drops", F.array().cast("array<int>"))).cast("long").alias("_n_dropped"),
    )
