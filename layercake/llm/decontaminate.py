"""Benchmark passages in documents: a prefix-filtered join with exact checks, in DataFrame functions.

Every benchmark item gives windows of ``width`` consecutive words (a shorter item is one window). A
document can hold a window only if it holds each of its words, so one of them, the rarest in all
documents, is enough to find it: the prefix. The words of the documents meet the windows on that word;
where one matches, the window can begin at one place only, which must lie inside the document
(positional and length bounds), and there the words are compared one by one.

The windows are broadcast in slices of at most ``SLICE_BYTES``; a benchmark of any size is so many passes
over the documents. A document is compared where it lies, so texts are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layercake.llm.common import ascii_lower, settle

WIDTH = 10
SLICE_BYTES = 64_000_000

# Fixed by the contract: a word is a run of 0-9, a-z and everything beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), _BETWEEN), "")


def count_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), _BETWEEN_ANY_CASE)
    return F.size(F.array_remove(parts, "")).cast("long")


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``item_id``, ``window`` (words), ``win`` (a digest that names equal windows); none without words."""
    last = F.greatest(F.size("w") - width, F.lit(0))
    return (
        benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
        .select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
        .select("item_id", F.slice("w", F.col("i") + 1, F.lit(width)).alias("window"))
        .withColumn("win", F.md5(F.array_join("window", " ")))
        .distinct()
    )


def _slices(found: DataFrame) -> int:
    size = found.agg(F.sum(F.length(F.array_join("window", " ")) + 100).alias("b")).first()["b"] or 0
    return 1 + size // SLICE_BYTES


def occurrences(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: (``doc_id``, ``k``, ``start``, ``len``) and which items (``doc_id``, ``k``, ``item_id``).

    ``k`` is a hash of the text; with the id it tells documents apart even where ids repeat.
    """
    found = settle(found, "windows")
    n = _slices(found)
    texts = docs.select("doc_id", F.xxhash64("text").alias("k"), words(F.col("text")).alias("w"))
    at_words = texts.select("doc_id", "k", "w", F.posexplode("w").alias("pos", "word"))

    vocabulary = found.select(F.explode("window").alias("word")).distinct()

    def part(table: DataFrame, i: int) -> DataFrame:
        return F.broadcast(table.filter(F.pmod(F.xxhash64("word"), F.lit(n)) == i))

    # Rarity over all documents. A word that no document holds rules its windows out.
    counts = reduce(DataFrame.unionByName, (
        at_words.select("word").join(part(vocabulary, i), "word").groupBy("word").agg(F.count("*").alias("df"))
        for i in range(n)
    ))
    counts = settle(counts, "rarity")
    ranked = (
        found.select("win", "window").distinct()
        .select("win", "window", F.posexplode("window").alias("offset", "word"))
        .join(counts, "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        .groupBy("win", "window").agg(F.min(F.struct("df", "word", "offset")).alias("rarest"))
    )
    prefixes = settle(
        ranked.filter("rarest.df > 0").select("win", "window", "rarest.word", "rarest.offset"), "prefixes"
    )

    begin = F.col("pos") - F.col("offset")
    matched = [
        at_words.join(
            part(prefixes, i).withColumnRenamed("word", "prefix"),
            (F.col("word") == F.col("prefix"))
            & (begin >= 0)
            & (begin + F.size("window") <= F.size("w"))
            & F.when(begin >= 0, F.slice("w", F.greatest(begin, F.lit(0)) + 1, F.size("window")) == F.col("window")),
        ).select("doc_id", "k", begin.alias("start"), F.size("window").alias("len"), "win")
        for i in range(n)
    ]
    hits = settle(reduce(DataFrame.unionByName, matched), "hits")
    of_items = found.select("win", "item_id").distinct()
    by_win = lambda table, i: table.filter(F.pmod(F.xxhash64("win"), F.lit(n)) == i)
    pairs = hits.select("doc_id", "k", "win").distinct()
    items = reduce(DataFrame.unionByName, (
        by_win(pairs, i).join(F.broadcast(by_win(of_items, i)), "win").select("doc_id", "k", "item_id")
        for i in range(n)
    ))
    return hits.select("doc_id", "k", "start", "len").distinct(), items.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (sorted texts), ``contaminated``.

    ``n_hit`` counts the words inside any occurrence of any window; overlaps count once. Null and empty
    texts have no words; items without words match nothing; windows of an item with a null id hit, but are
    not counted as an item. Repeated rows all come out, each with the same figures. Only ``doc_id``,
    ``item_id`` and ``text`` are read.
    """
    hits, items = occurrences(docs, windows(benchmark, width))
    in_doc = W.partitionBy("doc_id", "k").orderBy("start", "len")
    before = F.max(F.col("start") + F.col("len")).over(in_doc.rowsBetween(W.unboundedPreceding, -1))
    covered = (
        hits.withColumn("seen", F.coalesce(before, F.lit(0)))
        .withColumn("new", F.greatest(F.col("start") + F.col("len") - F.greatest("seen", "start"), F.lit(0)))
        .groupBy("doc_id", "k").agg(F.sum("new").alias("n_hit"))
    )
    named = items.groupBy("doc_id", "k").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    found = _join_null_safe(covered, named)
    counted = docs.select("doc_id", F.xxhash64("text").alias("k"), count_words(F.col("text")).alias("n_words"))
    none = F.array().cast("array<string>")
    return _join_null_safe(counted, found).select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark."""
    hits, _ = occurrences(docs, windows(benchmark, width))
    hit = hits.select(F.col("doc_id").alias("_hit_id"), F.col("k").alias("_hit_k")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_hit_id")) & (F.xxhash64("text") == F.col("_hit_k"))
    return docs.join(hit, same, "left_anti")


def _join_null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnsRenamed({"doc_id": "right_id", "k": "right_k"})
    same = F.col("doc_id").eqNullSafe(F.col("right_id")) & (F.col("k") == F.col("right_k"))
    return left.join(right, same, "left").drop("right_id", "right_k")
