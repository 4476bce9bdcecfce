"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch states the new counts of some documents, or that they are gone. Its delta takes back what the ledger
holds of those documents and adds what the batch says; totals are sums of deltas, so they never need a recount.
A batch writes its ledger rows first and its rollup rows last, each to a folder of its own; it is committed once the
rollup is complete (Spark's success mark). Only committed batches are read. So a batch that failed halfway is
simply sent again, and one that is sent twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm.bpe import Vocabulary, _encoding
from layercake.llm.common import light_batches
from layercake.session import shared_dir

KEYS = ("source", "lang", "version")
MEASURES = ("n_tokens", "n_bytes")


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, version: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``version``, ``n_tokens``, ``n_bytes`` for every row; null texts count 0."""
    light_batches(docs.sparkSession)
    shared = vocabulary.share(docs.sparkSession)
    kept = ("doc_id", "source", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept),
                 pa.array([len(encoding.encode_ordinary(text)) for text in texts], pa.int64()),
                 pa.array([len(text.encode("utf-8", "surrogatepass")) for text in texts], pa.int64())],
                [*kept, *MEASURES],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in kept), "n_tokens long", "n_bytes long"])
    return docs.select(*kept, "text").mapInArrow(count, schema).select(
        *kept, F.lit(version).alias("version"), *MEASURES
    )


class Rollup:
    """Ledger and totals under ``root`` (a folder that all executors reach).

    The ledger holds signed rows: what counts for a document is what is left when its rows are added up.
    """

    def __init__(self, spark: SparkSession, doc_id_type: str = "bigint", root: str | None = None) -> None:
        self.spark, self.root = spark, root or shared_dir(spark, "token-rollup")
        measures = "n_tokens long, n_bytes long, sign int"
        self._ledger_schema = f"doc_id {doc_id_type}, source string, lang string, version string, {measures}"
        self._rollup_schema = "source string, lang string, version string, n_docs long, n_tokens long, n_bytes long"

    def committed(self) -> list[str]:
        """Ids of the committed batches."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/rollup/*/_SUCCESS")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(status.getPath().getParent().getName() for status in system.globStatus(path) or [])

    def current(self) -> DataFrame:
        """Counts of every document that is there, one row per document and version."""
        return self._net(self._read("ledger", self._ledger_schema))

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``version``, ``n_docs``, ``n_tokens``, ``n_bytes``; keys without documents are left out."""
        deltas = self._read("rollup", self._rollup_schema)
        sums = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", *MEASURES)])
        return sums.filter("n_docs <> 0")

    def commit(self, batch: str, counts: DataFrame | None = None, gone: DataFrame | None = None) -> bool:
        """Apply a batch; False if it was applied before.

        ``counts`` holds new or revised counts (as from ``count_tokens``), ``gone`` the ``doc_id`` and ``version`` of documents to
        take out. Of several counts of one document and version in a batch the largest row (by tokens, bytes, source,
        language) holds; one that is also gone is taken out. Null sources and languages are keys like any other;
        rows with a null id cannot be revised later and are left out of the ledger and the totals.
        """
        if not batch or "/" in batch:
            raise ValueError("a batch id is a non-empty name without slashes")
        if batch in self.committed():
            return False
        empty = self.spark.createDataFrame([], self._ledger_schema)
        gone_keys = (gone if gone is not None else empty).select("doc_id", "version").distinct()
        new = (counts if counts is not None else empty).select("doc_id", *KEYS, *MEASURES).filter(F.col("doc_id").isNotNull())
        latest = new.groupBy("doc_id", "version").agg(
            F.max(F.struct(*MEASURES, "source", "lang")).alias("row")
        ).join(gone_keys, ["doc_id", "version"], "left_anti")
        touched = latest.select("doc_id", "version").union(gone_keys).distinct()
        back = self.current().join(touched, ["doc_id", "version"], "left_semi").withColumn("sign", F.lit(-1))
        added = latest.select("doc_id", "row.source", "row.lang", "version", "row.n_tokens", "row.n_bytes", F.lit(1).alias("sign"))
        names = [field.name for field in T._parse_datatype_string(self._ledger_schema).fields]
        path = f"{self.root}/ledger/{batch}"
        back.select(names).union(added.select(names)).write.mode("overwrite").parquet(path)
        delta = self.spark.read.schema(self._ledger_schema).parquet(path).groupBy(*KEYS).agg(
            F.sum("sign").alias("n_docs"), *[F.sum(F.col("sign") * F.col(c)).alias(c) for c in MEASURES]
        )
        delta.write.mode("overwrite").parquet(f"{self.root}/rollup/{batch}")
        return True

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/{batch}" for batch in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _net(self, ledger: DataFrame) -> DataFrame:
        left = ledger.groupBy("doc_id", *KEYS, *MEASURES).agg(F.sum("sign").alias("sign"))
        return left.filter("sign > 0").drop("sign")
