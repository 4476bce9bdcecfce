"""Language of web pages by Bayesian fusion of four kinds of evidence.

log posterior(language) = text log likelihood + log P(declared | language) + log P(suffix | language)
                        + log P(language | host)

* Text: character trigram likelihoods, trained on labelled documents; at most ``WEIGHED_CHARS`` characters' worth of
  evidence, since trigrams of one text are not independent (the mean over the whole text times that number).
* Declared language of the mark-up and language in the address: tables of P(shown | language), counted
  over all pages by their text-only language and smoothed, so what is shown wrongly often counts little.
* Host prior: the languages of the pages of a host by their text, smoothed towards those of its registered domain,
  which are smoothed towards those of all pages. These are grouped aggregations over all pages; a host with very many
  pages is combined before the shuffle, and its prior is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import light_batches, settle

BUCKETS = 1 << 15
WEIGHED_CHARS = 200
SMOOTHING = 0.5
# Pages' worth of belief that a host takes from its domain, and a domain from all pages.
HOST_PRIOR, DOMAIN_PRIOR = 4.0, 8.0

# Fixed patterns: what is not text in a page, and where a page and its address state a language.
_NO_TEXT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
_DECLARED = r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]{2})"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[/?#]|$)"


def page_text(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), _NO_TEXT, " "), r"\s+", " "))


def _found(text: Column, pattern: str) -> Column:
    return F.lower(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), F.lit("")))


def trigram_buckets(text: str) -> np.ndarray:
    """Buckets of the character trigrams of a text in lower case, blanks around it."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    code = (points[:-2] * np.uint64(0x9E3779B97F4A7C15) + points[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + points[2:]
    return (((code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log likelihoods (language, bucket), from ``lang`` and ``text`` of all ``docs``.

    Null languages and texts are ignored. What is collected has one row per language and bucket at most.
    """
    light_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(trigram_buckets(text))
            for lang, parts in by_lang.items():
                bucket, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), pa.array(n)], ["lang", "bucket", "n"]
                )

    rows = (
        docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.lower("lang").alias("lang"), "text")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    names = sorted(set(rows.column("lang").to_pylist()))
    counts = np.full((len(names), BUCKETS), SMOOTHING)
    at = np.searchsorted(names, rows.column("lang").to_pylist()) if names else np.empty(0, np.int64)
    np.add.at(counts, (at, rows.column("bucket").to_numpy()), rows.column("n").to_numpy())
    return names, np.log(counts / counts.sum(1, keepdims=True))


def text_evidence(pages: DataFrame, names: list[str], likelihood: np.ndarray) -> DataFrame:
    """``page_id``, ``text_logs`` (one per language), ``declared``, ``suffix``, ``host``, ``domain`` of every page."""
    light_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(np.ascontiguousarray(likelihood.T))
    host = _found(F.col("url"), _HOST)
    shown = pages.select(
        "page_id", page_text(F.col("html")).alias("text"), _found(F.col("html"), _DECLARED).alias("declared"),
        _found(F.col("url"), _PATH).alias("suffix"), host.alias("host"),
        F.nullif(F.regexp_extract(F.coalesce(host, F.lit("")), r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
    )
    kept = ("page_id", "declared", "suffix", "host", "domain")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            logs = []
            for text in batch.column("text").to_pylist():
                buckets = trigram_buckets(text)
                total = table[buckets].sum(0) if len(buckets) else np.zeros(table.shape[1])
                logs.append((total * (min(len(buckets), WEIGHED_CHARS) / max(len(buckets), 1))).tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(logs, pa.list_(pa.float64()))], [*kept, "text_logs"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return shown.mapInArrow(
        weigh, f"page_id {kind}, declared string, suffix string, host string, domain string, text_logs array<double>"
    )


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> Column:
    return F.array(*[F.sum(F.col("belief")[i]) for i in range(n)])


def _mixed(own: Column, prior: Column, weight: float) -> Column:
    total = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(own, prior, lambda x, p: (x + weight * p) / (total + weight))


def _shown_given(evidence: DataFrame, column: str, names: list[str]) -> DataFrame:
    """``column``, ``logs``: log P(shown | language); one row per value that is one of ``names``, and one for others."""
    n = len(names)
    value = F.when(F.col(column).isin(names), F.col(column)).when(F.col(column).isNotNull(), F.lit("other"))
    seen = evidence.filter(F.col(column).isNotNull()).groupBy(value.alias(column)).agg(_sums(n).alias("mass"))
    rows = {row[column]: row["mass"] for row in seen.collect()}  # at most one row per language and one
    mass = np.array([rows.get(name, [0.0] * n) for name in [*names, "other"]]) + SMOOTHING
    logs = np.log(mass / mass.sum(0, keepdims=True))
    return evidence.sparkSession.createDataFrame(
        [(name, row.tolist()) for name, row in zip([*names, "other"], logs)], f"{column} string, logs array<double>"
    )


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id``, ``lang``, ``confidence``, and what each source says alone: ``text_lang``, ``declared``, ``suffix``.

    Every row of ``pages`` (``page_id``, ``url``, ``html``) comes out once per time it went in. Evidence that a page
    lacks (null or empty html, no declared language, no suffix, no host) has no say; a page without any gets
    the language most pages have. Ties go to the first language in alphabetical order. Without labelled documents
    ``lang`` is null and the confidence 0.
    """
    names, likelihood = train(docs)
    if not names:
        nothing = F.lit(None).cast("string")
        return pages.select(
            "page_id", nothing.alias("lang"), F.lit(0.0).alias("confidence"), nothing.alias("text_lang"),
            _found(F.col("html"), _DECLARED).alias("declared"), _found(F.col("url"), _PATH).alias("suffix"),
        )
    evidence = settle(text_evidence(pages, names, likelihood), "evidence").withColumn("belief", _softmax(F.col("text_logs")))
    n = len(names)
    overall = evidence.agg(*[F.sum(F.col("belief")[i]) for i in range(n)]).first()
    mass = np.array([x or 0.0 for x in overall]) + SMOOTHING
    everywhere = F.array(*[F.lit(float(x)) for x in mass / mass.sum()])
    hosts = settle(
        evidence.filter(F.col("host").isNotNull()).groupBy("host", "domain").agg(_sums(n).alias("own")), "hosts"
    )
    domains = hosts.filter(F.col("domain").isNotNull()).groupBy("domain").agg(
        F.array(*[F.sum(F.col("own")[i]) for i in range(n)]).alias("of_domain")
    )
    priors = (
        hosts.join(domains.withColumnRenamed("domain", "_domain"), F.col("domain") == F.col("_domain"), "left")
        .withColumn("wide", _mixed(F.coalesce("of_domain", "own"), everywhere, DOMAIN_PRIOR))
        .select(F.col("host").alias("_host"), _mixed(F.col("own"), F.col("wide"), HOST_PRIOR).alias("prior"))
    )
    # Small fixed tables: a row for each language and one more.
    said = F.broadcast(_shown_given(evidence, "declared", names).toDF("_declared", "declared_logs"))
    addressed = F.broadcast(_shown_given(evidence, "suffix", names).toDF("_suffix", "suffix_logs"))

    def known(column: str) -> Column:
        return F.when(F.col(column).isin(names), F.col(column)).when(F.col(column).isNotNull(), F.lit("other"))

    nothing = F.array(*[F.lit(0.0)] * n)
    fused = (
        evidence.join(priors, F.col("host") == F.col("_host"), "left")
        .join(said, known("declared") == F.col("_declared"), "left")
        .join(addressed, known("suffix") == F.col("_suffix"), "left")
        .withColumn("logs", F.zip_with(
            F.zip_with("text_logs", F.coalesce("declared_logs", nothing), lambda a, b: a + b),
            F.zip_with(F.coalesce("suffix_logs", nothing), F.coalesce("prior", everywhere), lambda a, b: a + F.log(b)),
            lambda a, b: a + b,
        ))
        .withColumn("posterior", _softmax(F.col("logs")))
    )
    named = F.array(*[F.lit(name) for name in names])

    def best(logs: str) -> Column:
        return F.element_at(named, F.array_position(F.col(logs), F.array_max(logs)).cast("int"))

    return fused.select(
        "page_id", best("posterior").alias("lang"), F.array_max("posterior").alias("confidence"),
        F.when(F.array_max("text_logs") < 0, best("text_logs")).alias("text_lang"), "declared", "suffix",
    )
