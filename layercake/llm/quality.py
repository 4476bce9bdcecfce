"""Text quality by nearest-neighbour voting in a latent-semantic space.

A text is counted as terms: hashed trigrams of character classes (letters, capitals, digits, each mark of
its own), which show how it is written, hashed words, and how often a word follows itself. The counts
are damped, weighted by rarity and projected to ``DIMENSIONS`` latent directions, which come from the
labelled sample. The latent vectors of that sample are broadcast; every document gets exact cosine products
with all of them, block by block, and its ``NEIGHBOURS`` nearest vote with their similarity.

The sample holds at most ``MAX_LABELLED`` labelled documents, those with the smallest hash of their id, so the
broadcast is bounded (about 2 MB) however many labels there are. Every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm.common import light_batches

MAX_LABELLED = 4096
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8
CUT = 0.7
ROUNDS = 12
SEED = 7

_SHAPES, _WORDS, _REPEATS = 1536, 480, 32
TERMS = _SHAPES + _WORDS + _REPEATS

# Character classes: 0 lower letters and bytes beyond ASCII, 1 capitals, 2 digits, 3 blank, 4 line end, then marks.
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]] = 1, 2, 3, 4
_MARKS = [b for b in range(128) if not (chr(b).isalnum() or b in (32, 9, 10, 13))]
_CLASS[_MARKS] = 5 + np.arange(len(_MARKS))


def held_out(doc_id):
    """The rows that are never learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def term_counts(text: str | None) -> np.ndarray:
    """Damped counts of one text, as a dense row."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(TERMS)
    if not len(raw):
        return out
    kinds = _CLASS[raw]
    if len(kinds) > 2:
        codes = (kinds[:-2] * 10_007 + kinds[1:-1] * 101 + kinds[2:]) * 2_654_435_761 % 4_294_967_296 % _SHAPES
        out[:_SHAPES] = np.bincount(codes, minlength=_SHAPES)
    # A word is named by a polynomial of its bytes, taken from running sums so that no loop over words is needed.
    letter = (kinds < 3).astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], letter, [0]])))
    starts, ends = edges[::2], edges[1::2]
    if len(starts):
        folded = np.where((raw >= 65) & (raw < 91), raw + 32, raw).astype(np.uint64)
        spread = (folded + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        origin = np.zeros(len(raw), np.int64)
        origin[starts] = starts
        place = (np.arange(len(raw)) - np.maximum.accumulate(origin)).astype(np.uint64)
        weighted = (spread * (np.uint64(2) * place + np.uint64(1))) ^ (spread >> np.uint64(17))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted)])
        names = sums[ends] - sums[starts]
        names = ((names ^ (names >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)
        out[_SHAPES : _SHAPES + _WORDS] = np.bincount((names % np.uint64(_WORDS)).astype(np.int64), minlength=_WORDS)
        share = float((names[1:] == names[:-1]).mean()) if len(names) > 1 else 0.0
        out[_SHAPES + _WORDS + min(int(share * _REPEATS), _REPEATS - 1)] = len(names)
    return np.log1p(out)


class Space:
    """Weights, directions and labelled vectors of a fitted space; plain arrays, ready to broadcast."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray) -> None:
        """``counts`` in single precision, one row per labelled document; it is weighted in place."""
        self.rarity = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
        counts *= self.rarity
        lengths = np.sqrt(np.einsum("ij,ij->i", counts, counts))[:, None]
        counts /= np.where(lengths > 0, lengths, 1)
        # Leading right singular vectors by subspace iteration: no matrix of terms by terms is needed.
        basis = np.random.default_rng(SEED).normal(size=(counts.shape[1], DIMENSIONS + 16))
        for _ in range(ROUNDS):
            basis = np.linalg.qr(basis)[0].astype(np.float32)
            basis = (counts.T @ (counts @ basis)).astype(np.float64)
        basis = np.linalg.qr(basis)[0].astype(np.float32)
        turned = np.linalg.svd((counts @ basis).astype(np.float64), full_matrices=False)[2]
        self.directions = (basis @ turned[:DIMENSIONS].T.astype(np.float32)).astype(np.float64)
        self.vectors = _unit((counts @ self.directions.astype(np.float32)).astype(np.float64)).astype(np.float32)
        self.labels = labels.astype(np.float64)

    def fields(self) -> dict[str, np.ndarray]:
        return dict(vars(self))


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def votes(counts: np.ndarray, space: dict[str, np.ndarray]) -> np.ndarray:
    """Scores of a block of documents: the similarity-weighted share of label 1 among the nearest."""
    latent = _unit(_unit(counts * space["rarity"]) @ space["directions"]).astype(np.float32)
    similar = latent @ space["vectors"].T
    k = min(NEIGHBOURS, similar.shape[1])
    nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(similar, nearest, 1).astype(np.float64), 0, 1) ** SHARPNESS
    base = float(space["labels"].mean())
    # A prior vote of small weight settles texts that are like none of the sample.
    return np.clip(((weight * space["labels"][nearest]).sum(1) + 1e-3 * base) / (weight.sum(1) + 1e-3), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[str, np.ndarray] | None:
    """The space of the labelled rows that are not held out; None where there are none.

    Null labels are ignored; a document with several labels counts by their mean (half or more is 1).
    """
    light_batches(docs.sparkSession)
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [term_counts(text).astype(np.float32).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())],
                                             ["doc_id", "quality", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"]).select("doc_id", "quality", "text")
        .mapInArrow(count, f"doc_id {kind}, quality int, counts binary")
        .orderBy("doc_id").collect()  # at most max_labelled rows of 8 KB
    )
    if not rows:
        return None
    counts = np.empty((len(rows), TERMS), np.float32)
    for i, row in enumerate(rows):
        counts[i] = np.frombuffer(row.counts, np.float32)
    return Space(counts, np.array([row.quality for row in rows])).fields()


def scored(docs: DataFrame, space: dict[str, np.ndarray] | None, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``name``, a score from 0 to 1 (higher: better).

    Null and empty texts have no terms; they get the share of label 1 in the sample. Without any labels all
    scores are 0.5. Repeated rows get the same score; null ids are passed on. ``name`` must be a new column.
    """
    spark = docs.sparkSession
    light_batches(spark)
    if space is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = spark.sparkContext.broadcast(space)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = np.stack([term_counts(text) for text in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(votes(counts, shared.value))], [*batch.schema.names, name]
                )

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from ``cut`` on) for every row of ``docs``."""
    return scored(docs.select("doc_id", "text"), fit(docs, labels, max_labelled)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )
