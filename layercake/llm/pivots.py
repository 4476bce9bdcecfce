"""Near-duplicate vectors by a pivot-permutation index, with exact cosines.

Reference points (pivots) are taken from a bounded sample of the vectors, no two of them closer than ``SPREAD``, so that
a dense cluster holds few of them. A vector is described by its nearest pivots in order of nearness. Each
(label, pivot) has an inverted list of the vectors that have it among their nearest; two vectors that share a list are a
candidate pair if they share at least ``SHARED`` pivots (or all there are), and are taken in the list of their first shared
pivot only. Candidates are verified by cosine in double precision.

How many pivots a vector names follows the data: as many as ``RECALL`` of the probes need to share enough pivots. Probes
are vectors of the sample, each with its farthest linked neighbour there, and each with a point turned away from it
in a random direction by the whole angle of a link. So one cluster has one pivot, and all of its pairs are compared. The
number of pivots grows with the square root of the number of vectors up to ``MOST``; from a million vectors on lists
grow in proportion, and their pairs with the square.

A list longer than ``BLOCK`` is dealt into blocks that meet pair by pair, each in a task of its own, which hands on
degrees and one tie per vector, never pairs. Equal vectors are one node with a weight; a group of copies
of any size is one entry in the lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import light_batches, settle
from layercake.llm.components import connected_components
from layercake.llm.lsh_forest import whole_groups

SAMPLE = 4096
SHARED = 2
BLOCK = 1024
COSINE = 0.98
FEWEST, MOST = 64, 4096
# No two pivots have a larger cosine than this (about 34 degrees, three times the angle of a link at 0.98).
SPREAD = 0.825
RECALL, PROBES = 0.9995, 2048


def pivot_count(vectors: int) -> int:
    """About four times the square root, as a power of two, between ``FEWEST`` and ``MOST``."""
    wanted = max(FEWEST, min(MOST, 4 * int(vectors**0.5)))
    return min(SAMPLE, 1 << (wanted - 1).bit_length())


def spread(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows of unit vectors, each at least ``SPREAD`` away from those before it."""
    nearest, chosen = np.full(len(sample), -1.0), []
    for row, vector in enumerate(sample):
        if len(chosen) < wanted and nearest[row] <= SPREAD:
            chosen.append(row)
            nearest = np.maximum(nearest, sample @ vector)
    return sample[chosen]


def _ranks(close: np.ndarray) -> np.ndarray:
    """For every row the place of each pivot in its order of nearness."""
    order = np.argsort(-close, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
    return place


def nearest_count(sample: np.ndarray, pivots: np.ndarray, cosine: float, shared_pivots: int) -> int:
    """How many pivots a vector has to name so that ``RECALL`` of the probes share ``shared_pivots``."""
    shared_pivots = min(shared_pivots, len(pivots))
    from_ = sample[:PROBES]
    # Any direction at a right angle to the vector, the same in every run.
    turned = np.random.default_rng(0).normal(size=from_.shape)
    turned -= (turned * from_).sum(1, keepdims=True) * from_
    length = np.sqrt((turned * turned).sum(1, keepdims=True))
    turned = np.divide(turned, length, out=np.zeros_like(turned), where=length > 0)
    beside = cosine * from_ + np.sqrt(max(0.0, 1 - cosine * cosine)) * turned
    close = from_ @ sample.T
    farthest = np.where(close >= cosine, close, 2.0).argmin(1)
    linked = np.flatnonzero(farthest != np.arange(len(from_)))
    own, needed = _ranks(from_ @ pivots.T), 1
    for rows, other in ((np.arange(len(from_)), beside), (linked, sample[farthest[linked]])):
        if len(rows):
            both = np.maximum(own[rows], _ranks(other @ pivots.T))
            enough = np.sort(np.partition(both, shared_pivots - 1, axis=1)[:, shared_pivots - 1])
            needed = max(needed, int(enough[min(len(rows) - 1, int(np.ceil(RECALL * len(rows))))]) + 1)
    return needed


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def nodes_of(embeddings: DataFrame) -> DataFrame:
    """``label``, ``embedding``, ``node`` (smallest id), ``copies``: distinct usable vectors with their labels.

    Vectors that are null, zero, or hold a null or non-finite component, and null labels, are left out.
    """
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    return (
        embeddings.filter(usable & F.exists(vector, lambda x: x != 0))
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    )


def choose_pivots(nodes: DataFrame, total: int, cosine: float, shared_pivots: int) -> dict[int, tuple[np.ndarray, int]]:
    """By dimension, pivots and how many of them a vector names, from the ``SAMPLE`` vectors with the smallest hash."""
    rows = nodes.select("embedding").orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE).collect()
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(len(row.embedding), []).append(row.embedding)
    chosen = {}
    for dimension, vectors in found.items():
        sample = _unit(np.array(vectors, np.float64))
        pivots = spread(sample, pivot_count(total))
        chosen[dimension] = pivots, nearest_count(sample, pivots, cosine, shared_pivots)
    return chosen


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or very small components neither overflow nor vanish.
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def permutations(nodes: DataFrame, pivots: dict[int, tuple[np.ndarray, int]]) -> DataFrame:
    """``nodes`` with ``near``: the numbers of the nearest pivots, nearest first.

    Vectors of a dimension that the sample lacks all go to one list, which is dealt into blocks like any other.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            near: list = [[-1]] * len(vectors)
            for d in {len(v) for v in vectors} & set(shared.value):
                rows = [i for i, v in enumerate(vectors) if len(v) == d]
                points, count = shared.value[d]
                close = _unit(np.array([vectors[i] for i in rows], np.float64)) @ points.T
                order = np.argsort(-close, axis=1, kind="stable")[:, :count]
                for i, order in zip(rows, order):
                    near[i] = order.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))], [*batch.schema.names, "near"]
            )

    schema = ", ".join(f"{name} {kind}" for name, kind in nodes.dtypes)
    return nodes.mapInArrow(describe, f"{schema}, near array<int>")


def in_blocks(described: DataFrame, block: int) -> DataFrame:
    """The inverted lists: one row per vector, pivot and pair of blocks in which it is compared.

    The pairs of blocks (i, j), i <= j, of a list cover all of its pairs; ``side`` tells which block a row is of.
    """
    lists = described.select("*", F.explode("near").alias("pivot"), F.size("embedding").alias("d"))
    parts = (
        lists.groupBy("label", "d", "pivot").agg(F.count("*").alias("n"))
        .select("label", "d", "pivot", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    )
    dealt = lists.join(parts, ["label", "d", "pivot"]).withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    meets = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return meets.select(
        "label", "d", "pivot", "node", "copies", "embedding", "near", F.col("own").alias("side"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )


def verified(blocks: DataFrame, cosine: float, shared_pivots: int) -> DataFrame:
    """``node``, ``others`` (vectors linked with it there), ``root`` (a node tied to it) per list, pair of blocks and linked node."""
    kind = blocks.schema["node"].dataType.simpleString()
    blocks = blocks.withColumn("list", F.struct("label", "d", "pivot", "i", "j"))
    key = F.xxhash64("list")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", "label", "d", "pivot", "i", "j"):
            names = ("key", "label", "d", "pivot", "i", "j")
            columns = [table.column(n).to_numpy() for n in names]
            change = np.zeros(table.num_rows - 1, bool)
            for column in columns:
                change |= column[1:] != column[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])
            for start, end in zip(starts[:-1], starts[1:]):
                yield from _pairs(table.slice(start, end - start), cosine, shared_pivots)

    return (
        blocks.select(key.alias("key"), "label", "d", "pivot", "i", "j", "side", "node", "copies", "embedding", "near")
        .repartition("key").sortWithinPartitions("key", "label", "d", "pivot", "i", "j")
        .mapInArrow(compare, f"node {kind}, others long, root {kind}")
    )


def _pairs(group: pa.Table, cosine: float, shared_pivots: int) -> Iterator[pa.RecordBatch]:
    if group.num_rows < 2:
        return
    pivot, i, j = (group.column(n)[0].as_py() for n in ("pivot", "i", "j"))
    node, copies, side = (group.column(n).to_numpy() for n in ("node", "copies", "side"))
    near, unit = group.column("near").to_pylist(), _unit(_matrix(group.column("embedding")))
    first, second = np.flatnonzero(side == i), np.flatnonzero(side == j)
    # Inverted lists of the group give the shared-pivot counts of all of its pairs.
    numbers = sorted({p for order in near for p in order})
    member = np.zeros((len(near), len(numbers)), np.float32)
    for row, order in enumerate(near):
        member[row, np.searchsorted(numbers, order)] = 1
    own = np.searchsorted(numbers, pivot)
    before = member[:, :own]
    pairs = []
    for start in range(0, len(first), 64):
        rows = first[start : start + 64]
        enough = min(shared_pivots, len(near[0]))
        taken = (member[rows] @ member[second].T >= enough) & (before[rows] @ before[second].T == 0)
        if i == j:
            taken &= rows[:, None] < second[None, :]
        # The product of the blocks rules most pairs out; the others are computed one by one, alike everywhere.
        x, y = np.nonzero(taken & (unit[rows] @ unit[second].T >= cosine - 1e-9))
        x, y = rows[x], second[y]
        close = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
        pairs.append((x[close], y[close]))
    x, y = (np.concatenate(side) for side in zip(*pairs))
    if len(x):
        others = np.bincount(x, copies[y], len(node)) + np.bincount(y, copies[x], len(node))
        linked = np.flatnonzero(others)
        root = _roots(x, y, node)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(others[linked].astype(np.int64)), pa.array(root[linked])],
            ["node", "others", "root"],
        )


def _roots(x: np.ndarray, y: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The smallest node that each node reaches by the links (x, y)."""
    root, before = node.copy(), None
    while before is None or (root != before).any():
        before = root.copy()
        np.minimum.at(root, x, before[y])
        np.minimum.at(root, y, before[x])
    return root


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, shared_pivots: int = SHARED, block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``embeddings`` (``vec_id``, ``label``, ``embedding``).

    Vectors are linked if their labels are equal and not null and their cosine is at least ``cosine``. Vectors that
    are null, empty, zero or hold a null or non-finite component are linked with nothing, nor are vectors of
    different length. Equal vectors are linked with each other. An id names one vector: rows
    that repeat it with another vector or label share a node. An empty table gives an empty table. Other columns are not read; labels must be whole numbers.
    """
    light_batches(embeddings.sparkSession)
    nodes = settle(nodes_of(embeddings).withColumn("label", F.col("label").cast("long")), "nodes")
    pivots = choose_pivots(nodes, nodes.count(), cosine, shared_pivots)
    described = settle(permutations(nodes, pivots), "described")
    links = settle(verified(in_blocks(described, block), cosine, shared_pivots), "vector-links")
    degree = links.groupBy("node").agg(F.sum("others").alias("others"))
    found = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = (
        nodes.join(degree, "node", "left").join(found, "node", "left")
        .select(
            F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("class"),
        )
        .filter("links > 0")
    )
    same = (F.col("label").cast("long") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    component = F.coalesce("class", "vec_id").cast("long")
    return embeddings.select("vec_id", "label", "embedding").join(classes, same, "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
