"""Near-duplicate texts by MinHash in an LSH forest, with every link confirmed on the full shingle sets.

1. Every text becomes its set of distinct word shingles (as 64-bit hashes) and a signature of minima.
   Documents with the same set are one node from here on.
2. Every tree sorts the nodes by its own rotation of the signature. Neighbours that share a prefix of
   ``DEPTH`` minima form a region. A region of more than ``REGION`` nodes is cut by ever longer
   prefixes; one whose nodes agree in all minima is dealt into parts that share its smallest node.
3. In a region, nodes whose sketches agree in ``AGREE`` of the minima may be alike. They are tied together
   loosely, so a region of m nodes gives at most m - 1 ties, never all pairs. Components of the ties are
   the clusters within which links can lie.
4. The texts of a cluster meet in one task, where all of its pairs are compared on the full sets. Clusters
   above ``REGION`` nodes or ``CLUSTER_SHINGLES`` shingles meet region by region instead.
5. Longer prefixes miss links, so all nodes that lie in a region of more than ``REGION`` nodes are joined exactly as
   well: two sets can be alike only if they share one of the rarest shingles of both (prefix filter). Sets that do
   and that are not in one component yet meet in blocks, pair of blocks by pair of blocks.

A link of similarity 0.8 is missed by all 20 trees at depth 3 with probability (1 - 0.8^3)^20 = 6e-7 and
by the sketch with about 1e-6. Both ends of any other link share a region of depth 3; where that is cut further,
step 5 finds the link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import light_batches, settle
from layercake.llm.components import connected_components

TREES = 20
DEPTH = 3
MINIMA = TREES * DEPTH
LONGER = (6, 12, 24, MINIMA)
REGION = 2048
CLUSTER_SHINGLES = 8_000_000
# Of 60 minima 48 agree on average at similarity 0.8; fewer than 32 do once in a million pairs.
AGREE = 32
# Cluster members are broadcast to the texts up to this size (40 bytes a row); larger tables are joined by shuffle.
BROADCAST_BYTES = 64_000_000
THRESHOLD = 80
SEED = 20_240_601

_ODD = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes.

    A-Z are lower-cased, words are runs of anything but ASCII blanks. A text with fewer words than a shingle
    is one shingle of all its words; without words it has none.
    """

    def __init__(self, width: int) -> None:
        self.width, self.seen = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # On bytes, lower() changes A-Z alone and split() parts at 0x09-0x0D and 0x20 alone.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.seen) > _CACHED_WORDS:
            self.seen.clear()
        seen, missing = self.seen, set(words).difference(self.seen)
        for word in missing:
            seen[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        rolled = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            rolled = rolled * _ODD + hashes[i : i + len(rolled)]
        return np.unique(mixed(rolled))


def minima_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima for every non-empty set."""
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 2**63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
    terms = random.integers(0, 2**63, MINIMA, np.uint64)
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), MINIMA), np.uint64)
    for j in range(MINIMA):
        out[:, j] = np.minimum.reduceat(flat * factors[j] + terms[j], starts)
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``d1``, ``d2`` (digest of the set), ``keys`` (one per tree), ``sketch``."""
    light_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in batches:
            sets = [shingles(text) for text in batch.column("text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = [[None] * len(sets) for _ in range(2)]
            keys, sketches = [None] * len(sets), [None] * len(sets)
            if full:
                minima = mixed(minima_of([sets[i] for i in full]))
                trees = minima.reshape(len(full), TREES, DEPTH)
                key = np.zeros((len(full), TREES), np.uint64)
                for j in range(DEPTH):
                    key = mixed(key * _ODD + trees[:, :, j])
                key, sketch = key.view(np.int64), (minima >> np.uint64(56)).astype(np.uint8)
                for row, i in enumerate(full):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(sets[i].tobytes()), np.int64)
                    digests[0][i], digests[1][i] = int(digest[0]), int(digest[1])
                    keys[i], sketches[i] = key[row], sketch[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests[0], pa.int64()), pa.array(digests[1], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "keys", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, n_shingles long, d1 long, d2 long, keys array<long>, sketch binary"
    )


def placed_at_depth(nodes: DataFrame) -> DataFrame:
    """``node``, ``sketch``, ``tree``, ``key``: every node in every tree, at ``DEPTH``."""
    return nodes.select("node", "sketch", F.posexplode("keys").alias("tree", "key"))


def regions(nodes: DataFrame, region: int = REGION, crowds: DataFrame | None = None) -> DataFrame:
    """``tree``, ``key`` (of the region), ``node``, ``sketch``: every node in every tree, at adaptive depth.

    ``crowds`` are the regions to cut first, where they are known.
    """
    rows = placed_at_depth(nodes)
    for depth in LONGER:
        dense, crowds = _dense(rows, region) if crowds is None else crowds, None
        if dense.isEmpty():
            return rows
        rotated = F.substring(F.concat("sketch", "sketch"), 1, 2 * MINIMA)
        longer = F.xxhash64("key", F.substr(rotated, F.col("tree") * DEPTH + 1, F.lit(depth)))
        rows = (
            rows.join(dense.select("tree", "key", F.lit(True).alias("deeper")), ["tree", "key"], "left")
            .select("node", "sketch", "tree", F.when(F.col("deeper"), longer).otherwise(F.col("key")).alias("key"))
        )
    dense = _dense(rows, region)
    if dense.isEmpty():
        return rows
    dealt = dense.withColumn("parts", F.ceil(F.col("n") / (region / 2)).cast("int"))
    part = F.when(F.col("parts").isNull(), F.col("key")).otherwise(
        F.xxhash64("key", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    )
    own = rows.join(dealt.select("tree", "key", "parts"), ["tree", "key"], "left").select(
        "node", "sketch", "tree", part.alias("key")
    )
    shared = rows.join(
        dealt.select("tree", "key", F.col("least").alias("node"), "parts"), ["tree", "key", "node"]
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return own.unionByName(shared.select("node", "sketch", "tree", F.xxhash64("key", "part").alias("key"))).distinct()


def _dense(rows: DataFrame, region: int) -> DataFrame:
    counts = rows.groupBy("tree", "key").agg(F.count("*").alias("n"), F.min("node").alias("least"))
    return settle(counts.filter(F.col("n") > region), "dense")


def labels_of(alike: np.ndarray) -> np.ndarray:
    """Smallest index reachable, for a symmetric boolean matrix."""
    labels = np.arange(len(alike))
    alike = alike | np.eye(len(alike), dtype=bool)
    while True:
        lowest = np.array([labels[row].min() for row in alike])
        lowest = lowest[lowest]
        if (lowest == labels).all():
            return labels
        labels = lowest


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows, and the end."""
    change = np.zeros(len(columns[0]) - 1, bool)
    for column in columns:
        change |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(columns[0])]])


def whole_groups(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[pa.Table]:
    """Tables of consecutive batches that end where a group ends (rows must be sorted by ``names``)."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _runs(*(batch.column(name).to_numpy(zero_copy_only=False) for name in names))
        cut = int(starts[-2])
        same = waiting and all(waiting[-1].column(n)[-1] == batch.column(n)[0] for n in names)
        if cut == 0 and (same or not waiting):
            waiting.append(batch)
            continue
        if not same and waiting:
            yield pa.Table.from_batches(waiting)
            waiting = []
        if cut:
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
        waiting = [batch.slice(cut)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def ties(placed: DataFrame) -> DataFrame:
    """``tree``, ``key``, ``node``, ``root``: nodes of a region tied to the smallest node they may be alike to."""

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tree", "key"):
            tree, key, node = (table.column(n).to_numpy() for n in ("tree", "key", "node"))
            packed = table.column("sketch").combine_chunks()
            sketch = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(-1, MINIMA)
            starts = _runs(tree, key)
            lengths = np.diff(starts)
            rows, roots = [], []
            twos = starts[:-1][lengths == 2]
            twos = twos[(sketch[twos] == sketch[twos + 1]).sum(1) >= AGREE]
            rows.append(np.stack([twos, twos + 1], 1).ravel())
            roots.append(np.repeat(np.minimum(node[twos], node[twos + 1]), 2))
            for start, length in zip(starts[:-1][lengths > 2], lengths[lengths > 2]):
                part = slice(start, start + length)
                agree = np.zeros((length, length), np.uint8)
                for column in sketch[part].T:
                    agree += column[:, None] == column[None, :]
                root, size = _tied(agree >= AGREE, node[part])
                tied = size > 1
                rows.append(start + np.flatnonzero(tied))
                roots.append(root[tied])
            rows = np.concatenate(rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree[rows]), pa.array(key[rows]), pa.array(node[rows]),
                 pa.array(np.concatenate(roots).astype(node.dtype))],
                ["tree", "key", "node", "root"],
            )

    kind = placed.schema["node"].dataType.simpleString()
    return placed.repartition("tree", "key").sortWithinPartitions("tree", "key").mapInArrow(
        tie, f"tree int, key long, node {kind}, root {kind}"
    )


def _tied(alike: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the smallest node of its local component, and the number of its distinct nodes."""
    labels = labels_of(alike | (node[:, None] == node[None, :]))
    root, size = np.empty_like(node), np.empty(len(node), np.int64)
    for label in np.unique(labels):
        members = labels == label
        root[members], size[members] = node[members].min(), len(np.unique(node[members]))
    return root, size


def alike(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """Exact: which pairs of sets have 100 * intersection >= threshold * union."""
    sizes = np.array([len(s) for s in sets], np.int64)
    shared = np.zeros((len(sets), len(sets)), np.int64)
    if len(sets) <= 6:
        for i in range(len(sets)):
            for j in range(i):
                if 100 * min(sizes[i], sizes[j]) >= threshold * max(sizes[i], sizes[j]):
                    shared[i, j] = shared[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.argsort(column[keep := np.flatnonzero(often[column] > 1)], kind="stable")
        owner, column = owner[keep][order], column[keep][order]
        column = np.unique(column, return_inverse=True)[1]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [start, start + 4096])
            block = np.zeros((len(sets), 4096), np.float32)
            block[owner[a:b], column[a:b] - start] = 1
            shared += (block @ block.T).astype(np.int64)
    return 100 * shared >= threshold * (sizes[:, None] + sizes[None, :] - shared)


def confirmed(texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """``a``, ``b``: links of ``texts`` (``cluster``, ``region``, ``doc_id``, ``text``), a star for every component."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)

        def in_sets() -> Iterator[pa.RecordBatch]:
            # Texts become sets as they come, which are all that a group holds on to.
            for batch in batches:
                sets = [shingles(text).tobytes() for text in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cluster"), batch.column("region"), batch.column("doc_id"),
                     pa.array(sets, pa.large_binary())],
                    ["cluster", "region", "doc_id", "set"],
                )

        for table in whole_groups(in_sets(), "cluster", "region"):
            cluster, region, node = (table.column(n).to_numpy() for n in ("cluster", "region", "doc_id"))
            starts = _runs(cluster, region)
            a, b = [], []
            for start, end in zip(starts[:-1], starts[1:]):
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("set").slice(start, end - start)]
                root, size = _tied(alike(sets, threshold), node[start:end])
                a.append(node[start:end][size > 1])
                b.append(root[size > 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )

    return (
        texts.repartition("cluster", "region").sortWithinPartitions("cluster", "region")
        .mapInArrow(compare, f"a {kind}, b {kind}").distinct()
    )


def rarest_shingles(texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """``node``, ``n`` (shingles of the set), ``shingle``: the prefix of every set of ``texts`` (``doc_id``, ``text``).

    Shingles are ordered by the number of sets that hold them. Of a set of n shingles the first n - ceil(n *
    threshold / 100) + 1 count; if two sets are alike, these have a shingle in common. Those of one set are left out.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in batches:
            for node, text in zip(batch.column("doc_id"), batch.column("text").to_pylist()):
                if n := len(one := shingles(text)):
                    digest = xxhash.xxh3_64_intdigest(one.tobytes()) >> 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(node, n), pa.repeat(pa.scalar(digest, pa.int64()), n),
                         pa.repeat(pa.scalar(n, pa.int64()), n), pa.array(one.view(np.int64))],
                        ["node", "digest", "n", "shingle"],
                    )

    rows = settle(
        texts.select("doc_id", "text").mapInArrow(spell, f"node {kind}, digest long, n long, shingle long"), "crowd-shingles"
    )
    # Copies below one id count as further sets, which changes the order and no link.
    often = rows.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1")
    one_set = Window.partitionBy("node", "digest")
    ranked = rows.distinct().join(often, "shingle").select(
        "node", "n", "shingle", F.row_number().over(one_set.orderBy("often", "shingle")).alias("rank"),
        (F.col("n") - F.count("*").over(one_set)).alias("single"),
    )
    prefix = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    return ranked.filter(F.col("single") + F.col("rank") <= prefix).select("node", "n", "shingle")


def block_pairs(sized: DataFrame, threshold: int, rows: int, shingles: int) -> DataFrame:
    """``node``, ``cluster``, ``region``: the nodes of every cluster in pairs of blocks, so that any two may meet.

    ``sized`` has ``cluster``, ``node``, ``component``, ``n``. Blocks hold sets of similar sizes. Pairs whose sizes are too
    far apart, or whose nodes are all in one component, are left out.
    """
    before = Window.partitionBy("cluster").orderBy("n", "node").rowsBetween(Window.unboundedPreceding, -1)
    blocked = settle(
        sized.select(
            "cluster", "node", "component", "n",
            (F.floor(F.count("*").over(before) / max(rows // 2, 1))
             + F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / max(shingles // 2, 1))).alias("block"),
        ),
        "blocks",
    )
    edges = blocked.groupBy("cluster", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("component").alias("first"), F.max("component").alias("last"),
    )
    a, b = (edges.select("cluster", *[F.col(c).alias(side + c) for c in edges.columns[1:]]) for side in ("a_", "b_"))
    pairs = a.join(b, "cluster").filter(
        (F.col("a_block") <= F.col("b_block")) & (100 * F.col("a_high") >= threshold * F.col("b_low"))
        & (F.least("a_first", "b_first") < F.greatest("a_last", "b_last"))
    )
    sides = pairs.select(
        "cluster", F.explode(F.array_distinct(F.array("a_block", "b_block"))).alias("block"),
        F.xxhash64("cluster", "a_block", "b_block").alias("region"),
    )
    return blocked.join(sides, ["cluster", "block"]).select("node", "cluster", "region").distinct()


def crowd_links(
    docs: DataFrame, crowd: DataFrame, found: DataFrame, width: int, threshold: int, region: int, cluster_shingles: int
) -> DataFrame:
    """``a``, ``b``: exact links between the nodes of ``crowd`` (``node``) that ``found`` (``node``, ``component``) lacks."""
    prefixes = rarest_shingles(docs.join(_within(crowd.withColumnRenamed("node", "doc_id")), "doc_id"), width, threshold)
    prefixes = settle(
        prefixes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "prefixes"
    )
    # Sets that share a shingle hang on the smallest of them; where all are in one component there is nothing to find.
    shared = prefixes.groupBy("shingle").agg(
        F.min("node").alias("least"), F.min("component").alias("first"), F.max("component").alias("last")
    ).filter("first < last")
    hung = settle(prefixes.join(shared, "shingle").select("node", "least", "component", "n").distinct(), "hung")
    clusters = connected_components(hung.select(F.col("node").alias("a"), F.col("least").alias("b")))
    sized = hung.select("node", "component", "n").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node")
    members = settle(
        block_pairs(sized, threshold, region, cluster_shingles).withColumnRenamed("node", "doc_id"), "crowd-members"
    )
    return confirmed(docs.select("doc_id", "text").join(_within(members), "doc_id"), width, threshold)


def _within(members: DataFrame) -> DataFrame:
    """``members`` (written before), marked for broadcast if their counted size allows."""
    return F.broadcast(members) if members.count() * 40 <= BROADCAST_BYTES else members


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: int = THRESHOLD, region: int = REGION,
    cluster_shingles: int = CLUSTER_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept`` for every row of ``docs``.

    Documents are linked if their sets of ``width``-word shingles have ``100 * intersection >= threshold *
    union``. Null and empty texts, and texts without words, have no shingles and are linked with nothing.
    Rows that repeat an id are one node, linked through any of their texts. Rows with a null id count as copies
    of equal texts, but lead no component; alone they have a null component and are kept. An empty table
    gives an empty table. Only ``doc_id`` and ``text`` are read; ids must be integers.
    """
    signed = settle(signatures(docs, width), "signatures")
    sets = settle(
        signed.filter("n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")),
        "sets",
    )
    nodes = signed.join(sets.select("d1", "d2", F.col("node").alias("doc_id")), ["d1", "d2", "doc_id"])
    nodes = nodes.select(F.col("doc_id").alias("node"), "n_shingles", "keys", "sketch").distinct()
    crowds = _dense(placed_at_depth(nodes), region)
    tied = settle(ties(regions(nodes, region, crowds)), "ties")
    clusters = settle(
        connected_components(tied.select(F.col("node").alias("a"), F.col("root").alias("b"))), "clusters"
    )
    sized = clusters.join(nodes.select("node", "n_shingles"), "node")
    large = settle(
        sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
        .filter((F.col("n") > region) | (F.col("shingles") > cluster_shingles)).select("component"),
        "large",
    )
    any_large = not large.isEmpty()
    if any_large:
        small = clusters.join(large, "component", "left_anti")
        by_region = clusters.join(large, "component").join(tied, "node").select(
            "node", "component", F.xxhash64("tree", "key").alias("region")
        )
        members = small.select("node", "component", F.lit(0).cast("long").alias("region")).unionByName(by_region)
    else:
        members = clusters.select("node", "component", F.lit(0).cast("long").alias("region"))
    members = settle(
        members.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "region"), "members"
    )
    texts = docs.select("doc_id", "text").join(_within(members), "doc_id")
    links = confirmed(texts, width, threshold)
    # A cluster that was compared whole gives its components at once.
    found = connected_components(links) if any_large else links.toDF("node", "component")
    if not crowds.isEmpty():
        found = settle(found, "found")
        crowd = placed_at_depth(nodes).join(crowds, ["tree", "key"]).select("node").distinct()
        more = crowd_links(docs, settle(crowd, "crowd"), found, width, threshold, region, cluster_shingles)
        found = connected_components(found.toDF("a", "b").unionByName(more))
    classes = (
        sets.join(found, "node", "left")
        .select("d1", "d2", "copies", "node", F.coalesce("component", "node").alias("class"))
        .filter("copies > 1 OR class <> node").select("d1", "d2", "class")
    )
    return signed.join(classes, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("class", "doc_id").cast("long").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("class", "doc_id")).alias("kept"),
    )
