"""Cross-entropy difference: how much better a target language model predicts a text than a background model.

``word_cross_entropy_difference`` (the registered query) uses word bigram models over the vocabulary of all documents.
Both models count every pair of words that occurs, so they grow with the corpus: nothing is capped, and only four
totals come to the driver. The texts are written once as chunks of word sequences. A chunk sends its different pairs with
their counts, cut into blocks of hash codes, and each block answers with the totals of these pairs in the order asked, so
that no pair or document travels back. Its words are settled in the same way. Each chunk then weighs its own texts.
A pair goes to its block once from each chunk, so that frequent ones are no hot keys. Smoothing is interpolated
Witten-Bell: pairs, words, uniform over the vocabulary.

``cross_entropy_difference`` is the same on bytes, small enough to be held whole. Both of its models are byte trigram models over one vocabulary (the 256 byte values and an edge mark) with the same
interpolated Witten-Bell smoothing, so they differ in their counts only. The target model counts the texts of a
target corpus, the background model those of all documents. The counts of the background are scaled to the
mass of the target, so that smoothing weighs equally in both ("matched" models).

Counting is a distributed aggregation: every batch counts its own trigrams, Spark adds them up. A model
has at most 257^3 trigrams and in practice some ten thousand, whatever the size of the corpus; that bound holds
for what is collected and broadcast.

The score of a document is the sum over its bytes of (target loss - background loss), divided by their
number: below zero where the text is more like the target.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import broadcast_within, light_batches, settle
from layercake.session import shared_dir

SYMBOLS = 257
EDGE = 256
# So many words a task keeps with their hashes, as the frequent ones soon come again.
FREQUENT = 500_000
# Words and texts that fill a chunk, and keys (pairs, or words) that meet in a block (about).
CHUNK = 1 << 21
CHUNK_TEXTS = 1 << 17
BLOCK = 1 << 21


def trigram_codes(text: str | None) -> np.ndarray:
    """One code per byte and one for the end: the two symbols before it and the symbol itself."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    padded = np.concatenate([[EDGE, EDGE], raw, [EDGE]])
    return (padded[:-2] * SYMBOLS + padded[1:-1]) * SYMBOLS + padded[2:]


def trigram_counts(docs: DataFrame, in_target: str) -> DataFrame:
    """``code``, ``target``, ``background``: how often each trigram occurs in the target rows and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column("text").to_pylist(), batch.column(in_target).to_pylist()
            if not texts:
                continue
            parts = [trigram_codes(text) for text in texts]
            codes, place = np.unique(np.concatenate(parts), return_inverse=True)
            target = np.repeat(np.array(marks, np.float64), [len(p) for p in parts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes), pa.array(np.bincount(place, target).astype(np.int64)),
                 pa.array(np.bincount(place).astype(np.int64))],
                ["code", "target", "background"],
            )

    partial = docs.select("text", in_target).mapInArrow(count, "code long, target long, background long")
    return partial.groupBy("code").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


class Model:
    """Witten-Bell interpolation of trigram, bigram, unigram and uniform estimates."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        context, symbol = codes // SYMBOLS, codes % SYMBOLS
        uniform = np.full(SYMBOLS, 1 / SYMBOLS)
        ones = np.bincount(symbol, counts, SYMBOLS)
        total, kinds = ones.sum(), (ones > 0).sum()
        self.one = (ones + kinds * uniform) / (total + kinds) if total else uniform
        pairs = (context % SYMBOLS) * SYMBOLS + symbol
        twos = np.bincount(pairs, counts, SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)
        kinds = (twos > 0).sum(1, keepdims=True)
        mass = twos.sum(1, keepdims=True) + kinds
        self.two = np.where(mass > 0, (twos + kinds * self.one) / np.where(mass > 0, mass, 1), self.one)
        seen = counts > 0
        total = np.bincount(context[seen], counts[seen], SYMBOLS * SYMBOLS)
        kinds = np.bincount(context[seen], minlength=SYMBOLS * SYMBOLS)
        # The share that a context leaves to the shorter one; all of it where the context is new.
        self.left = np.where(total > 0, kinds / np.where(total > 0, total + kinds, 1), 1.0)
        self.weight = np.where(total > 0, 1 / np.where(total > 0, total + kinds, 1), 0.0)
        order = np.argsort(codes[seen])
        self.codes, self.counts = codes[seen][order], counts[seen][order]

    def fields(self) -> dict[str, np.ndarray]:
        return dict(vars(self))


def losses(model: dict[str, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Negative log2 probabilities of the last symbols of ``codes``."""
    context, symbol = codes // SYMBOLS, codes % SYMBOLS
    chance = model["left"][context] * model["two"][context % SYMBOLS, symbol]
    if len(model["codes"]):
        place = np.minimum(np.searchsorted(model["codes"], codes), len(model["codes"]) - 1)
        known = model["codes"][place] == codes
        chance += np.where(known, model["counts"][place], 0) * model["weight"][context]
    return -np.log2(chance)


def fit(docs: DataFrame, in_target: str) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Target and background model of ``docs`` (``text``, and a flag column ``in_target``)."""
    light_batches(docs.sparkSession)
    rows = trigram_counts(docs, in_target).toArrow()  # at most 257^3 rows
    codes = rows.column("code").to_numpy()
    target, background = (rows.column(n).to_numpy().astype(np.float64) for n in ("target", "background"))
    scale = target.sum() / background.sum() if len(codes) and background.sum() else 1.0
    return Model(codes, target).fields(), Model(codes, background * (scale or 1.0)).fields()


def score(docs: DataFrame, target: dict[str, np.ndarray], background: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id``, ``n_symbols``, ``target_bits``, ``background_bits``, ``score`` for every row of ``docs``.

    Bits are means per symbol, the end included, so null and empty texts have one symbol. With an empty target
    the target model is uniform. Repeated rows get equal scores; null ids are passed on.
    """
    light_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((target, background))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                codes, often = np.unique(trigram_codes(text), return_counts=True)
                n = int(often.sum())
                rows.append((n, *(float(losses(model, codes) @ often) / n for model in shared.value)))
            n, near, far = (list(column) for column in zip(*rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(near, pa.float64()),
                 pa.array(far, pa.float64())],
                ["doc_id", "n_symbols", "target_bits", "background_bits"],
            )

    weighed = docs.select("doc_id", "text").mapInArrow(
        weigh, f"doc_id {kind}, n_symbols long, target_bits double, background_bits double"
    )
    return weighed.withColumn("score", F.col("target_bits") - F.col("background_bits"))


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``in_target`` of all ``docs``."""
    chosen = settle(target_ids.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct(), "target")
    chosen = broadcast_within(chosen.withColumn("in_target", F.lit(True)), 24)
    return docs.select("doc_id", "text").join(chosen, "doc_id", "left").withColumn(
        "in_target", F.coalesce("in_target", F.lit(False))
    )


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores of all ``docs``, with the documents named in ``target_ids`` (``doc_id``) as the target corpus."""
    return score(docs, *fit(_marked(docs, target_ids), "in_target"))


class WordHashes:
    """Texts to 64-bit word hashes: A-Z lower-cased, parted at ASCII blanks."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.seen) > FREQUENT:
            self.seen.clear()
        for word in set(words).difference(self.seen):
            self.seen[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(self.seen.__getitem__, words), np.uint64, len(words))


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit code for every pair of word hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on, their lowest bytes first, then all second bytes and so on: small ones take little room."""
    planes = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T
    deflate = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return deflate.compress(planes[: (int(values.max()).bit_length() + 7) // 8].tobytes()) + deflate.flush()


def unpack(data: bytes, n: int) -> np.ndarray:
    """The ``n`` (at least 1) numbers of ``pack``."""
    used = np.frombuffer(zlib.decompress(data), np.uint8).reshape(-1, n)
    planes = np.zeros((n, 8), np.uint8)
    planes[:, : len(used)] = used.T
    return planes.view(np.uint64).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their distances."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


def chunks(docs: DataFrame) -> DataFrame:
    """The word sequences of ``docs`` (``doc_id``, ``text``, ``in_target``), about ``CHUNK`` words of whole texts to a row.

    ``words`` are the hashes of a chunk's words in order, ``sequence`` the places of its words there, with an edge (the
    hash 0) before, between and behind its texts, so that all neighbours in it are pairs. ``lengths`` and ``marks``
    (in the target or not) belong to ``doc_ids``. It is a table in buckets by ``chunk``: no later step shuffles it.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"chunk long, n long, n_words int, words binary, sequence binary, doc_ids array<{kind}>, lengths array<long>, "
        "marks array<boolean>"
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, edge, task, made = WordHashes(), np.zeros(1, np.uint64), TaskContext.get().partitionId(), 0
        parts, ids, marks, size, of_ids = [edge], [], [], 0, None

        def chunk() -> pa.RecordBatch:
            words, sequence = np.unique(np.concatenate(parts), return_inverse=True)
            lengths = [len(part) + 1 for part in parts[1::2]]
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | made]), pa.array([size]), pa.array([len(words)], pa.int32()),
                 pa.array([pack_keys(words)], pa.binary()), pa.array([pack(sequence)], pa.binary()),
                 pa.array([ids], pa.list_(of_ids)), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([marks], pa.list_(pa.bool_()))],
                ["chunk", "n", "n_words", "words", "sequence", "doc_ids", "lengths", "marks"],
            )

        for batch in batches:
            of_ids = batch.column("doc_id").type
            for doc_id, text, mark in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "in_target"))):
                parts += [hashes(text), edge]
                ids.append(doc_id)
                marks.append(mark)
                size += len(parts[-2]) + 1
                if size >= CHUNK or len(ids) >= CHUNK_TEXTS:
                    yield chunk()
                    made += 1
                    parts, ids, marks, size = [edge], [], [], 0
        if ids:
            yield chunk()

    name, buckets = f"layercake.chunks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql("CREATE SCHEMA IF NOT EXISTS layercake")
    docs.select("doc_id", "text", "in_target").mapInArrow(gather, schema).write.format("parquet").option(
        "path", shared_dir(spark, "chunks")
    ).bucketBy(buckets, "chunk").sortBy("chunk").saveAsTable(name)
    return spark.table(name)


class Chunk:
    """A row of ``chunks``: ``words``, ``sequence``, and the different ``codes`` of its pairs in order.

    ``first`` and ``second`` are the places of a pair's words, ``pair`` the places of the codes along the sequence.
    """

    def __init__(self, row: dict) -> None:
        self.words = unpack_keys(row["words"], row["n_words"])
        self.sequence = unpack(row["sequence"], row["n"] + 1).astype(np.int32)
        self.lengths = np.array(row["lengths"], np.int64)
        self.marks = np.repeat(np.array(row["marks"], bool), self.lengths)
        before, after = self.sequence[:-1], self.sequence[1:]
        self.codes, at, self.pair = np.unique(
            pair_codes(self.words[before], self.words[after]), return_index=True, return_inverse=True
        )
        self.first, self.second = before[at], after[at]

    def counted(self, places: np.ndarray, kinds: int) -> np.ndarray:
        """How often each of the places occurs in the target and in all texts of the chunk."""
        return np.stack([np.bincount(places, self.marks, kinds).astype(np.int64), np.bincount(places, minlength=kinds)])


_PART = "chunk long, block int, n int, keys binary, counts binary"


def _bounds(n: int) -> np.ndarray:
    """The 64-bit keys at which ``n`` blocks of equal range part."""
    return np.array([(i << 64) // n for i in range(1, n)], np.uint64)


def _blocks(chunk: int, keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.Table:
    """Rows of ``_PART``: ascending keys with their counts (a line for each kind), cut at ``bounds``."""
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    rows = [
        (chunk, block, end - start, pack_keys(keys[start:end]), pack(counts[:, start:end].ravel()))
        for block, (start, end) in enumerate(zip(cuts, cuts[1:])) if end > start
    ]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    names = ["chunk", "block", "n", "keys", "counts"]
    return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)


def totals(parts: DataFrame, kinds: int) -> DataFrame:
    """Answers to ``parts`` (``_PART``): ``totals`` of each key over all chunks, in the order of the asking row's keys.

    ``owned`` marks the keys that a row is the first to have, so each key is owned once. ``sums`` and ``held`` are, for
    each of the ``kinds`` of counts, the sum of its totals and the number of them above 0 over the owned keys.
    """

    def add(asked: pa.Table) -> pa.Table:
        rows = sorted(asked.to_pylist(), key=lambda row: row["chunk"])
        ends = np.cumsum([row["n"] for row in rows])
        keys = np.concatenate([unpack_keys(row["keys"], row["n"]) for row in rows])
        counts = np.concatenate([unpack(row["counts"], kinds * row["n"]).reshape(kinds, -1) for row in rows], axis=1)
        found, at, place = np.unique(keys, return_index=True, return_inverse=True)
        whole = np.zeros((kinds, len(found)), np.uint64)
        for total, count in zip(whole, counts):
            np.add.at(total, place, count)
        owned = np.zeros(len(keys), np.uint64)
        owned[at] = 1
        answers = []
        for row, start, end in zip(rows, [0, *ends.tolist()], ends.tolist()):
            own, total = owned[start:end], whole[:, place[start:end]]
            mine = total[:, own > 0]
            answers.append((
                row["chunk"], row["block"], row["n"], pack(total.ravel()), pack(own),
                mine.sum(1).tolist(), (mine > 0).sum(1).tolist(),
            ))
        of = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ["chunk", "block", "n", "totals", "owned", "sums", "held"]
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*answers), of)], names)

    return parts.groupBy("block").applyInArrow(
        add, "chunk long, block int, n int, totals binary, owned binary, sums array<long>, held array<long>"
    )


def _answered(rows: pa.Table, column: str, kinds: int) -> np.ndarray:
    """The answers in a column along all keys of a chunk, a line for each kind."""
    rows = sorted(rows.to_pylist(), key=lambda row: row["block"])
    return np.concatenate([unpack(row[column], kinds * row["n"]).reshape(kinds, -1) for row in rows], axis=1)


def word_cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``doc_id``, ``n_symbols``, ``target_bits``, ``background_bits``, ``score`` for every row of ``docs``.

    The target corpus are the documents named in ``target_ids`` (``doc_id``), the background are all documents. Bits are
    means per word, the end of the text included, so texts without words have one symbol. With an empty target the
    target model is uniform. Rows of equal texts get equal scores; null ids are passed on and are in no target.
    """
    spark = docs.sparkSession
    light_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = chunks(_marked(docs, target_ids))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.agg(F.sum("n"), F.sum("n_words")).first()
    of_pairs, of_words = (_bounds(max((size or 0) // BLOCK, least)) for size in sizes)

    def pairs_of(row: dict) -> pa.Table:
        chunk = Chunk(row)
        return _blocks(row["chunk"], chunk.codes, chunk.counted(chunk.pair, len(chunk.codes)), of_pairs)

    def ask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from pairs_of(batch.slice(i, 1).to_pylist()[0]).to_batches()

    pairs = settle(totals(rows.mapInArrow(ask_pairs, _PART), 2).drop("sums", "held"), "pairs")

    def ask_words(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        chunk = Chunk(row)
        (owned,), (target, _) = _answered(right, "owned", 1) > 0, _answered(right, "totals", 2) > 0
        # Each pair counts for its first word in the chunk that owns it.
        mine, known = chunk.first[owned], chunk.first[owned & target]
        n = len(chunk.words)
        # A word comes first in as many pairs as it comes second.
        counts = [chunk.counted(chunk.sequence[1:], n), [np.bincount(known, minlength=n), np.bincount(mine, minlength=n)]]
        return _blocks(row["chunk"], chunk.words, np.concatenate(counts), of_words)

    asked = rows.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(ask_words, _PART)
    words = settle(totals(asked, 4).drop("owned"), "words")
    total = words.agg(
        *[F.sum(F.col("sums")[i]).alias(name) for i, name in enumerate(("target", "background"))],
        *[F.sum(F.col("held")[i]).alias(f"{name}_kinds") for i, name in enumerate(("target", "background"))],
    ).first().asDict()
    # The background is scaled to the mass of the target.
    scale = (total["target"] or 0) / (total["background"] or 1) or 1.0

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        chunk = Chunk(row)
        on_words = pc.field("on_words")
        in_pairs = _answered(right.filter(~on_words), "totals", 2).astype(np.float64)
        in_words = _answered(right.filter(on_words), "totals", 4).astype(np.float64)
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        bits = []
        for i, (model, factor) in enumerate((("target", 1.0), ("background", scale))):
            mass, seen = (total[model] or 0) * factor, total[f"{model}_kinds"]
            uniform = 1 / max(total["background_kinds"], 1)
            word = (in_words[i] * factor + seen * uniform) / (mass + seen) if seen else np.full(len(chunk.words), uniform)
            # The share that a first word leaves to the second alone; all of it where nothing is known to follow.
            left_over, after = in_words[2 + i][chunk.first], in_words[i][chunk.first] * factor
            pair = (in_pairs[i] * factor + left_over * word[chunk.second]) / np.maximum(after + left_over, 1e-300)
            loss = -np.log2(np.where(left_over > 0, pair, word[chunk.second]))
            bits.append(np.add.reduceat(loss[chunk.pair], starts) / chunk.lengths)
        return pa.Table.from_arrays(
            [left.column("doc_ids").combine_chunks().flatten(), pa.array(chunk.lengths), *map(pa.array, bits)],
            ["doc_id", "n_symbols", "target_bits", "background_bits"],
        )

    columns = ["chunk", "block", "n", "totals"]
    answers = pairs.select(*columns, F.lit(False).alias("on_words")).unionByName(
        words.select(*columns, F.lit(True).alias("on_words"))
    )
    weighed = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        weigh, f"doc_id {kind}, n_symbols long, target_bits double, background_bits double"
    )
    return weighed.withColumn("score", F.col("target_bits") - F.col("background_bits"))
