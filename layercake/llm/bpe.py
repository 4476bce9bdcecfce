"""Byte-level BPE: overlapping chunks are split in parallel, stitched, encoded, and decoded again.

A text longer than a chunk is cut into chunks that overlap. Every chunk is split into pre-tokens on
its own. The pattern looks ahead but never back, so two neighbouring chunks agree on all that follows
once they share one boundary; the text is cut at the first shared boundary of each overlap and the
pieces between the cuts are encoded in parallel. A boundary serves as a cut only if it follows a
character that is not white space (a run of white space is split by what comes after it) and lies
well before the end of the chunk. A text with an overlap without a shared boundary (one endless word)
is encoded whole, so every text gets exactly the ids it would get in one go.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layercake.llm.common import light_batches

CHUNK = 65_536
OVERLAP = 4_096
# The longest look-ahead of the pattern is two characters ("'re"); boundaries nearer to the end of a
# chunk than this are not trusted.
MARGIN = 16

_IDS = pa.list_(pa.int32())


@dataclass(frozen=True)
class Vocabulary:
    """The lines of a rank file and the pattern that splits texts.

    The driver reads the file (a few MB at most) and broadcasts it; executors need no copy of it.
    """

    lines: bytes
    pattern: str

    def share(self, spark: SparkSession) -> Broadcast:
        return spark.sparkContext.broadcast({"lines": self.lines, "pattern": self.pattern})


def _ranks(lines: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in lines.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _encoding(shared: dict) -> tiktoken.Encoding:
    """Made once for each Python worker, which keeps the broadcast dictionary between tasks."""
    if "encoding" not in shared:
        shared["encoding"] = tiktoken.Encoding(
            "ranks", pat_str=shared["pattern"], mergeable_ranks=_ranks(shared["lines"]), special_tokens={}
        )
    return shared["encoding"]


def _token_bytes(shared: dict) -> dict[int, bytes]:
    if "bytes" not in shared:
        shared["bytes"] = {rank: token for token, rank in _ranks(shared["lines"]).items()}
    return shared["bytes"]


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    """(start, chunk with its overlap) for a whole text."""
    for start in range(0, max(len(text), 1), chunk):
        yield start, text[start : start + chunk + overlap]


def boundaries(piece: str, pattern: regex.Pattern, final: bool) -> list[int]:
    """Ends of pre-tokens of a chunk, relative to its start, that may serve as cuts."""
    ends = [0] if piece else []
    limit = len(piece) if final else len(piece) - MARGIN
    for match in pattern.finditer(piece):
        end = match.end()
        if end > limit:
            break
        if not piece[end - 1].isspace():
            ends.append(end)
    return ends


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``ids`` (array<int>) for every row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts get an empty array. Other columns are not read, whatever their names.
    Repeated rows come out as often as they went in; a null id stays null. An empty table gives an
    empty table.
    """
    spark = docs.sparkSession
    light_batches(spark)
    shared = vocabulary.share(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > chunk

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        for batch in batches:
            ids = [encoding.encode_ordinary(text) for text in batch.column("text").to_pylist()]
            kept = [batch.column(name) for name in batch.schema.names if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, _IDS)], [*names, "ids"])

    plain = f"doc_id {kind}, ids array<int>"
    short = texts.filter(~is_long).mapInArrow(encode_rows, plain)

    # Long texts: equal rows once, with their number, so that (doc_id, text) names a row.
    long = (
        texts.filter(is_long).groupBy("doc_id", "text").agg(F.count("*").alias("times"))
        .withColumn("key", F.sha2(F.concat_ws(" ", F.col("doc_id").cast("string"), "text"), 256))
    )

    def cut_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for start, part in chunks_of(text, chunk, overlap):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([start], pa.int64()), pa.array([part])],
                        ["key", "start", "part"],
                    )

    def split_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(shared.value["pattern"])
        for batch in batches:
            heads, tails = [], []
            for start, part in zip(batch.column("start").to_pylist(), batch.column("part").to_pylist()):
                ends = boundaries(part, pattern, final=False)
                heads.append([start + end for end in ends if end <= overlap])
                tails.append([start + end for end in ends if end >= chunk])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("start"), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))],
                ["key", "start", "head", "tail"],
            )

    chunks = long.select("key", "text").mapInArrow(cut_chunks, "key string, start long, part string")
    dealt = chunks.repartition("key", "start")
    in_text = W.partitionBy("key").orderBy("start")
    found = dealt.mapInArrow(split_chunks, "key string, start long, head array<long>, tail array<long>")
    cuts = (
        found.withColumn("next_head", F.lead("head").over(in_text))
        .withColumn("to", F.array_min(F.array_intersect("tail", "next_head")))
        .withColumn("from", F.coalesce(F.lag("to").over(in_text), F.lit(0)))
        .withColumn("unmet", F.col("next_head").isNotNull() & F.col("to").isNull())
        .withColumn("whole", F.max("unmet").over(W.partitionBy("key")))
        .select("key", "start", "from", "to", "whole")
    )
    pieces = (
        dealt.join(cuts.filter(~F.col("whole")), ["key", "start"])
        .select("key", "start",
                F.expr("substr(part, int(`from` - start) + 1,"
                       " int(coalesce(`to`, start + length(part)) - `from`))").alias("text"))
        .mapInArrow(encode_rows, "key string, start long, ids array<int>")
    )
    stitched = pieces.groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "ids"))), lambda p: p["ids"])).alias("ids")
    )
    in_one_go = (
        long.join(cuts.filter("whole").select("key").distinct(), "key", "left_semi")
        .select("key", "text").mapInArrow(encode_rows, "key string, ids array<int>")
    )
    again = long.select("key", "doc_id", "times").join(stitched.unionByName(in_one_go), "key")
    repeated = again.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return short.unionByName(repeated.select("doc_id", "ids"))


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``tokens`` (``doc_id``, ``ids``) with ``decoded`` (binary), the concatenated bytes of the tokens.

    An empty or null array decodes to no bytes; an id outside the vocabulary is an error.
    """
    spark = tokens.sparkSession
    shared = vocabulary.share(spark)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _token_bytes(shared.value)
        for batch in batches:
            texts = [b"".join([of[i] for i in ids or ()]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        decode_rows, f"doc_id {kind}, ids array<int>, decoded binary"
    )


def digests(decoded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of encoded and decoded documents, with ``ids`` where asked for."""
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return decoded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *([ids.alias("ids")] if keep_ids else []),
    )


def read_vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """The given rank file and pattern, or the public multilingual ones."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return Vocabulary(file.read(), pattern or public_tokenizers.PATTERN)
