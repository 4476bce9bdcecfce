"""BPE encoding with chunks shared between documents encoded once, and decoding.

A rolling hash over the bytes cuts every text into chunks whose borders depend on nearby content alone, so passages that
documents share are cut alike. A chunk that occurs more than once is encoded once, into a dictionary by its digest;
what lies between such chunks is encoded where it stands. Then the joins are repaired: around each join a
window is encoded anew and widened until both of its ends are boundaries on which the encodings beside it agree, which
makes the ids those of the whole text.

Whether a chunk may be shared is looked up in a bitmap of hashes of fixed size, which is broadcast. A false positive only
sends a chunk through the dictionary that nobody else needs; results never depend on it. Documents without such chunks are
encoded in one go and not shuffled. Of the others, ids of two or four bytes are shuffled, not texts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from layercake.llm.common import light_batches, settle
from layercake.llm.lsh_forest import whole_groups

# Fixed value: the split of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Classes of that pattern.
_CLASSES = (r"\p{L}+", r"\p{N}+", r"\s+")

# Chunks have some KB: a border where the upper ``_BITS`` bits of the hash of the last 32 bytes are zero.
_BITS, _LEAST, _MOST, _WINDOW = 10, 256, 16_384, 32
# Bytes that are hashed at a time, and bits of the bitmap (8 MB).
_BLOCK, _FILTER = 1 << 20, 1 << 26
# Tokens on each side of a join that are looked at first, and chunks that a task remembers to have handed on.
_NEAR, _TOLD = 32, 500_000

_BORDER = regex.compile(r"\p{L}(?=\P{L})|\p{N}(?=\P{N})")
_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=4).digest() for i in range(256)), np.uint32)


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class ByteBpe:
    """A byte-level BPE tokenizer as the tokenizers library stores it; the driver reads it and broadcasts the text."""

    config: str
    odd: str = ""

    @classmethod
    def read(cls, path: str | None = None) -> ByteBpe:
        """The given file, or the public one. Raises ValueError for what is not plain byte-level BPE."""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as file:
            found = cls(file.read())
        plain, model = json.loads(found.config), json.loads(found.config)["model"]
        split = plain.get("pre_tokenizer") or {}
        merged = [found.rank("".join(pair.split(" ") if isinstance(pair, str) else pair)) for pair in model["merges"]]
        if (
            plain.get("normalizer") or plain.get("post_processor") or model["type"] != "BPE"
            or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
            or (plain.get("decoder") or {}).get("type") != "ByteLevel"
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in plain["added_tokens"])
            # Merges in the order of ids, one for each entry beside the bytes: then ranks alone decide.
            or any(a >= b for a, b in zip(merged, merged[1:])) or len(merged) + 256 != len(model["vocab"])
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        return cls(found.config, found.disagreed())

    @cached_property
    def _model(self) -> dict:
        return json.loads(self.config)

    def rank(self, token: str) -> int:
        return self._model["model"]["vocab"][token]

    @cached_property
    def special(self) -> dict[bytes, int]:
        return {t["content"].encode(): t["id"] for t in self._model["added_tokens"]}

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        letters = _byte_letters()
        plain = {i: bytes(map(letters.__getitem__, token)) for token, i in self._model["model"]["vocab"].items()}
        return plain | {i: token for token, i in self.special.items()}

    @cached_property
    def tokens(self) -> pa.Array:
        """The bytes of every id, in the order of ids."""
        return pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of) + 1)], pa.large_binary())

    @cached_property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if max(self.bytes_of) < 1 << 16 else "<u4")

    @cached_property
    def library(self) -> Tokenizer:
        found = Tokenizer.from_str(self.config)
        found.no_truncation()
        found.no_padding()
        return found

    @cached_property
    def ranks(self) -> tiktoken.Encoding:
        ranks = {token: i for i, token in self.bytes_of.items() if token not in self.special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def odd_characters(self) -> tuple[set[str], regex.Pattern]:
        """The odd characters, and the first bytes that they and all later characters may have."""
        first = min(self.odd).encode()[:1] if self.odd else b"\xff"
        return set(self.odd), regex.compile(b"[%s-\xff]" % regex.escape(first))

    def disagreed(self) -> str:
        """Characters that the libraries put into different classes, since they know different versions of Unicode.

        No version has letters, numbers or spaces from U+40000 on.
        """
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000)]))
        single = {bytes([b]): b for b in range(256)}
        odd: set[str] = set()
        for kind in _CLASSES:
            ours = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
            theirs = Split(Regex(kind), "removed").pre_tokenize_str(every)
            rest = set("".join(part for part, _ in theirs))
            sets = [
                set(bytes(ours.encode_ordinary(every)).decode()), set("".join(regex.findall(kind, every))),
                set(every) - rest,
            ]
            odd |= set.union(*sets) - set.intersection(*sets)
        return "".join(sorted(odd))

    def is_odd(self, data: bytes) -> bool:
        odd, late = self.odd_characters
        return late.search(data) is not None and not odd.isdisjoint(data.decode())

    def encode(self, data: bytes) -> np.ndarray:
        """The ids of text without special tokens."""
        return np.array(self.ranks.encode_ordinary(data.decode()), self.dtype)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def sections(self, data: bytes) -> list[tuple[int, int, int | None]]:
        """(start, end, id of the special token it is or None) one after the other."""
        if not any(token in data for token in self.special):
            return [(0, len(data), None)]
        found, at = [], 0
        # Where one token begins another, the longest is taken.
        tokens = regex.compile(b"|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        for match in tokens.finditer(data):
            found += [(at, match.start(), None)] * (match.start() > at) + [(*match.span(), self.special[match[0]])]
            at = match.end()
        return found + [(at, len(data), None)] * (len(data) > at)


def borders(data: bytes | np.ndarray) -> np.ndarray:
    """Places behind which the rolling hash of the last bytes allows a cut."""
    values, found = np.frombuffer(data, np.uint8), []
    for start in range(0, len(values), _BLOCK):
        before = min(start, _WINDOW - 1)
        block = values[start - before : start + _BLOCK]
        total, step = _GEAR[block], 1
        while step < _WINDOW:  # the sum over 2, 4, ... bytes, each shifted by its distance
            wider = total.copy()
            wider[step:] += total[:-step] << np.uint32(step)
            total, step = wider, 2 * step
        at = np.flatnonzero(total[before:] >> np.uint32(32 - _BITS) == 0)
        found.append(at + start + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(data: bytes, start: int, end: int, allowed: list[int]) -> list[int]:
    """Ends of the chunks of a section; ``allowed`` are sorted places in ``data``. Code points stay whole."""
    ends, last = [], start
    for at in [*(a for a in allowed if start < a < end), end]:
        while at - last > _MOST + _LEAST:
            cut = last + _MOST
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if at - last >= _LEAST and at < end and data[at] & 0xC0 != 0x80:
            ends.append(at)
            last = at
    return [*ends, end]


def _chunked(texts: pa.Array, bpe: ByteBpe) -> Iterator[tuple[bytes, list | None]]:
    """(text, [(special id or None, [(start, end, hash)])]) for each text; None for one with odd characters."""
    values = [text.as_py() for text in texts.cast(pa.binary())]
    joined = b"".join(values)
    places, at = borders(joined), 0
    for data in values:
        first, last = np.searchsorted(places, [at + _WINDOW, at + len(data)])
        allowed = (places[first:last] - at).tolist()
        at += len(data)
        if bpe.is_odd(data):
            yield data, None
            continue
        parts = []
        for start, end, special in bpe.sections(data):
            spans, begin = [], start
            for cut in [] if special is not None else chunk_ends(data, start, end, allowed):
                spans.append((begin, cut, xxhash.xxh3_64_intdigest(data[begin:cut])))
                begin = cut
            parts.append((special, spans))
        yield data, parts


def shared_filter(texts: DataFrame, share) -> np.ndarray:
    """A bitmap with the hash of every chunk that occurs more than once."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                h for _, parts in _chunked(batch.column("text"), share.value)
                for _, spans in parts or () for _, _, h in spans
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], ["h"])

    often = texts.select("text").mapInArrow(hashes, "h long").groupBy("h").count().filter("count > 1")
    place = F.pmod(F.col("h"), F.lit(_FILTER)) + 1
    pieces = (
        often.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    )
    found = np.zeros(_FILTER // 8, np.uint8)
    for piece in pieces:
        bits = np.frombuffer(bytes(piece.bits), np.uint8)
        start = (piece.bucket - 1) * len(bits)
        found[start : start + len(bits)] = bits
    return found


def _marked(bitmap: np.ndarray, value: int) -> bool:
    signed = value - (1 << 64) if value >= 1 << 63 else value
    place = signed % _FILTER
    return bool(bitmap[place >> 3] >> (place & 7) & 1)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def repaired(left: np.ndarray, right: np.ndarray, bpe: ByteBpe) -> np.ndarray:
    """The ids of two neighbouring texts in one, from the ids of each.

    A letter before a character that is none, or a digit before one that is none, is a boundary of the split whatever
    stands around it. The window between the last such place on the left and the first on the right is encoded anew;
    where a side has none it is taken whole, step by step.
    """
    take, tail, cut = _NEAR, b"", None
    while cut is None:
        tail = bpe.decode(left[max(0, len(left) - take) :])
        text = tail.decode("utf-8", "ignore")
        ends = [match.end() for match in _BORDER.finditer(text)]
        if ends:
            cut = len(tail) - len(text[ends[-1] :].encode())
        elif take >= len(left):
            cut = 0
        take *= 4
    take, head, until = _NEAR, b"", None
    while until is None:
        head = bpe.decode(right[:take])
        text = head.decode("utf-8", "ignore")
        match = _BORDER.search(text)
        if match:
            until = len(text[: match.end()].encode())
        elif take >= len(right):
            until = len(head)
        take *= 4
    keep, skip = len(left), 0
    back = len(tail) - cut
    while back > 0:
        keep -= 1
        back -= len(bpe.bytes_of[int(left[keep])])
    ahead = until
    while ahead > 0:
        ahead -= len(bpe.bytes_of[int(right[skip])])
        skip += 1
    if back or ahead:
        raise AssertionError("ids on the two sides of a join do not agree with the window")
    return np.concatenate([left[:keep], bpe.encode(tail[cut:] + head[:until]), right[skip:]])


def encode(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """``doc_id``, ``ids`` (array<int>) for every row of ``docs`` (``doc_id``, ``text``).

    The ids are those of the tokenizers library without added special tokens; strings of special tokens in a text are
    these tokens. Null and empty texts get an empty array, repeated rows come out as often as they went in, a null id
    stays null, other columns are not read, and an empty table gives an empty table. Texts with characters on
    which the libraries' versions of Unicode differ are encoded by the tokenizers library in one go.
    """
    spark = docs.sparkSession
    light_batches(spark)
    share = spark.sparkContext.broadcast(bpe)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bitmap = spark.sparkContext.broadcast(shared_filter(texts, share))

    def reuses(parts: list | None) -> bool:
        return parts is not None and any(_marked(bitmap.value, h) for _, spans in parts for _, _, h in spans)

    def in_one_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = share.value
        for batch in batches:
            found, rows = [], []
            for row, (data, parts) in enumerate(_chunked(batch.column("text"), bpe)):
                if reuses(parts):
                    continue
                rows.append(row)
                if parts is None:
                    found.append(np.array(bpe.library.encode(data.decode(), add_special_tokens=False).ids, np.int32))
                    continue
                each = [
                    np.array([special], bpe.dtype) if special is not None else bpe.encode(data[spans[0][0] : spans[-1][1]])
                    for special, spans in parts if spans or special is not None
                ]
                found.append(np.concatenate(each) if each else np.zeros(0, bpe.dtype))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), _lists(found)], ["doc_id", "ids"])

    def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, number, told = share.value, TaskContext.get().partitionId() << 33, set()
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column("doc_id").to_pylist()
            for i, (data, parts) in zip(ids, _chunked(batch.column("text"), bpe)):
                number += 1
                if not reuses(parts):
                    continue
                for section, (special, spans) in enumerate(parts):
                    if special is not None:
                        rows.append((number, i, len(rows), section, None, None, np.array([special], bpe.dtype).tobytes()))
                    run = None
                    for begin, end, h in [*spans, (None, None, None)]:
                        if begin is not None and not _marked(bitmap.value, h):
                            run = (run[0] if run else begin, end)
                            continue
                        if run:
                            rows.append((number, i, len(rows), section, None, None, bpe.encode(data[slice(*run)]).tobytes()))
                            run = None
                        if begin is not None:
                            chunk = data[begin:end]
                            digest = hashlib.blake2b(chunk, digest_size=16).digest()
                            # One copy of the text from each task.
                            rows.append((number, i, len(rows), section, digest, None if digest in told else chunk, None))
                            if len(told) > _TOLD:
                                told.clear()
                            told.add(digest)
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], batch.schema.field("doc_id").type),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()),
                 *(pa.array(column, pa.binary()) for column in columns[4:])],
                ["row", "doc_id", "part", "section", "digest", "chunk", "ids"],
            )

    whole = texts.mapInArrow(in_one_go, f"doc_id {kind}, ids array<int>")
    columns = f"row long, doc_id {kind}, part long, section int, digest binary, chunk binary, ids binary"
    pieces = settle(texts.mapInArrow(in_pieces, columns), "pieces")

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [share.value.encode(chunk).tobytes() for chunk in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(found, pa.binary())], ["digest", "found"])

    chunks = pieces.filter("chunk IS NOT NULL").groupBy("digest").agg(F.max("chunk").alias("chunk"))
    dictionary = chunks.select("digest", "chunk").mapInArrow(encode_chunks, "digest binary, found binary")
    names = ["row", "doc_id", "part", "section", "ids"]
    looked_up = (
        pieces.filter("digest IS NOT NULL").drop("ids").join(dictionary, "digest").withColumnRenamed("found", "ids")
    )
    parts = pieces.filter("digest IS NULL").select(names).union(looked_up.select(names))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = share.value
        for table in whole_groups(batches, "row"):
            rows, sections = (table.column(n).to_numpy() for n in ("row", "section"))
            pieces, ids = table.column("ids").to_pylist(), table.column("doc_id").to_pylist()
            done, found = [], []
            for at, (row, section, piece) in enumerate(zip(rows, sections, pieces)):
                piece = np.frombuffer(piece, bpe.dtype)
                if at == 0 or row != rows[at - 1]:
                    done.append([piece])
                    found.append(ids[at])
                elif section != sections[at - 1]:
                    done[-1].append(piece)
                else:
                    done[-1][-1] = repaired(done[-1][-1], piece, bpe)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, table.schema.field("doc_id").type), _lists([np.concatenate(d) for d in done])], ["doc_id", "ids"]
            )

    joined = parts.repartition("row").sortWithinPartitions("row", "part").mapInArrow(assemble, f"doc_id {kind}, ids array<int>")
    return whole.unionByName(joined)


def decode(tokens: DataFrame, bpe: ByteBpe) -> DataFrame:
    """``tokens`` (``doc_id``, ``ids``) with ``decoded`` (string), special tokens as their strings.

    Bytes that are no UTF-8 become replacement characters, as in the tokenizers library. An empty or null array gives
    an empty text; an id outside the vocabulary is an error.
    """
    share = tokens.sparkSession.sparkContext.broadcast(bpe)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            taken = share.value.tokens.take(lists.flatten())
            if taken.null_count:
                raise ValueError("an id is outside the vocabulary")
            # Tokens taken one after the other lie side by side in memory: a text is what lies between two offsets.
            ends = np.frombuffer(taken.buffers()[1], np.int64) if len(taken) else np.zeros(1, np.int64)
            number = np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()])
            offsets, joined = ends[number].astype(np.int32), taken.buffers()[2]
            texts = pa.StringArray.from_buffers(len(lists), pa.py_buffer(offsets), joined)
            try:
                texts.validate(full=True)
            except pa.ArrowInvalid:
                raw = bytes(joined)
                texts = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, ids array<int>, decoded string")
