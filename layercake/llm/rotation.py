"""Fill-in-middle texts by rotating blocks in place.

A text is cut into prefix, middle and suffix. All three stand in one bytearray with their sentinels inserted before
them, and the blocks change places by rotations of three reversals each: reversing two neighbouring blocks one by one
and then together exchanges them. A rotation is undone by a rotation with the lengths exchanged, which is how
``restored`` gets the text back from the output and its form alone.

Cuts lie between units: a run of ASCII letters, or any other single code point. They are found by scanning the UTF-8
bytes in blocks of fixed size, so besides the text itself a task holds one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import light_batches

# Sentinels and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

BLOCK = 1 << 20


def _scan(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Block by block: (places at which a unit starts, whether a byte starts a code point)."""
    after_letter = False
    for start in range(0, len(data), BLOCK):
        block = np.frombuffer(data, np.uint8, min(BLOCK, len(data) - start), start)
        folded = block | 0x20
        letter = (folded >= 97) & (folded <= 122) & (block < 128)
        first = (block & 0xC0) != 0x80
        before = np.empty_like(letter)
        before[0], before[1:] = after_letter, letter[:-1]
        after_letter = bool(letter[-1])
        yield np.flatnonzero(first & ~(letter & before)) + start, first


def count_units(data: bytes) -> int:
    return sum(len(starts) for starts, _ in _scan(data))


def _places(data: bytes, units: tuple[int, int]) -> list[tuple[int, int]]:
    """(bytes, code points) of the text before each of two cuts, given in units from the start, the smaller first."""
    found, passed, points = [], 0, 0
    for starts, first in _scan(data):
        block = len(found) < 2 and units[len(found)] - passed < len(starts)
        while block:
            at = int(starts[units[len(found)] - passed])
            offset = at - (at // BLOCK) * BLOCK
            found.append((at, points + int(np.count_nonzero(first[:offset]))))
            block = len(found) < 2 and units[len(found)] - passed < len(starts)
        passed += len(starts)
        points += int(np.count_nonzero(first))
    return found + [(len(data), points)] * (2 - len(found))


def _reverse(buffer: bytearray, start: int, end: int) -> None:
    view = np.frombuffer(buffer, np.uint8)[start:end]
    half = len(view) // 2
    view[:half], view[len(view) - half :] = view[len(view) - half :][::-1].copy(), view[:half][::-1].copy()


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, middle) and [middle, end) in place."""
    _reverse(buffer, start, middle)
    _reverse(buffer, middle, end)
    _reverse(buffer, start, end)


def transform_bytes(data: bytes, first: int, second: int, form: str) -> bytes:
    """The text with its parts, cut at two byte offsets, in the order of ``form``."""
    buffer = bytearray(data)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return bytes(buffer)


def restore_bytes(data: bytes, form: str) -> bytes:
    """The text that ``transform_bytes`` got. Sentinels cannot come up by chance: no text that holds one is cut."""
    if form == PLAIN:
        return data
    buffer = bytearray(data)
    start = buffer.index(SUFFIX)
    # What the rotation moved to the front has the length that it had before.
    moved = buffer.index(MIDDLE if form == PSM else PREFIX, start) - start
    rotate(buffer, start, start + moved, len(buffer))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _drawn(doc_id: object, seed: int) -> list[int]:
    """Four numbers that depend on seed and id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def _as_text(values: list[bytes]) -> pa.Array:
    # The same bytes under another name: they came from valid text and were only moved as whole code points.
    return pa.array(values, pa.binary()).view(pa.string())


def transform(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` for every row (``doc_id``, ``text``).

    ``n`` counts units. The numbers h1 to h4 come from sha256 of seed and id: the cuts are h1 and h2 modulo n + 1, a
    text is left as it is where h3 modulo 100 reaches ``plain_from``, and suffix goes first where h4 modulo 100 is below
    ``spm_below``. Empty and null texts, and texts that hold a sentinel themselves, are plain; plain rows have null
    lengths. A null id is drawn from as an empty one. Repeated rows come out as often as they went in, other columns are
    not read, and an empty table gives an empty table. Work and memory of a row grow with its own text only.
    """
    light_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column("text").cast(pa.binary())
            for i, scalar in zip(batch.column("doc_id").to_pylist(), texts):
                data = scalar.as_py()
                n = count_units(data)
                h1, h2, h3, h4 = _drawn(i, seed)
                if not data or h3 % 100 >= plain_from or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((n, PLAIN, None, None, data))
                    continue
                form = SPM if h4 % 100 < spm_below else PSM
                (first, before), (second, until) = _places(data, tuple(sorted((h1 % (n + 1), h2 % (n + 1)))))
                rows.append((n, form, before, until - before, transform_bytes(data, first, second, form)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()), _as_text(list(columns[4]))],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(
        cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(transformed: DataFrame) -> DataFrame:
    """``transformed`` (any columns, among them ``form`` and ``output``) with ``text``, rebuilt from these two alone.

    A null form or output gives a null text.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in transformed.dtypes)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs, forms = batch.column("output").cast(pa.binary()), batch.column("form").to_pylist()
            texts = [
                None if form is None or not output.is_valid else restore_bytes(output.as_py(), form)
                for output, form in zip(outputs, forms)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, _as_text(texts)], [*batch.schema.names, "text"])

    return transformed.mapInArrow(rebuild, f"{schema}, text string")
