"""Fill-in-middle against string slices, exact restoring, and odd inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpus_fixtures import make  # noqa: F401
from layercake.llm import rotation
from layercake.llm.common import table
from layercake.llm.queries import op13_fill_in_middle

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def expected(i, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_registered_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = op13_fill_in_middle(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        *front, output = expected(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == tuple(front)
        assert r.output_sha256 == sha(output) and r.restored_sha256 == sha(docs[r.doc_id] or "")


def test_odd_texts(make):
    texts = [None, "", "a", " ", "漢", "<P>", "a<M>b", "<S", "P>", "<P<S>", "é" * 50, "\U0001f600a" * 30, "x" * 100_000, "a b\n" * 3]
    rows = [(i, text) for i, text in enumerate(texts * 12)] + [(None, "no id"), (None, "no id"), (3, "again"), (3, "again")]
    cut = rotation.transform(make(rows))
    back = rotation.restored(cut)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back.collect()), key=str)
    assert got == sorted(((i, *expected(i, text)) for i, text in rows), key=str)
    assert all(r.text == r.source for r in make(rows).selectExpr("doc_id", "coalesce(text, '') AS source").distinct()
               .join(back.select("doc_id", "text").distinct(), "doc_id").filter("doc_id >= 4").collect())
    assert rotation.transform(make([])).count() == 0
    for column in ("output", "form"):
        assert rotation.restored(cut.withColumn(column, F.lit(None).cast("string"))).filter("text IS NOT NULL").count() == 0


@pytest.mark.parametrize("block", [1, 3, 16, 1 << 20])
def test_cuts_in_blocks(monkeypatch, block):
    monkeypatch.setattr(rotation, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(300):
        text = "".join(rng.choice("abZ <>\n.é漢\U0001f600PSM") for _ in range(rng.randint(0, 40)))
        data, units = text.encode(), UNIT.findall(text)
        n = rotation.count_units(data)
        assert n == len(units)
        a, b = sorted((rng.randint(0, n), rng.randint(0, n)))
        (first, before), (second, until) = rotation._places(data, (a, b))
        assert data[:first].decode() == "".join(units[:a]) and before == len("".join(units[:a]))
        assert data[:second].decode() == "".join(units[:b]) and until == len("".join(units[:b]))


def test_rotations_undo_each_other():
    rng = random.Random(5)
    for _ in range(200):
        data = bytes(rng.randrange(256) for _ in range(rng.randint(0, 30)))
        start, middle, end = sorted(rng.randint(0, len(data)) for _ in range(3))
        buffer = bytearray(data)
        rotation.rotate(buffer, start, middle, end)
        assert buffer == data[:start] + data[middle:end] + data[start:middle] + data[end:]
        rotation.rotate(buffer, start, start + end - middle, end)
        assert buffer == data


def test_columns_of_clashing_names_are_not_read(spark):
    docs = spark.createDataFrame([("7", "a b c", 1, "plain", "x")], "doc_id string, text string, n int, form string, output string")
    row = rotation.restored(rotation.transform(docs)).first()
    assert (row.doc_id, row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == ("7", *expected("7", "a b c"))
    assert row.text == "a b c"
