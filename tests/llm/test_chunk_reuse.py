"""BPE with reused chunks against the tokenizers library, joins of texts, and odd inputs."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpus_fixtures import make  # noqa: F401
from layercake.llm import chunk_reuse
from layercake.llm.common import table
from layercake.llm.queries import op12_chunk_reuse

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return chunk_reuse.ByteBpe.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def encoded(docs, bpe):
    return sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in chunk_reuse.decode(chunk_reuse.encode(docs, bpe), bpe).collect())


def same(library, rows):
    return sorted((str(i), tuple(of(library, text)), text or "") for i, text in rows)


def test_registered_query(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = op12_chunk_reuse(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = of(library, texts[r.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert decoded == (texts[r.doc_id] or "") and r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_shared_passages(make, bpe, library):
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "thing", "don't", "we're", "12", "漢字", "é!", "\n\n", "  ", "...", "Straße", "'"])
    passages = [" ".join(word() for _ in range(3000)) for _ in range(4)]
    rows = [(i, "".join(rng.choice([*passages, word() * 3, f"own {i} " * 300]) for _ in range(rng.randint(1, 5)))) for i in range(40)]
    assert encoded(make(rows), bpe) == same(library, rows)


def test_odd_texts(make, bpe, library):
    base = " ".join(f"{w} don't 12,3" for w in ["thing", "Ärger", "漢字", "été"] * 900)
    rows = [(1, base), (1, base), (2, "x" + base), (3, base[:5000] + "<|endoftext|>" + base[5000:]), (None, base), (None, ""),
            (4, None), (5, base[100:] + bpe.odd[:3]), (6, "<|endoftext|>" * 3), (7, "a" * 100_000), (8, "漢" * 40_000),
            (9, "漢" * 40_000 + "b"), (10, " " * 50_000 + "a"), (11, " " * 50_000), (12, base[:9000] + " " * 5000 + base[9000:]),
            (13, "'s" * 20_000), (14, "'s" * 20_001), (15, "<|endoftext|"), (16, base + "<|endoftext|>")]
    assert encoded(make(rows), bpe) == same(library, rows)
    assert encoded(make([]), bpe) == []


@pytest.mark.parametrize("near", [1, 2, 32])
def test_joins_are_repaired(monkeypatch, bpe, library, near):
    monkeypatch.setattr(chunk_reuse, "_NEAR", near)
    rng = random.Random(near)
    parts = ["a", "b", "th", "the ", " ", "  ", "\n", "\t", "'re", "'s", "'", "1", "23", "é", "漢字", "。", "\U0001f600", ".", "!?", "ing", "٣", "ß", "́"]
    for _ in range(2000):
        left, right = ("".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(2))
        if bpe.is_odd((left + right).encode()):
            continue
        joined = chunk_reuse.repaired(bpe.encode(left.encode()), bpe.encode(right.encode()), bpe)
        assert joined.tolist() == of(library, left + right), (left, right)


def test_chunks_depend_on_content_only():
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 50_000).astype(np.uint8).tobytes()

    def chunks(data):
        ends = chunk_reuse.chunk_ends(data, 0, len(data), chunk_reuse.borders(data).tolist())
        assert ends[-1] == len(data) and all(b - a <= chunk_reuse._MOST + chunk_reuse._LEAST for a, b in zip([0, *ends], ends))
        return {data[a:b] for a, b in zip([0, *ends], ends)}

    alone, inside = chunks(passage), chunks(b"before " * 200 + passage + b" after" * 100)
    assert len(alone) > 20 and len(alone - inside) <= 3
    assert chunk_reuse.borders(b"").tolist() == [] and chunks("漢".encode() * 40_000)


def test_blocks_do_not_change_borders(monkeypatch):
    data = np.random.default_rng(4).integers(0, 256, 20_000).astype(np.uint8).tobytes()
    whole = chunk_reuse.borders(data).tolist()
    monkeypatch.setattr(chunk_reuse, "_BLOCK", 100)
    assert chunk_reuse.borders(data).tolist() == whole


def test_other_tokenizers_are_refused(tmp_path):
    held = json.load(open(PATH))
    held["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(held))
    with pytest.raises(ValueError, match="byte-level"):
        chunk_reuse.ByteBpe.read(str(tmp_path / "other.json"))


def test_bytes_that_are_no_text(spark, bpe, library):
    ids = [[255, 220], [], None, [50256, 64]]
    tokens = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in chunk_reuse.decode(tokens, bpe).collect()}
    assert got == {i: library.decode(x or [], skip_special_tokens=False) for i, x in enumerate(ids)}


def test_columns_of_clashing_names_are_not_read(spark, bpe, library):
    docs = spark.createDataFrame(
        [("a", "one text", "x", 1, b"2"), ("b", None, None, None, None)], "doc_id string, text string, ids string, row int, digest binary"
    )
    assert encoded(docs, bpe) == same(library, [("a", "one text"), ("b", None)])
