"""Line dedup, decontamination, sharding and byte-level BPE against brute force, and their odd inputs."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from corpus_fixtures import make  # noqa: F401
from layercake.llm import bpe, decontaminate, line_runs, shards
from layercake.llm.common import table

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def small(spark):
    return table(spark, SMALL, "documents").select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text for r in small.collect()}


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# Lines


def kept_lines(rows, min_docs=5):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(LOWER) for line in (text or "").split("\n")] for _, text in rows]
    often, last = Counter(), {}
    for (i, _), own in zip(rows, keys):
        for key in {k for k in own if len(k) >= 40}:
            often[key] += 1
            last[key] = max(last.get(key, i), i)
    return {
        i: "\n".join(line for line, key in zip((text or "").split("\n"), own)
                     if not (often[key] >= min_docs and last[key] != i))
        for (i, text), own in zip(rows, keys)
    }


def lines_of(docs, **options):
    return {r.doc_id: r for r in line_runs.drop_repeated_lines(docs, **options).collect()}


def test_lines_of_the_table(small, texts):
    found = lines_of(small)
    expected = kept_lines(list(texts.items()))
    assert {i: r._kept for i, r in found.items()} == expected and any(r._n_dropped for r in found.values())


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_odd(make, batches):
    long, wide = "A long line that many documents repeat, É!", "é" * 39 + "x"
    rows = [(i, f" {long}\t\n{i} own\n{long.lower()}\n{wide}") for i in range(6)]
    rows += [(7, None), (8, ""), (9, "\n\n"), (10, long[:39]), (11, "\xa0" + long), (12, long.replace("É", "é"))]
    rows += [(i, "short but often") for i in range(20, 30)]
    found = lines_of(make(rows), batches=batches)
    assert {i: r._kept for i, r in found.items()} == kept_lines(rows)
    assert (found[0]._n_lines, found[0]._n_dropped, found[5]._n_dropped) == (4, 3, 1)
    assert (found[7]._n_lines, found[9]._n_lines) == (1, 3)
    assert found[0].source == "s"


def test_lines_empty_table_and_repeated_rows(make):
    assert line_runs.drop_repeated_lines(make([])).count() == 0
    line = "the very same line of more than forty letters"
    found = line_runs.drop_repeated_lines(make([(i // 2, f"{line}\n{i // 2}") for i in range(12)] + [(None, line)])).collect()
    assert sorted((r.doc_id, r._n_dropped) for r in found if r.doc_id is not None) == sorted(
        (i // 2, int(i // 2 < 5)) for i in range(12)
    )
    assert [r._n_dropped for r in found if r.doc_id is None] == [1]


def test_runs_are_compacted_and_anti_joined(spark, make):
    runs = line_runs.LineRuns(spark, "bigint", fanout=2)
    line = lambda i: f"line number {i} with enough letters to be counted"
    for batch in range(5):
        keys = line_runs.line_keys(make([(10 * batch + i, f"{line(i)}\n{line(batch + 100)}") for i in range(3)]))
        assert runs.new_lines(keys).count() == (6 if batch == 0 else 3)
        # The run of a batch holds the keys that the anti-join leaves; the first batch has all of its own.
        assert runs.add(keys).count() == (4 if batch == 0 else 1)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted((r.n_docs, r.keeper) for r in runs.total().collect()) == [
        *((3, 10 * b + 2) for b in range(5)), (5, 40), (5, 41), (5, 42)
    ]


def test_a_batch_meets_the_runs_without_a_shuffle(spark, make):
    runs = line_runs.LineRuns(spark, "bigint", fanout=3)
    for batch in range(2):
        runs.add(line_runs.line_keys(make([(i, f"this line of batch {batch} is long enough, number {i}") for i in range(9)])))
    batch = spark.table(runs.levels[0][0][0])
    plan = runs.new_lines(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3 and runs.new_lines(batch).count() == 0


def test_the_query_feeds_its_batches_through_the_anti_join(spark, make, monkeypatch):
    rows = [(i, f"a line that each of the documents holds in this test\nand line {i % 3} that only some of them hold") for i in range(40)]
    plain, seen = line_runs.LineRuns.new_lines, []

    def counted(self, keys):
        found = plain(self, keys)
        seen.append(found.count())
        return found

    monkeypatch.setattr(line_runs.LineRuns, "new_lines", counted)
    got = lines_of(make(rows))
    assert len(seen) == line_runs.BATCHES - 1 and set(seen) <= {0, 1, 2}
    assert {i: r._kept for i, r in got.items()} == kept_lines(rows)


# Decontamination


def word_list(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def hits_of(rows, items):
    windows = {}
    for item, text in items:
        words = word_list(text)
        for j in range(max(len(words) - 9, 1) if words else 0):
            windows.setdefault(tuple(words[j : j + 10]), set()).add(item)
    out = {}
    for i, text in rows:
        words, hit, found = word_list(text), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if tuple(words[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(words[j : j + n])]
        out[i] = (len(words), len(hit), sorted(str(x) for x in found if x is not None), bool(hit))
    return out


def found_hits(docs, benchmark):
    rows = decontaminate.contamination(docs, benchmark).collect()
    assert all(r.n_items == len(r.item_ids) for r in rows)
    return {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows}


def test_contamination_of_the_table(spark, small, texts):
    benchmark = table(spark, SMALL, "benchmark")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = found_hits(small, benchmark)
    assert found == hits_of(texts.items(), items) and any(x[3] for x in found.values())
    assert decontaminate.clean(small, benchmark).count() == sum(not x[3] for x in found.values())


def test_contamination_odd(spark, make, monkeypatch):
    item = "The quick, brown fox jumps over the lazy dog and the cat sleeps"
    items = [(1, item), (2, item), (3, "short one"), (4, ""), (5, None), (None, "null item words"), (6, "the " * 12), (7, "É")]
    rows = [(1, f"x {item.upper()} y"), (2, "the quick brown fox jumps over the lazy dog"), (3, "a Short-ONE b short one"),
            (4, None), (5, ""), (6, "..."), (7, "the " * 40), (8, "null ITEM words"), (9, "é"), (10, "É"), (11, f"{item} {item}")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    expected = hits_of(rows, items)
    assert found_hits(make(rows), benchmark) == expected
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 700)
    assert found_hits(make(rows), benchmark) == expected
    assert {r.doc_id for r in decontaminate.clean(make(rows), benchmark).collect()} == {i for i, x in expected.items() if not x[3]}


def test_contamination_empty_tables_and_repeated_rows(spark, make):
    benchmark = spark.createDataFrame([(1, "some words to be found")], "item_id int, text string")
    assert decontaminate.contamination(make([]), benchmark).count() == 0
    assert found_hits(make([(1, "a b")]), benchmark.limit(0)) == {1: (2, 0, [], False)}
    rows = [(1, "some words to be found"), (1, "some words to be found"), (1, "clean"), (None, "some words to be found")]
    found = decontaminate.contamination(make(rows), benchmark).collect()
    assert sorted((r.doc_id or 0, r.n_hit) for r in found) == [(0, 5), (1, 0), (1, 5), (1, 5)]


# Shards


def test_shards_are_contiguous_and_balanced(small, texts):
    found = shards.shard_by_bytes(small).collect()
    size = {i: len(t.encode()) + 16 for i, t in texts.items()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in found} == {
        i: (size[i], zlib.crc32(t.encode())) for i, t in texts.items()
    }
    order = sorted(texts, key=lambda i: (hashlib.md5(texts[i].encode()).hexdigest(), i))
    assert [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))] == order
    first, total = 0, sum(size.values())
    at = {r.doc_id: r.shard for r in found}
    for i in order:
        assert at[i] == first * 40 // total
        first += size[i]


def test_shards_odd(make):
    assert shards.shard_by_bytes(make([])).count() == 0
    rows = [(1, None), (2, ""), (3, "é"), (None, "x"), (4, "same")] + [(5, "same")] * 200
    found = shards.shard_by_bytes(make(rows), shards=4).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r["size"] for r in found} == {1: 16, 2: 16, 3: 18, None: 17, 4: 20, 5: 20}
    for shard in range(4):
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 20


# Byte-level BPE


def round_trip(docs, vocabulary, **options):
    tokens = bpe.encode(docs, vocabulary, **options)
    return bpe.decode(tokens, vocabulary).collect()


def test_encoding_of_the_table(small, texts, encoding):
    vocabulary = bpe.read_vocabulary()
    for options in ({}, {"chunk": 200, "overlap": 60}):
        found = round_trip(small, vocabulary, **options)
        assert {r.doc_id: r.ids for r in found} == {i: encoding.encode_ordinary(t) for i, t in texts.items()}
        assert all(bytes(r.decoded).decode() == texts[r.doc_id] for r in found)


def test_encoding_odd(make, encoding):
    rng = random.Random(3)
    pieces = ["we're ", "it's", "  ", "\n\n", "\t", "x", "12345", "日本語", "é", " ", "!!!", "'", " 'r", "e", "🙂", "\r\n", "<|endoftext|>"]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randrange(1, 400)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " " * 500), (103, "a" * 700), (104, "ab " * 300), (105, "\n" * 90 + "x")]
    rows += [(106, "ab " * 300), (106, "ab " * 300), (None, "cd " * 300)]
    found = round_trip(make(rows), bpe.read_vocabulary(), chunk=64, overlap=40)
    assert len(found) == len(rows)
    expected = {i: encoding.encode_ordinary(t or "") for i, t in rows}
    assert all(r.ids == expected[r.doc_id] for r in found)
    digests = {r.doc_id: r for r in bpe.digests(bpe.decode(bpe.encode(make(rows[:5] + rows[60:62]), bpe.read_vocabulary()), bpe.read_vocabulary())).collect()}
    assert digests[100].n_tokens == 0 and digests[101].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    ids = ",".join(map(str, expected[0])).encode()
    assert digests[0].ids_sha256 == hashlib.sha256(ids).hexdigest()


def test_encoding_empty_table(make):
    assert round_trip(make([]), bpe.read_vocabulary()) == []


def test_cuts_keep_white_space_runs_whole():
    pattern = regex.compile(public_tokenizers.PATTERN)
    text = "one  two\n\n three " * 20
    assert all(not text[end - 1].isspace() for end in bpe.boundaries(text, pattern, final=False)[1:])


def test_unknown_token_is_an_error(spark):
    tokens = spark.createDataFrame([(1, [50_000_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="50000000"):
        bpe.decode(tokens, bpe.read_vocabulary()).select(F.length("decoded")).collect()
