"""Quality, language, token totals and language models: held-out accuracy, brute force and odd inputs."""

import importlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_fixtures import make  # noqa: F401
from layercake.llm import bpe, language, lm_scoring, quality, token_counts
from layercake.llm.common import table
from layercake.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# Quality


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    hidden = [(r.quality, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    assert len(hidden) > 50 and np.mean([a == b for a, b in hidden]) > 0.95
    assert np.mean([b for a, b in hidden if a == 1]) > 0.98


def test_quality_learns_from_texts_and_labels_alone(spark, make):
    """Held-out labels, languages, sources and ids change no score."""
    rows = [(i, "good words in a sentence here. " * 3 if i % 2 else "$$$ &&& *** ### !!! " * 4) for i in range(80)]
    labels = [(i, i % 2, 0) for i in range(80)]
    turned = [(i, q if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    docs = make(rows)
    plain = quality.classify(docs, spark.createDataFrame(labels, schema))
    other = quality.classify(docs.withColumn("lang", F.lit("xx")), spark.createDataFrame(turned, schema))
    as_dict = lambda df: {r.doc_id: round(r.score, 9) for r in df.collect()}
    assert as_dict(plain) == as_dict(other)
    assert {r.doc_id: r.predicted for r in plain.collect()} == {i: i % 2 for i in range(80)}


def test_votes_equal_brute_force():
    rng = np.random.default_rng(4)
    counts = rng.poisson(0.3, (60, quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 60)
    space = quality.Space(counts.copy(), labels).fields()
    asked = rng.poisson(0.3, (20, quality.TERMS)).astype(np.float64)
    for row, score in zip(asked, quality.votes(asked, space)):
        weighted = row * space["rarity"]
        latent = weighted / np.linalg.norm(weighted) @ space["directions"]
        similar = space["vectors"].astype(float) @ (latent / np.linalg.norm(latent))
        best = np.argsort(-similar)[: quality.NEIGHBOURS]
        weight = np.clip(similar[best], 0, 1) ** quality.SHARPNESS
        assert score == pytest.approx(
            ((weight * labels[best]).sum() + 1e-3 * labels.mean()) / (weight.sum() + 1e-3), abs=1e-3
        )


def test_quality_odd(spark, make):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 0), (3, 0), (4, None), (None, 1), (99, 1)], "doc_id long, quality int"
    )
    rows = [(1, "fine text"), (1, "fine text"), (2, None), (3, "### ###"), (4, ""), (None, "x"), (5, "word " * 50_000)]
    found = quality.classify(make(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    base = {r.score for r in found if r.doc_id in (2, 4)}
    assert len(base) == 1
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert quality.classify(make([]), labels).count() == 0
    none = quality.classify(make(rows), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}


# Language


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_language_of_the_table(spark):
    pages, docs = table(spark, MEDIUM, "pages"), table(spark, MEDIUM, "documents")
    found = {r.page_id: r for r in language.identify(pages, docs).collect()}
    assert len(found) == pages.count()
    declared = [(r.declared, r.lang) for r in found.values() if r.declared]
    assert np.mean([a == b for a, b in declared]) > 0.97


def test_language_evidence_is_fused(spark, make):
    docs = make([(1, "the cat and the dog with this"), (2, "der hund und die katze mit dem")] * 20)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("de"))
    german, english = "der hund und die katze mit dem " * 4, "the cat and the dog with this " * 4
    rows = [(i, f"https://www.haus.de.example/{i}", f"<html lang=de><p>{german}</p></html>") for i in range(30)]
    rows += [(100 + i, f"https://www.home.example/en/{i}", f"<html lang='EN'><p>{english}</p></html>") for i in range(30)]
    rows += [
        (200, "https://www.haus.de.example/x", ""),  # the host alone
        (201, None, "<html lang=de></html>"),  # the declaration alone
        (202, "https://elsewhere.org/en/1", None),  # the address alone
        (203, "https://www.haus.de.example/y", f"<html lang=de><script>{german}</script>{english}</html>"),  # text wins
        (204, None, None), (204, None, None), (None, "not an address", f"<b>{german}</b>"),
        (205, "https://elsewhere.org/de/1", "<html lang=fr>" + german * 2000),
    ]
    found = {}
    for r in language.identify(pages_of(spark, rows), docs).collect():
        found.setdefault(r.page_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    assert all(found[i][0].lang == "de" and found[100 + i][0].lang == "en" for i in range(30))
    assert [found[i][0].lang for i in (200, 201, 202, 203, 205)] == ["de", "de", "en", "en", "de"]
    assert found[204][0].text_lang is None and len(found[204]) == 2 and found[None][0].lang == "de"
    assert all(0 < r.confidence <= 1 for rs in found.values() for r in rs)


def test_language_of_empty_tables(spark, make):
    docs = make([(1, "some text")])
    assert language.identify(pages_of(spark, []), docs).count() == 0
    found = language.identify(pages_of(spark, [(1, "http://a.b/en", "x")]), docs.limit(0)).collect()
    assert [(r.lang, r.confidence, r.suffix) for r in found] == [(None, 0.0, "en")]


# Token totals


def test_rollup_follows_inserts_revisions_and_deletes(spark, make):
    schema = "doc_id long, source string, lang string, version string, n_tokens long, n_bytes long"
    rollup = token_counts.Rollup(spark)
    state, batches = {}, []

    def send(name, counts=(), gone=()):
        done = rollup.commit(
            name, spark.createDataFrame(list(counts), schema) if counts else None,
            spark.createDataFrame(list(gone), "doc_id long, version string") if gone else None,
        )
        if done:
            batches.append(name)
            for row in sorted(counts, key=lambda r: (r[4], r[5], r[1] or "", r[2] or "")):
                state[row[0], row[3]] = row
            for key in gone:
                state.pop(tuple(key), None)
        expected = {}
        for row in state.values():
            total = expected.setdefault(row[1:4], [0, 0, 0])
            for i, value in enumerate((1, row[4], row[5])):
                total[i] += value
        assert {(r.source, r.lang, r.version): [r.n_docs, r.n_tokens, r.n_bytes] for r in rollup.totals().collect()} == expected
        return done

    assert send("a", [(1, "s", "en", "v1", 10, 40), (2, "s", "de", "v1", 5, 20), (3, None, None, "v1", 1, 1)])
    assert send("b", [(1, "t", "en", "v1", 12, 44), (1, "s", "en", "v2", 7, 44), (4, "s", "en", "v1", 0, 0)])
    assert not send("b", [(9, "s", "en", "v1", 99, 99)])
    assert send("c", [(4, "s", "en", "v1", 3, 9), (4, "s", "en", "v1", 2, 9)], [(2, "v1"), (77, "v1")])
    assert send("d", [(2, "s", "de", "v1", 5, 20)], [(3, "v1"), (4, "v1")])
    assert rollup.committed() == batches
    assert sorted(r.doc_id for r in rollup.current().collect()) == [1, 1, 2]
    with pytest.raises(ValueError):
        rollup.commit("x/y")


def test_rollup_batch_that_failed_halfway(spark, monkeypatch):
    schema = "doc_id long, source string, lang string, version string, n_tokens long, n_bytes long"
    rollup = token_counts.Rollup(spark)
    counts = spark.createDataFrame([(1, "s", "en", "v", 10, 40)], schema)
    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(type(spark.read), "schema", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        rollup.commit("a", counts)
    assert rollup.committed() == [] and rollup.totals().count() == 0
    assert rollup.commit("a", counts) and [r.n_tokens for r in rollup.totals().collect()] == [10]


def test_token_counts(spark, make):
    rows = [(1, "some text to count"), (2, None), (3, ""), (1, "some text to count"), (None, "é"), (4, "word " * 30_000)]
    vocabulary = bpe.read_vocabulary()
    found = token_counts.count_tokens(make(rows), vocabulary, "v").collect()
    encoding = bpe._encoding({"lines": vocabulary.lines, "pattern": vocabulary.pattern})
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_bytes) for r in found) == sorted(
        (i or 0, len(encoding.encode_ordinary(t or "")), len((t or "").encode())) for i, t in rows
    )
    assert token_counts.count_tokens(make([]), vocabulary, "v").count() == 0


# Language models


def model_by_hand(texts, scale=1.0):
    """Witten-Bell trigram probabilities by plain counting."""
    edge, three, two, one = 256, Counter(), Counter(), Counter()
    for text in texts:
        symbols = [edge, edge, *text.encode(), edge]
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            three[a, b, c] += scale
            two[b, c] += scale
            one[c] += scale

    def chance(a, b, c):
        p = (one[c] + len(one) / 257) / (sum(one.values()) + len(one)) if one else 1 / 257
        after = {s: n for (x, s), n in two.items() if x == b}
        if after:
            p = (two[b, c] + len(after) * p) / (sum(after.values()) + len(after))
        after = {s: n for (x, y, s), n in three.items() if (x, y) == (a, b)}
        if after:
            p = (three[a, b, c] + len(after) * p) / (sum(after.values()) + len(after))
        return p

    return chance


def test_cross_entropy_difference_equals_counting_by_hand(spark, make):
    rows = [(1, "abab"), (2, "abc é"), (3, "zzzz"), (4, None), (5, ""), (5, "again"), (None, "abab")]
    target = spark.createDataFrame([(1,), (2,), (2,), (None,), (77,)], "doc_id long")
    found = lm_scoring.cross_entropy_difference(make(rows), target).collect()
    texts = [t or "" for _, t in rows]
    chosen = [t or "" for i, t in rows if i in (1, 2)]
    size = lambda ts: sum(len(t.encode()) + 1 for t in ts)
    near, far = model_by_hand(chosen), model_by_hand(texts, size(chosen) / size(texts))
    expected = []
    for i, text in rows:
        symbols = [256, 256, *(text or "").encode(), 256]
        bits = [np.mean([-math.log2(m(*g)) for g in zip(symbols, symbols[1:], symbols[2:])]) for m in (near, far)]
        expected.append((i or 0, len(symbols) - 2, round(bits[0] - bits[1], 9)))
    assert sorted((r.doc_id or 0, r.n_symbols, round(r.score, 9)) for r in found) == sorted(expected)


def test_models_are_distributions():
    codes, counts = np.unique(np.concatenate([lm_scoring.trigram_codes(t) for t in ("abcabc", "aé")]), return_counts=True)
    model = lm_scoring.Model(codes, counts.astype(float)).fields()
    for context in ((256, 256), (97, 98), (1, 2)):
        asked = np.array([(context[0] * 257 + context[1]) * 257 + s for s in range(257)])
        assert np.exp2(-lm_scoring.losses(model, asked)).sum() == pytest.approx(1)


def test_scores_tell_the_target_apart(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    good = labels.filter("quality = 1")
    found = {r.doc_id: r.score for r in lm_scoring.cross_entropy_difference(docs, good).collect()}
    by = {q: [found[r.doc_id] for r in labels.filter(f"quality = {q}").collect()] for q in (0, 1)}
    assert np.median(by[1]) < np.median(by[0])


def test_lm_empty(spark, make):
    target = spark.createDataFrame([(1,)], "doc_id long")
    assert lm_scoring.cross_entropy_difference(make([]), target).count() == 0
    found = lm_scoring.cross_entropy_difference(make([(2, "ab")]), target).collect()
    assert found[0].target_bits == pytest.approx(math.log2(257))


def words_by_hand(rows, chosen):
    """Mean losses of every row by Witten-Bell word bigrams counted plainly; target rows have an id in ``chosen``."""
    split = lambda text: [b"", *(text or "").encode().lower().split(), b""]
    pairs = [list(zip(split(t), split(t)[1:])) for _, t in rows]
    far = Counter(p for ps in pairs for p in ps)
    near = Counter(p for (i, _), ps in zip(rows, pairs) if i in chosen for p in ps)
    vocabulary = len({w for _, w in far})

    def model(counts, scale):
        one, mass, kinds = Counter(), Counter(), Counter()
        for (v, w), n in counts.items():
            one[w] += n * scale
            mass[v] += n * scale
            kinds[v] += 1
        total = sum(one.values())

        def chance(v, w):
            p = (one[w] + len(one) / vocabulary) / (total + len(one)) if one else 1 / vocabulary
            return (counts[v, w] * scale + kinds[v] * p) / (mass[v] + kinds[v]) if kinds[v] else p

        return chance

    models = model(near, 1.0), model(far, sum(near.values()) / sum(far.values()) or 1.0)
    return [(i, len(ps), *(np.mean([-math.log2(m(*p)) for p in ps]) for m in models)) for (i, _), ps in zip(rows, pairs)]


def same(found, expected):
    order = lambda r: (r[0] or 0, r[1], round(r[2], 6))
    found = sorted(((r.doc_id, r.n_symbols, r.target_bits, r.background_bits) for r in found), key=order)
    expected = sorted(expected, key=order)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert np.array([r[2:] for r in found]) == pytest.approx(np.array([r[2:] for r in expected]))


def test_query_scores_by_all_word_pairs_of_the_corpus(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    chosen = {r.doc_id for r in table(spark, SMALL, "labels").filter("quality = 1 AND toxic = 0").collect()}
    same(QUERIES["op9_cross_entropy_difference"](spark, SMALL).collect(), words_by_hand(rows, chosen))


@pytest.mark.parametrize("chosen", [{1, 2}, set()])
def test_word_pairs_on_odd_rows(spark, make, monkeypatch, chosen):
    monkeypatch.setattr(lm_scoring, "FREQUENT", 4)
    rows = [(1, "dog bites man"), (2, "a dog a Dog"), (3, "man bites dog"), (4, None), (5, ""), (5, "again a"),
            (None, "dog bites man"), (1, "dog bites man"), (7, "dog bites man"), (8, " ")]
    target = spark.createDataFrame([(i,) for i in [*chosen, *chosen, 77, None]], "doc_id long")
    found = lm_scoring.word_cross_entropy_difference(make(rows), target).collect()
    same(found, words_by_hand(rows, chosen))
    if chosen:
        score = {r.doc_id: r.score for r in found}
        assert score[7] < score[3]  # the same words in another order
    assert lm_scoring.word_cross_entropy_difference(make([]), target).count() == 0


def test_word_pairs_over_many_chunks_and_blocks(spark, make, monkeypatch):
    """Totals are those of all chunks and blocks; rows of equal texts score the same wherever they lie."""
    monkeypatch.setattr(lm_scoring, "CHUNK", 40)
    monkeypatch.setattr(lm_scoring, "CHUNK_TEXTS", 7)
    monkeypatch.setattr(lm_scoring, "BLOCK", 5)
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) % 60)) for i, n in enumerate(rng.integers(0, 30, 90))]
    rows += [(100 + i, "w1 w2 W1\tw7 w1") for i in range(40)] + [(None, "w1 w3"), (None, None), (5, "w1"), (200, "x " * 500)]
    chosen = {3, 5, 9, 104, 105}
    target = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    found = lm_scoring.word_cross_entropy_difference(make(rows), target).collect()
    same(found, words_by_hand(rows, chosen))
    assert len({(r.target_bits, r.background_bits, r.score) for r in found if 100 <= (r.doc_id or 0) < 140}) == 1
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id")
    named = lm_scoring.word_cross_entropy_difference(make(rows).select(name, "text"), target.select(name)).collect()
    assert [r.doc_id for r in named if r.doc_id is None] == [None, None]
    assert sorted(round(r.score, 9) for r in named) == sorted(round(r.score, 9) for r in found)


def test_word_pairs_take_few_bytes(spark, make, monkeypatch, tmp_path):
    """What the word models write stays below the size of the texts, though nearly all pairs differ."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"word{x}" for x in rng.integers(0, 5000, 400))) for i in range(300)]
    for module in (importlib.import_module("layercake.operators.settle"), lm_scoring):
        monkeypatch.setattr(module, "shared_dir", lambda _, what: f"{tmp_path}/{what}", raising=False)
    found = lm_scoring.word_cross_entropy_difference(make(rows), spark.createDataFrame([(1,)], "doc_id long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 300
    written = {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in tmp_path.iterdir()}
    assert 0 < sum(written.values()) < 300 * 401 * 9, written
    assert plan.count("Exchange") == 1  # the answers; the words of the texts stay in their buckets


def test_packed_numbers_come_back():
    for values in ([0], [0, 0, 0], [5, 0, 255, 256], [2**64 - 1, 1], range(1000)):
        values = np.array(values, np.uint64)
        assert lm_scoring.unpack(lm_scoring.pack(values), len(values)).tolist() == values.tolist()
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    assert lm_scoring.unpack_keys(lm_scoring.pack_keys(keys), len(keys)).tolist() == keys.tolist()
