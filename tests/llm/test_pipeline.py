"""The pipeline: every stage on what the one before it kept, against what the operators say one by one."""

import corpus_pipeline
from corpus_fixtures import make  # noqa: F401
from layercake.llm import decontaminate, lsh_forest, quality
from layercake.llm.common import settle, table
from layercake.llm.queries import QUERIES
from layercake.llm.sql import SQL
from test_lsh_forest import brute
from test_text_stages import hits_of, kept_lines

SMALL = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = table(spark, SMALL, "documents")
    columns, rows = docs.columns, {}
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SMALL), name)
        rows[name] = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
    texts = lambda name: [(r.doc_id, r.text) for r in rows[name]]
    scored = quality.classify(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    good = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    assert sorted(texts("quality_classifier")) == sorted((i, t) for i, t in before if i in good)
    assert dict(texts("line_dedup")) == kept_lines(texts("quality_classifier"))
    assert all(r.n_chars == len(r.text) for r in rows["line_dedup"] if r.text)
    component = brute(texts("line_dedup"), 5)
    assert sorted(texts("minhash_near_dedup")) == sorted((i, t) for i, t in texts("line_dedup") if component[i] == i)
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    hit = hits_of(texts("minhash_near_dedup"), items)
    assert sorted(texts("decontamination")) == sorted((i, t) for i, t in texts("minhash_near_dedup") if not hit[i][3])
    assert {r.doc_id: r.n_tokens for r in rows["byte_bpe"]}.keys() == dict(texts("decontamination")).keys()
    assert all(r.n_tokens == len(r.ids) for r in rows["byte_bpe"])
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.ids_sha256) for r in run.collect()) == sorted((r.doc_id, r.ids_sha256) for r in rows["byte_bpe"])


def test_stages_on_odd_rows(spark, make):
    rows = [(1, "Some fine text that is not repeated."), (1, "Some fine text that is not repeated."), (2, None), (3, ""),
            (None, "A text without an id that stays."), (4, "word " * 20_000)]
    docs = make(rows)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = settle(stage(spark, docs, SMALL), "stage")
        assert sorted((r.doc_id or 0, len(r.text or "")) for r in docs.collect()) == sorted(
            (i or 0, len(t or "")) for i, t in rows
        )
        assert docs.filter("text IS NULL").count() == 1
    assert corpus_pipeline.byte_bpe(spark, docs, SMALL).count() == len(rows)
    empty = make([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_near_dedup_removes_rows_by_their_own_text(spark, make):
    """Ids that repeat with different texts, and rows without an id."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (2, one + " end"), (2, two), (None, one), (None, three), (None, three), (None, three + " end"),
            (5, None), (5, ""), (None, None)]
    kept = corpus_pipeline.minhash_near_dedup(spark, make(rows), SMALL)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    without = [x for x in found if x not in ((None, three), (None, three + " end"))]
    assert without == sorted([(1, one), (2, two), (5, None), (5, ""), (None, None)], key=str)
    assert [x for x in found if x not in without] in ([(None, three)] * 2, [(None, three + " end")])


def test_what_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert lsh_forest.THRESHOLD == 80 and decontaminate.WIDTH == 10
