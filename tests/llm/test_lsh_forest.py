import random

import numpy as np
import pytest

from corpus_fixtures import make  # noqa: F401
from layercake.llm import lsh_forest
from layercake.llm.components import connected_components


def brute(rows, width, threshold=80):
    """Component of every id by comparing all pairs."""
    sets, parent = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        sets.setdefault(i, []).append({tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set())
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            for x in sets[a]:
                for y in sets[b]:
                    if a < b and x and 100 * len(x & y) >= threshold * len(x | y):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    return {i: root(i) for i in parent}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """A hub with near copies that are mostly unlike each other, pairs at the edge, a passage, copies, odd texts."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    hub = [word() for _ in range(150)]
    texts = [" ".join(hub)] + [edited(rng, hub, rng.randrange(1, 6)) for _ in range(60)]
    for _ in range(30):
        base = [word() for _ in range(rng.randrange(5, 120))]
        texts += [" ".join(base), edited(rng, base, rng.randrange(0, 5))]
    passage = " ".join(word() for _ in range(40))
    texts += [f"{passage} " + " ".join(word() for _ in range(60)) for _ in range(40)]
    texts += ["same  text\tHERE", "same text here", "Same Text Here", "one", "ONE", "", None, " \n\t ", "É é", "é é"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("limits", [{}, {"cluster_shingles": 500}])
def test_components_equal_brute_force(make, corpus, limits):
    found = lsh_forest.near_duplicates(make(corpus), width=4, **limits).collect()
    expected = brute(corpus, 4)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_deeper_regions_find_no_wrong_link(make, corpus):
    """Regions of at most 8 nodes: prefixes get longer, so links within the hub may be missed, none is made up."""
    found = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(make(corpus), width=4, region=8).collect()}
    expected = brute(corpus, 4)
    assert all(expected[i] == expected[c] for i, c in found.items())
    assert sum(found[i] != i for i in found) >= 0.7 * sum(expected[i] != i for i in expected)


@pytest.mark.parametrize("limits", [{"region": 8}, {"region": 16, "cluster_shingles": 2000}])
def test_star_in_regions_above_the_limit_equals_brute_force(make, limits):
    """Edited copies that are alike to their base alone: longer prefixes miss them, the exact join does not."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(base)] + [edited(rng, base, 5) for _ in range(120)] + [edited(rng, base, 14) for _ in range(20)]
    rows = list(enumerate(texts)) + [(3, texts[7]), (60, "something else of its own"), (500, None)]
    rng.shuffle(rows)
    expected = brute(rows, 4)
    assert 100 < sum(c == 0 for c in expected.values()) < len(expected)
    found = lsh_forest.near_duplicates(make(rows), width=4, **limits).collect()
    assert {r.doc_id: r.component_id for r in found} == expected and len(found) == len(rows)


def test_nodes_that_agree_in_all_minima_stay_together(spark):
    """More equal signatures than a region holds: they are dealt into parts with one node in common."""
    rows = [(i, [7] * lsh_forest.TREES, bytes(lsh_forest.MINIMA)) for i in range(50)]
    nodes = spark.createDataFrame(rows, "node long, keys array<long>, sketch binary")
    placed = lsh_forest.regions(nodes, region=16)
    assert placed.groupBy("tree", "key").count().agg({"count": "max"}).first()[0] <= 20
    tied = connected_components(lsh_forest.ties(placed).selectExpr("node a", "root b"))
    assert {r.component for r in tied.collect()} == {0} and tied.count() == 50


def test_set_sizes_and_odd_texts(make):
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b c d a b c d"), (6, "ä Ä"), (7, "ä ä")]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(make(rows), width=4).collect()}
    assert found == {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (4, 5), 6: (1, 6), 7: (1, 7)}


def test_empty_table_repeated_rows_null_ids(spark, make):
    assert lsh_forest.near_duplicates(make([])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (None, "q r s t u v"), (None, "zz")]
    found = [(r.doc_id, r.component_id, r.kept) for r in lsh_forest.near_duplicates(make(rows)).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 1, True)] * 3 + [(2, 1, False), (None, 1, False), (None, None, True)], key=str
    )


def test_long_text(make):
    text = " ".join(f"w{i}" for i in range(60_000))
    found = lsh_forest.near_duplicates(make([(1, text), (2, text + " end")])).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1}


def test_blocks_of_the_matrix_give_exact_pairs():
    rng = np.random.default_rng(1)
    base = rng.choice(10**6, 9000, replace=False).astype(np.uint64)
    sets = [np.unique(rng.choice(base, rng.integers(7000, 9000), replace=False)) for _ in range(9)]
    expected = [[100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (lsh_forest.alike(sets, 80) == np.array(expected)).all()


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(3, 9), (9, 3), (4, 4), (7, None)] + [(100, i) for i in range(101, 150)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {**{i: 20 for i in range(20, 61)}, 3: 3, 9: 3, **{i: 100 for i in range(100, 150)}}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
