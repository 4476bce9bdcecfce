import numpy as np
import pytest

from layercake.llm import pivots


def brute(rows, cosine=0.98):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    links = {i: set() for i, _, _ in rows}
    for i, a, v in rows:
        for j, b, w in rows:
            if i != j and a is not None and a == b and ok(v) and ok(w) and len(v) == len(w):
                v_, w_ = np.array(v, float), np.array(w, float)
                v_, w_ = v_ / np.abs(v_).max(), w_ / np.abs(w_).max()
                if v_ @ w_ / np.sqrt((v_ @ v_) * (w_ @ w_)) >= cosine:
                    links[i].add(j)
    component = {}
    for i in sorted(links):
        if i not in component:
            stack, component[i] = [i], i
            while stack:
                for j in links[stack.pop()]:
                    if j not in component:
                        component[j] = i
                        stack.append(j)
    return {i: (len(links[i]), component[i]) for i in links}


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)


def test_links_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    vectors = [(rng.normal(size=32)).tolist() for _ in range(80)]
    vectors += [(centre + rng.normal(size=32) * 0.08).tolist() for _ in range(120)]
    vectors += [vectors[0]] * 5 + [(2 * np.array(vectors[0])).tolist()] * 2
    rows = [(i, i % 2, np.float32(v).tolist()) for i, v in enumerate(vectors)]
    expected = brute(rows)
    for block in (1024, 16):
        found = {r.vec_id: (r.n_links, r.component_id) for r in
                 pivots.near_duplicates(embeddings(spark, rows), block=block).collect()}
        true, got = (sum(n for n, _ in x.values()) for x in (expected, found))
        assert true > 500 and got >= 0.99 * true
        assert all(found[i][0] <= expected[i][0] for i in found)
        assert {i: c for i, (_, c) in found.items()} == {i: c for i, (_, c) in expected.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0]), (3, None, [1.0, 0.0]), (4, 0, None), (5, 0, []), (6, 0, [0.0, 0.0]),
            (7, 0, [1.0, None]), (8, 0, [nan, 1.0]), (9, 0, [inf, 1.0]), (10, 0, [1.0, 0.0, 0.0]), (11, 1, [1.0, 0.0]),
            (12, 0, [1e-30, 0.0]), (13, 0, [1e30, -0.0]), (14, 0, [-1.0, 0.0]), (2, 0, [1.0, 0.0])]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_duplicates(embeddings(spark, rows)).collect())
    near = {1, 2, 12, 13}
    assert found == sorted((i, 4 if i in near else 0, 1 if i in near else i, i == 1 or i not in near) for i, _, _ in rows)
    assert pivots.near_duplicates(embeddings(spark, [])).count() == 0


def fast(vectors, cosine=0.98):
    """Links and smallest reachable ids of vectors with one label, by all products."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    component = np.arange(len(unit))
    while True:
        lowest = np.where(linked, component[None, :], len(unit)).min(1)
        lower = np.minimum(component, lowest)
        if (lower == component).all():
            return linked.sum(1), component
        component = lower


def cluster(rng, size, noise, dimension=32):
    return rng.normal(size=dimension) + rng.normal(size=(size, dimension)) * noise


@pytest.mark.parametrize("sizes, noise, others", [
    ([150], 0.08, 0), ([2000], 0.08, 0), ([2000], 0.08, 2000), ([1500], 0.12, 1500), ([30] * 40, 0.08, 300),
])
def test_dense_clusters_alone_and_among_others(spark, sizes, noise, others):
    rng = np.random.default_rng(len(sizes) + others)
    vectors = np.vstack([*(cluster(rng, n, noise) for n in sizes), rng.normal(size=(others, 32))])
    vectors = np.float32(vectors).astype(np.float64)[rng.permutation(len(vectors))]
    rows = [(i, 1, v.tolist()) for i, v in enumerate(vectors)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_duplicates(embeddings(spark, rows)).collect()}
    links, component = fast(vectors)
    got = np.array([found[i][0] for i in range(len(vectors))])
    assert links.sum() > 1000 and (got <= links).all() and got.sum() >= 0.999 * links.sum()
    assert [found[i][1] for i in range(len(vectors))] == component.tolist()


def test_no_link_is_handed_on_as_a_row(spark):
    """One row per vector, list and pair of blocks leaves the comparison, however many links there are."""
    vectors = np.float32(cluster(np.random.default_rng(5), 400, 0.02))
    nodes = pivots.nodes_of(embeddings(spark, [(i, 1, v.tolist()) for i, v in enumerate(vectors)]))
    chosen = pivots.choose_pivots(nodes, 400, 0.98, 2)
    assert len(chosen[32][0]) == 1
    links = pivots.verified(pivots.in_blocks(pivots.permutations(nodes, chosen), 100), 0.98, 2)
    assert links.count() <= 400 * 4 and links.agg({"others": "sum"}).first()[0] == 400 * 399


def test_columns_of_clashing_names_are_left_alone(spark):
    rows = spark.createDataFrame(
        [(1, 1, [1.0, 0.0], "x", 7, None), (2, 1, [1.0, 0.0], "y", 8, 2)],
        "vec_id long, label int, embedding array<float>, node string, pivot int, component_id int",
    )
    found = pivots.near_duplicates(rows)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
