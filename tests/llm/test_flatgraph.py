from __future__ import annotations

import numpy as np
import pytest

from sluiceway.llm import catalogue, flatgraph

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.95):
    """vec_id to links and least id reachable, by all pairs."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = np.array([(x * v).sum(axis=1) >= threshold for v in x])
    np.fill_diagonal(near, False)
    comp = ids.copy()
    while True:
        new = np.array([min(comp[i], comp[near[i]].min(initial=comp[i])) for i in range(len(ids))])
        if (new == comp).all():
            break
        comp = new
    return sorted((int(i), int(n), int(c), bool(i == c)) for i, n, c in zip(ids, near.sum(axis=1), comp))


def rows_of(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_query_against_all_pairs(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert rows_of(catalogue.op10_embedding_dedup(spark, folder)) == plain(rows)


def groups(n_groups=12, d=32, seed=4):
    """Groups of near copies, one large, among unrelated vectors, at different lengths."""
    rng = np.random.default_rng(seed)
    out = []
    for g in range(n_groups):
        base = rng.standard_normal(d)
        for _ in range(220 if g == 0 else int(rng.integers(2, 25))):
            out.append((base + rng.uniform(0.01, 0.22) * rng.standard_normal(d)) * rng.uniform(0.1, 10))
    out += list(rng.standard_normal((300, d)))
    order = rng.permutation(len(out))
    return [(int(k), out[k].tolist()) for k in order]


@pytest.mark.parametrize("nodes", [6144, 60])
def test_groups_over_many_shards_and_parts(spark, monkeypatch, nodes):
    monkeypatch.setattr(flatgraph, "NODES", nodes)
    monkeypatch.setattr(flatgraph, "QUERIES", nodes)
    rows = groups()
    audit: dict = {}
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    got, want = rows_of(flatgraph.near_duplicates(df, 0.95, shard_rows=60, audit=audit)), plain(rows)
    assert audit["recall"] >= 0.99
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.99 * true <= found <= true
    assert sum(a[2] != b[2] for a, b in zip(got, want)) <= 0.01 * len(want)


def test_poor_recall_widens_the_overlap(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "_audited", lambda *a: 0.5)
    rows = groups(4)[:200]
    audit: dict = {}
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = rows_of(flatgraph.near_duplicates(df, 0.95, shard_rows=40, overlap=1, audit=audit))
    assert audit["overlap"] == 4 and got == plain(rows)


def test_copies_and_odd_rows(spark, clashing):
    one, two = [1.0, 0.0, 2.0], [0.5, -0.5, 0.0]
    rows = [(5, one, 0), (3, one, 0), (9, [2.0, 0.0, 4.0], 0), (3, one, 0), (None, one, 0), (7, two, 0)]
    odd = [
        (100, None, 0), (101, [], 0), (102, [0.0, 0.0, 0.0], 0), (103, [1.0, None, 1.0], 0),
        (104, [1.0, float("nan"), 1.0], 0), (105, [float("inf"), 1.0, 1.0], 0), (106, [1.0, 2.0], 0), (None, None, 0),
    ]
    df = clashing(spark.createDataFrame(rows + odd, SCHEMA))
    got = {tuple(r) for r in flatgraph.near_duplicates(df).collect()}
    assert got == {
        (5, 4, 3, False), (3, 4, 3, True), (9, 4, 3, False), (None, 4, 3, False), (7, 0, 7, True), (None, 0, None, False),
        *((k, 0, k, True) for k in range(100, 107)),
    }
    assert flatgraph.near_duplicates(df).count() == len(rows + odd)
    assert flatgraph.near_duplicates(df.limit(0)).count() == 0
    assert rows_of(flatgraph.near_duplicates(spark.createDataFrame(odd[:3], SCHEMA))) == [
        (k, 0, k, True) for k in (100, 101, 102)
    ]


def test_tiny_and_huge_vectors(spark):
    rows = [(1, [1e-30, 0.0]), (2, [1e30, 1e29]), (3, [0.0, 1e-38])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert rows_of(flatgraph.near_duplicates(df)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_pruned_graph_is_searchable():
    rng = np.random.default_rng(8)
    x = flatgraph.unit(rng.standard_normal((900, 32)))
    src, dst = flatgraph.robust_prune(x)
    assert (src != dst).all() and np.bincount(src, minlength=900).min() >= 1
    order = np.lexsort((dst, src))
    starts = np.searchsorted(src[order], np.arange(901))
    found = flatgraph.range_search(x, starts, dst[order], x, 0.95)
    # Each vector finds itself by the greedy walk from the medoid.
    assert found.diagonal().mean() >= 0.99 and found.sum() <= 900


def test_audit_sees_lost_small_groups_beside_a_large_one(spark):
    # A third of the rows is one group, all found; 250 planted pairs are lost.
    assert flatgraph.stratified_recall(np.array([500] * 500 + [1] * 500), np.array([500] * 500 + [0] * 500)) == 0
    assert flatgraph.stratified_recall(np.array([500] * 500 + [1] * 100), np.array([500] * 500 + [1] * 95 + [0] * 5)) == 0.95
    assert flatgraph.stratified_recall(np.zeros(9, int), np.zeros(9, int)) is None
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(32) + 0.01 * rng.standard_normal((500, 32))
    pairs = np.repeat(rng.standard_normal((250, 32)), 2, axis=0)
    pairs += 0.02 * rng.standard_normal(pairs.shape)
    x = np.concatenate([hot, pairs, rng.standard_normal((500, 32))])
    nodes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "rep long, weight long, vector array<double>")
    lost = spark.createDataFrame([(i, 499) for i in range(500)], "rep long, links long")
    whole = lost.union(spark.createDataFrame([(i, 1) for i in range(500, 1000)], "rep long, links long"))
    assert flatgraph._audited(nodes, len(x), lost, 0.95) == 0
    assert flatgraph._audited(nodes, len(x), whole, 0.95) == 1
    # Without a true link among those drawn there is nothing to go by.
    alone = nodes.where("rep >= 1000")
    assert flatgraph._audited(alone, 1 << 20, lost.limit(0), 0.95) is None
