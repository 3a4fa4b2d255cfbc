from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import ann, catalogue, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def every(n):
    return F.pmod("vec_id", F.lit(n)) == 0


def truth(rows, asks, k):
    """Brute force over (id, vector) in double precision."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for at in range(len(ids)):
        if asks(ids[at]):
            scores = (x * x[at]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if j != at][:k]
            out[int(ids[at])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def answers(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hit / sum(map(len, want.values()))


def vectors_of(n, d=24, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    return centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, d))


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = answers(catalogue.op3_ann(spark, folder)), truth(rows, lambda i: i % 20 == 0, 20)
    assert recall(got, want) >= 0.97
    for q in want:
        true = dict(truth_scores(rows, q))
        for i, s in got[q]:
            assert s == pytest.approx(true[i], abs=1e-12)


def truth_scores(rows, q):
    at = dict(rows)[q]
    for i, v in rows:
        yield i, float(np.dot(np.array(v, np.float64), np.array(at, np.float64)))


@pytest.mark.parametrize("scale", [1.0, None])
def test_recall_over_many_lists_blocks_and_chunks(spark, monkeypatch, scale):
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "QUERIES", 16)
    x = vectors_of(1500)
    if scale is None:  # norms that differ by a factor of ten
        x *= np.random.default_rng(2).uniform(0.3, 3, (len(x), 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    got = answers(ann.search(df, every(10), k=8, list_rows=100))
    assert recall(got, truth(rows, lambda i: i % 10 == 0, 8)) >= 0.95


def test_copies_ties_and_odd_rows(spark, clashing):
    one, two = [1.0, 0.0, 2.0], [0.5, 0.5, 0.0]
    rows = [(i, one, 0) for i in range(0, 60, 2)] + [(i, two, 0) for i in range(1, 20, 2)]
    odd = [
        (100, None, 0), (120, [], 0), (140, [0.0, 0.0, 0.0], 0), (160, [1.0, None, 1.0], 0),
        (180, [1.0, float("nan"), 1.0], 0), (200, [float("inf"), 1.0, 1.0], 0), (220, [1.0, 2.0], 0), (None, one, 0),
    ]
    df = clashing(spark.createDataFrame(rows + odd + rows[:3], SCHEMA))
    got = answers(ann.search(df, every(20), k=5))
    want = truth([(i, v) for i, v, _ in rows], lambda i: i % 20 == 0, 5)
    assert got == want
    assert [i for i, _ in got[0]] == [2, 4, 6, 8, 10]
    few = ann.search(spark.createDataFrame(rows[:3], SCHEMA), every(20), k=5)
    assert answers(few) == {0: [(2, 5.0), (4, 5.0)]}
    assert ann.search(df.limit(0), every(20)).count() == 0
    assert ann.search(spark.createDataFrame(odd[:5], SCHEMA), every(20)).count() == 0
    assert ann.search(df, F.lit(False)).count() == 0


def test_doubles_keep_their_precision(spark):
    rows = [(i, [1.0 + i * 1e-12, 0.5]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(ann.search(df, F.col("vec_id") == 0, k=3))
    assert [i for i, _ in got[0]] == [29, 28, 27]


def test_scan_abandons_but_keeps_the_best():
    x = vectors_of(600, d=64, spread=1.0)
    space = ann.Space(64, float(np.sqrt((x**2).sum(axis=1)).max()))
    turned = space.points(x)
    columns = [turned[:, c].T for c in vectors.chunks(turned.shape[1], ann.COLUMNS)]
    q = x[:50]
    scores = q @ x.T
    floors = np.sort(scores, axis=1)[:, -10]
    found = {j: set(ids.tolist()) for j, ids, _ in ann.scan(q, space.queries(q), floors, space.longest, x, columns, np.arange(600), 10)}
    hit = sum(len(found.get(j, set()) & set(np.argsort(-scores[j])[:10].tolist())) for j in range(50))
    assert hit >= 0.97 * 500


def test_space_turns_products_into_distances():
    x = vectors_of(40, d=8)
    space = ann.Space(8, float(np.sqrt((x**2).sum(axis=1)).max()))
    a, b = space.queries(x[:5]), space.points(x)
    far = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    assert far == pytest.approx((x[:5] ** 2).sum(axis=1)[:, None] + space.longest**2 - 2 * x[:5] @ x.T)


@pytest.mark.parametrize("d", [1, 2, 7])
def test_nearest_cells_against_all_cells(d):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((60, d))
    cells = vectors.Cells(x, 20)
    first, second = cells._halves(x)
    far = ((first[:, None] - cells.first[None]) ** 2).sum(axis=2)[:, :, None]
    far = (far + ((second[:, None] - cells.second[None]) ** 2).sum(axis=2)[:, None, :]).reshape(len(x), -1)
    assert far.shape[1] == len(cells)
    for n in (1, 2, 5, len(cells), 99):
        got = np.take_along_axis(far, cells.nearest(x, n), axis=1)
        assert got == pytest.approx(np.sort(far, axis=1)[:, : min(n, len(cells))], abs=1e-9)


def test_probes_go_on_until_they_hold_enough_rows():
    x = np.random.default_rng(3).standard_normal((50, 6))
    cells = vectors.Cells(x, 36)
    filled = np.zeros(len(cells), np.int64)
    filled[::5] = 3
    all_cells = cells.nearest(x, len(cells))
    for n, least in ((1, 1), (1, 10), (3, 5), (99, 1), (1, 10**6)):
        for row, got in zip(all_cells, cells.nearest_filled(x, n, filled, least)):
            held = [c for c in row if filled[c]]
            assert got.tolist() == held[: max(n, -(-least // 3))]
