from __future__ import annotations

import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.llm import catalogue, mixing


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in order}
    for _ in range(len(order) + 1):
        excess = sum(max(0, target[s] - 2 * sizes[s]) for s in order)
        full = [s for s in order if target[s] >= 2 * sizes[s]]
        target = {s: min(t, 2 * sizes[s]) for s, t in target.items()}
        rest = [s for s in order if s not in full]
        for s in rest:
            target[s] += excess * weight[s] / sum(weight[r] for r in rest)
    return target


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text(max_size=3) | st.none(), st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    got, want = mixing.targets(sizes), plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in sizes:
        assert got[s] == pytest.approx(want[s], abs=1e-6) and got[s] <= 2 * sizes[s] + 1e-6
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=1e-6)


def test_order_is_by_code_point_and_null_last():
    got = mixing.targets({"b": 100, "B": 100, None: 100, "é": 100})
    assert got["B"] > got["b"] and got[None] == got["B"]


def plain_flow(patterns, quotas, repeats):
    """The most words and the least cost, by trying every split of small networks."""
    best = (0, 0)
    names = list(patterns)
    splits = [
        [c for c in itertools.product(range(repeats * patterns[p] + 1), repeat=len(p)) if sum(c) <= repeats * patterns[p]]
        for p in names
    ]
    for choice in itertools.product(*splits):
        used = dict.fromkeys(quotas, 0)
        cost = 0
        for p, words in zip(names, choice):
            for s, w in zip(p, words):
                used[s] += w
            taken = sum(words)
            cost += sum(k * min(patterns[p], max(0, taken - k * patterns[p])) for k in range(repeats))
        if all(used[s] <= quotas[s] for s in quotas):
            best = max(best, (sum(used.values()), -cost))
    return best


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.sampled_from([("a",), ("b",), ("a", "b"), ("b", "c")]), st.integers(0, 3), min_size=1, max_size=3),
    st.tuples(*[st.integers(0, 6)] * 3),
)
def test_flow_is_largest_and_cheapest(patterns, quotas):
    quotas = {s: q for s, q in zip("abc", quotas) if any(s in p for p in patterns)}
    got = mixing.flow(patterns, quotas, 2)
    used = dict.fromkeys(quotas, 0)
    cost = 0
    for p, size in patterns.items():
        taken = 0
        for s in p:
            used[s] += got.get((p, s), 0)
            taken += got.get((p, s), 0)
        assert taken <= 2 * size
        cost += max(0, taken - size)
    assert all(used[s] <= quotas[s] for s in quotas)
    assert (sum(used.values()), -cost) == plain_flow(patterns, quotas, 2)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect()]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    folder = f"/root/testdata/{scale}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    sizes: dict = {}
    for d in docs:
        sizes[d.source] = sizes.get(d.source, 0) + size[d.doc_id]
    want = plain_targets(sizes)
    got = rows_of(catalogue.op1_mixing(spark, folder))
    source = {d.doc_id: d.source for d in docs}
    assert sorted(r[0] for r in got) == sorted(size)
    taken: dict = {}
    for doc, n, source_size, target, words in got:
        assert n == size[doc] and source_size == sizes[source[doc]] and 0 <= words <= 2 * n
        assert target == pytest.approx(want[source[doc]], rel=1e-12)
        taken[source[doc]] = taken.get(source[doc], 0) + words
    for s, words in taken.items():
        assert abs(words - want[s]) <= 1
    assert sorted(got) == sorted(rows_of(catalogue.op1_mixing(spark, folder)))


def test_odd_rows(spark, docs, clashing):
    rows = docs(
        (1, "a b c", "x"), (1, "a b c", "x"), (None, "a b", None), (None, "a b", None), (2, None, "x"), (3, "", "y"),
        (4, "w " * 40_000, "z"), (5, "only", ""),
    )
    got = rows_of(mixing.mix(clashing(rows), F.array("source")))
    assert len(got) == 8 and {r[1] for r in got} == {0, 1, 2, 3, 40_000}
    want = plain_targets({"x": 6, None: 4, "y": 0, "z": 40_000, "": 1})
    per_target: dict = {}
    for _, size, _, target, taken in got:
        assert taken <= 2 * size
        per_target[target] = per_target.get(target, 0) + taken
    for target, words in per_target.items():
        assert abs(words - sum(t for t in want.values() if t == target)) <= 1.5
    assert mixing.mix(rows.limit(0), F.array("source")).count() == 0
    assert mixing.mix(rows.where("text = ''"), F.array("source")).first().taken == 0


def test_overlapping_sources(spark):
    """Documents of both sources fill the quota that the small one cannot."""
    rows = [(k, "w " * 10, ["a"]) for k in range(50)] + [(100 + k, "w " * 10, ["a", "b"]) for k in range(20)]
    rows += [(200 + k, "w " * 10, ["b"]) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, members array<string>")
    got = mixing.mix(docs, F.col("members"), share=1.0).collect()
    assert sum(r.taken for r in got) == pytest.approx(920, abs=1)  # 1.0 of sizes 700 + 220
    assert all(r.taken in (0, 10, 20) or 0 < r.taken < 20 for r in got)


def test_mixed_repeats_whole_rows(spark, docs, clashing):
    rows = docs(*[(k, "w " * 10, "a" if k < 30 else "b") for k in range(40)])
    out = mixing.mixed(clashing(rows), F.array("source"))
    assert out.columns == clashing(rows).columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(n.values()) <= {1, 2}
    want = plain_targets({"a": 300, "b": 100})
    assert abs(10 * sum(c for k, c in n.items() if k < 30) - want["a"]) <= 5
    assert abs(10 * sum(c for k, c in n.items() if k >= 30) - want["b"]) <= 5


def test_too_many_patterns_are_an_error(spark, docs):
    with pytest.raises(ValueError):
        mixing.mix(docs((1, "a", "x"), (2, "a", "y")), F.array("source"), max_patterns=1)
