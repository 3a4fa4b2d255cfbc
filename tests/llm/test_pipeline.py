from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from sluiceway.llm import pii, simhash
from tests.llm.test_mixing import plain_targets
from tests.llm.test_packing import verify
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import plain_components


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows on a small folder, written and read again."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == list(P.COLUMNS)
        out[name] = docs.collect()
    return out


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    before = {r.doc_id: r for r in stages["documents"]}
    after = {r.doc_id: r for r in stages["toxicity"]}
    assert all(before[i] == r for i, r in after.items())
    gone = before.keys() - after.keys()
    clean = [i for i in before if labels.get(i) == 0]
    assert gone and sum(i in gone for i in clean) <= 0.02 * len(clean)


def test_one_document_of_each_group_stays(stages):
    rows = stages["toxicity"]
    fps = [(r.doc_id, simhash.fingerprint(r.text)) for r in rows]
    want = set(plain_components(fps))
    assert {r.doc_id for r in stages["simhash near-dedup"]} == want and len(stages["simhash near-dedup"]) == len(want)
    assert set(stages["simhash near-dedup"]) <= set(rows)


def test_personal_data_is_replaced(stages):
    before = {r.doc_id: r for r in stages["simhash near-dedup"]}
    assert len(stages["pii"]) == len(before)
    changed = 0
    for r in stages["pii"]:
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        old = before[r.doc_id]
        assert r.text == pii.redact(old.text, pii.find_spans(old.text)) and (r.lang, r.source) == (old.lang, old.source)
        changed += r.text != old.text
    assert changed


def test_sources_come_near_their_targets(stages):
    def size(r):
        return len(re.findall(r"[^\x20\x09-\x0D]+", r.text))

    before = {r.doc_id: r for r in stages["pii"]}
    sizes: dict = {}
    largest: dict = {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
        largest[r.source] = max(largest.get(r.source, 0), size(r))
    taken = dict.fromkeys(sizes, 0)
    times: dict = {}
    for r in stages["mixing"]:
        assert r == before[r.doc_id]
        taken[r.source] += size(r)
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 2
    for s, target in plain_targets(sizes).items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1


def test_all_that_is_left_is_packed(stages):
    used, least = verify(stages["packing"], stages["mixing"])
    assert used <= least + 2


def test_run_gives_the_stages_rows(spark, stages):
    assert sorted(P.run(spark, "/root/testdata/sf0.01").collect()) == sorted(stages["packing"])


def test_stages_take_odd_rows(spark, docs, clashing):
    rows = docs((1, None), (1, None), (None, None), (None, "mail a@b.co now"), (2, "x y z"), (3, "x y z"), (2, "x y z"))
    for table in (clashing(rows), rows.limit(0)):
        for _, stage in P.STAGES:
            out = stage(spark, table, "/root/testdata/sf0.001")
            assert out.columns == list(P.COLUMNS) or "sequence_id" in out.columns
            assert out.count() >= 0
    kept = [r.doc_id for r in P.drop_near_duplicates(spark, rows, "").collect()]
    assert sorted(kept, key=str) == [1, 2, None, None]


def test_entry_registers_everything():
    names = entry.queries().keys()
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", n)[0] for n in names if re.match(r"op\d", n)}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()


def test_shared_ids_in_two_groups_keep_each_group(spark, docs):
    """ids 5 (A), 5 (B), 2 (B), 9 (A): A keeps 5, B keeps 2; no text is lost."""
    a = "the quick brown fox jumps over the lazy dog again and again"
    b = "completely different words make up this other text in full"
    c = "yet another set of words entirely unrelated to both of them"
    rows = docs((5, a), (5, b), (2, b), (9, a), (7, c), (7, c), (None, b))
    kept = sorted(((r.doc_id if r.doc_id is not None else -1), r.text) for r in P.drop_near_duplicates(spark, rows, "").collect())
    assert kept == sorted([(5, a), (2, b), (7, c), (-1, b)])
