from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import merkle
from sluiceway.llm.catalogue import op11_merkle

H = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"


def plain(rows, tamper):
    """Brute force of the whole manifest: rows are (doc_id, source, lang, n_chars, text)."""

    def tree(nodes):
        """levels bottom-up of a list of digests, climbing while more than one remain."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            cur = levels[-1]
            levels.append([H("".join(cur[i : i + 16])) for i in range(0, len(cur), 16)])
        return levels

    def proof(levels, i):
        out = []
        for lv in levels[:-1]:
            s = i // 16 * 16
            out.append(("".join(lv[s:i]), "".join(lv[i + 1 : s + 16])))
            i //= 16
        return out

    leaves = [(r, H("".join(map(enc, r)))) for r in rows]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted([x for x in leaves if x[0][1] == s], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in sources}
    sub = {s: tree([x[1] for x in per[s]]) for s in sources}
    top = tree([sub[s][-1][0] for s in sources])
    root = top[-1][0]
    out = []
    for si, s in enumerate(sources):
        for i, (r, lf) in enumerate(per[s]):
            path = proof(sub[s], i) + proof(top, si)
            cur = H("".join(map(enc, (*r[:4], tamper(r))))) if tamper else lf
            for left, right in path:
                cur = H(left + cur + right)
            out.append((r[0], lf, sub[s][-1][0], root, H("".join(a + b for a, b in path)), cur, cur == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


DDL = "doc_id long, source string, lang string, n_chars long, text string"


ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(r):
    return r[4].translate(ASCII) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]


def test_small_sources_nulls_and_repeats(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(40)]
    rows += [(None, None, None, None, None), (5, "s2", "en", 5, "Text 5"), (5, "s2", "en", 5, "Text 5"), (7, "é", "fr", 1, "")]
    rows += [(35, "s0", "en", 9, "ÉCOLE École")]  # only A-Z are lowered
    df = spark.createDataFrame(rows, DDL)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    check = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(F.col("text"))
    assert got(merkle.manifest(df, check)) == plain(rows, lower)


@pytest.mark.parametrize("n", [1, 16, 17, 4096, 4097, 9000])
def test_block_edges(spark, n):
    rows = [(i, "hot" if i % 7 else "b", None, None, "X" * (i % 5)) for i in range(n)]
    df = spark.createDataFrame(rows, DDL)
    assert got(merkle.manifest(df)) == plain(rows, None)


def test_empty_long_and_clashing(spark, clashing):
    empty = spark.createDataFrame([], DDL)
    assert merkle.manifest(empty).count() == 0
    rows = [(1, "a", None, None, "Ab" * 200_000), (2, "a", None, None, None)]
    df = clashing(spark.createDataFrame(rows, DDL)).withColumn("node", F.lit(3)).withColumn("levels", F.lit(1))
    assert got(merkle.manifest(df, F.lower("text"))) == plain(rows, lambda r: r[4] and r[4].lower())


def test_query_against_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs]
    assert got(op11_merkle(spark, sf)) == plain(rows, lower)
