from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import catalogue, langid

PAGE = '<!DOCTYPE html><html lang="de-AT"><head><script>var t="</p><b>";</script></head><body><nav>x</nav>'


@pytest.mark.parametrize(
    "source, declared, words",
    [
        (PAGE + "<p>Guten&nbsp;Tag &amp; mehr</p><footer>f</footer>", "de", "Guten Tag & mehr"),
        ("<meta http-equiv='Content-Language' content='fr'><p>un<br>deux", "fr", "un deux"),
        ("plain text", "", "plain text"),
        ("a < b <!-- <p>no</p> --> c", "", "a < b c"),
        ("<html LANG=es>x<script>never closed", "es", "x"),
        ("", "", ""),
        ("<", "", "<"),
        ("<!-- open", "", ""),
    ],
)
def test_read_page(source, declared, words):
    said, prose = langid.read_page(source)
    assert (said, prose.split()) == (declared, words.split())


def test_many_open_tags_take_linear_time():
    for source in ("<script>" * 50_000, "<" * 200_000, "<!--" * 50_000, "<p " * 100_000):
        langid.read_page(source)


def test_hosts_and_suffixes(spark):
    urls = {
        "http://www.Foo.example.org:80/a": ("foo.example.org", "org"), "https://u:p@b.de?x": ("b.de", "de"),
        "https://localhost/": ("localhost", ""), "nonsense": ("", ""), "": ("", ""), None: ("", ""),
    }
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", langid.host_of(F.col("url")).alias("host"))
    got = {r.url: (r.host, r.suffix) for r in rows.withColumn("suffix", langid.suffix_of(rows["host"])).collect()}
    assert got == urls


WORDS = {"en": "the of and that with this", "de": "der und nicht mit ein für", "fr": "les des une dans pour être"}


def labelled(docs, spark, per=30):
    rng = np.random.default_rng(2)
    rows = []
    for lang, words in WORDS.items():
        for _ in range(per):
            rows.append((len(rows), " ".join(rng.choice(words.split(), 40)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def plain(rows, model, smoothing):
    """The same fusion, row by row, in plain Python; rows: (key, host, text, markup)."""
    n = len(model.languages)
    seen = []
    for key, host, text, markup in rows:
        host = host or ""
        said, prose = langid.read_page(text or "") if markup else ("", text or "")
        like = model.likelihoods(prose)
        suffix = host.rsplit(".", 1)[1] if "." in host and not host.endswith(".") else ""
        seen.append((key, host, suffix, said, like))

    def posterior(like, shares):
        """A text without a say (all likelihoods equal) votes nowhere."""
        if like.max() == like.min():
            return np.zeros(n)
        z = like + np.log(shares)
        p = np.exp(z - z.max())
        return p / p.sum()

    alone = sum((posterior(s[4], np.ones(n)) for s in seen), np.zeros(n))
    shares = (alone + 1) / (alone.sum() + n)
    seen = [(*s, posterior(s[4], shares)) for s in seen]
    total = sum((s[5] for s in seen), np.zeros(n))
    everywhere = (total + 1) / (total.sum() + n)

    def smooth(group, prior):
        s = sum((g[5] for g in group), np.zeros(n))
        return (s + smoothing * prior) / (s.sum() + smoothing)

    out = {}
    for key, host, suffix, said, like, _ in seen:
        above = smooth([g for g in seen if g[2] == suffix], everywhere)
        prior = smooth([g for g in seen if g[1] == host], above)
        z = like + np.log(prior)
        if said:
            s = sum((g[5] for g in seen if g[3] == said), np.zeros(n))
            usual = (s.sum() + 1) / (total.sum() + 1)
            z = z + np.log((s + usual * smoothing) / (total + smoothing))
        p = np.exp(z - z.max())
        out[key] = (model.languages[int(z.argmax())], p.max() / p.sum())
    return out


def test_fusion_against_plain_version(spark, docs):
    model = langid.fit(labelled(docs, spark))
    rng = np.random.default_rng(3)
    rows = []
    for k in range(120):
        lang = ("en", "de", "fr")[k % 3]
        text = " ".join(rng.choice(WORDS[lang].split(), rng.integers(0, 4)))
        host = None if k % 11 == 0 else f"h{k % 5}.{('org', 'de', 'fr')[k % 3 if k % 7 else 0]}" if k % 13 else "bare"
        rows.append((k, host, f'<html lang="{lang if k % 4 else "de"}">{text}' if k % 2 else text or None, bool(k % 2)))
    frame = spark.createDataFrame(rows, "page_id long, host string, text string, markup boolean").repartition(3)
    got = {r.page_id: (r.lang, r.probability) for r in langid.identify(frame, model, ("page_id",)).collect()}
    want = plain(rows, model, langid.SMOOTHING)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == pytest.approx(want[k][1], rel=1e-6)
        assert got[k][0] == want[k][0] or want[k][1] < 0.51


def test_evidence_decides_where_text_is_silent(spark, docs):
    model = langid.fit(labelled(docs, spark))
    sure = [(k, "h.de", WORDS["de"], False) for k in range(50)] + [(100 + k, "x.org", WORDS["en"], False) for k in range(50)]
    sure += [(300 + k, "m.org", f'<html lang="fr">{WORDS["fr"]}', True) for k in range(50)]
    silent = [(200, "h.de", None, False), (201, "new.de", "", False), (202, "new.net", '<html lang="fr">', True)]
    frame = spark.createDataFrame(sure + silent, "page_id long, host string, text string, markup boolean")
    got = {r.page_id: r.lang for r in langid.identify(frame, model, ("page_id",)).collect()}
    assert [got[k] for k in (200, 201, 202)] == ["de", "de", "fr"]


def test_pages_without_text_do_not_outvote_a_host(spark, docs):
    """60 French pages and one silent page on a host: 5,000 more pages without text change nothing."""
    model = langid.fit(labelled(docs, spark))
    french = [(k, "h.example", WORDS["fr"], False) for k in range(60)] + [(60, "h.example", None, False)]
    empty = [(1_000 + k, "h.example", None, False) for k in range(5_000)]
    for rows in (french, french + empty):
        frame = spark.createDataFrame(rows, "page_id long, host string, text string, markup boolean")
        got = {r.page_id: (r.lang, r.probability) for r in langid.identify(frame, model, ("page_id",)).collect()}
        assert got[60][0] == "fr" and got[60][1] > 0.9


def test_odd_rows(spark, docs, clashing):
    model = langid.fit(labelled(docs, spark))
    rows = [(1, None, None), (1, None, None), (None, "http://a.de/", "<p>und der"), (2, "x", "der " * 50_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for t in (table, clashing(table)):
        got = langid.identify(langid.pages(t), model, ("page_id",)).collect()
        assert len(got) == 4 and all(r.lang in WORDS and 0 < r.probability <= 1 for r in got)
    assert langid.identify(langid.pages(table.limit(0)), model, ("page_id",)).count() == 0
    none = langid.fit(labelled(docs, spark).where("lang = 'xx'"))
    assert {r.lang for r in langid.identify(langid.pages(table), none, ("page_id",)).collect()} == {None}


def test_sample_is_bounded(spark, docs):
    rows = labelled(docs, spark, per=400)
    small = langid.fit(rows, sample_rows=100)
    assert small.languages == ("de", "en", "fr") and np.isfinite(small.log_p).all()
    assert math.isclose(float(np.exp(small.log_p.astype(float)).sum(axis=0)[0]), 1, rel_tol=1e-3)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = catalogue.op6_language(spark, folder).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    docs = [r for r in got if r.doc_id is not None]
    pages = [r for r in got if r.page_id is not None]
    assert len(docs) == len(lang) and len(pages) == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert sum(r.lang == lang[r.doc_id] for r in docs) >= 0.99 * len(docs)
    assert sum(r.lang == r.declared for r in pages) >= 0.97 * len(pages)
