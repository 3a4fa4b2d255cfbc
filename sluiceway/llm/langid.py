"""Language ID by Bayesian evidence fusion: text, declared markup language, address suffix, host.

The languages are those of labelled texts. Text gives likelihoods by a naive Bayes model over
hashed byte triples, fitted on at most ``sample_rows`` labelled texts (a documented bound, chosen by
a hash of the id). Texts are scored whole; as their triples overlap, a text counts as ``STRENGTH``
times the square root of its triples independent ones.

Text likelihoods and the smoothed share of languages (from the texts alone) give every row
whose text has a say (likelihoods that are not all equal) a first posterior; other rows add
nothing to the sums below, so pages without text do not outvote those with it. Grouped
aggregates of these, whose sums combine before the shuffle, give the share of languages in
all, for each address suffix, and for each host, each smoothed by the one before with
``SMOOTHING`` rows, and how often a language declares each language. The final posterior is
proportional to

    P(language | host, smoothed by suffix, by all) * P(declared | language) * P(text | language)

Rows are scored once and written without their texts; only hosts, suffixes and declared
languages are grouped and joined, so a host with a third of all rows costs its sums.

Defined results: a null or empty text has no say, nor has a missing declaration (its own value in
the declared table), suffix or host (values of their own, in the hierarchy like others); ties go
to the language first in code point order; languages are those of the labelled texts, as many
as there are; repeated rows count and are returned each; without
labelled texts the language is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .common import lower_ascii, slices, texts

SAMPLE_ROWS = 8_000
MOST_LANGUAGES = 256
CELLS = 1 << 15
STRENGTH = 1.0
SMOOTHING = 20.0
NONE = ""  # a missing declaration, suffix or host

#: Elements whose text is no prose of the page.
NO_PROSE = frozenset(("script", "style", "nav", "footer", "noscript", "template", "svg", "select"))
_TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>?")
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z]{2,3})""", re.I)
_META = re.compile(r"""http-equiv\s*=\s*["']?content-language\b.*?content\s*=\s*["']?([A-Za-z]{2,3})""", re.I)


def read_page(source: str) -> tuple[str, str]:
    """The declared language (empty: none) and the prose of an HTML page, in one pass over its tags."""
    declared, out, skip, comment = "", [], "", False
    head, *parts = source.split("<")
    out.append(head)
    for part in parts:
        if comment or part.startswith("!--"):
            end = part.find("-->")
            comment = end < 0
            if not comment:
                out.append(part[end + 3 :])
            continue
        tag = _TAG.match(part)
        if skip:
            if tag and tag[1] and tag[2].lower() == skip:
                skip = ""
                out.append(part[tag.end() :])
            continue
        if not tag:
            if not part.startswith("!"):
                out.append("<" + part)
            continue
        name = tag[2].lower()
        if not declared and not tag[1] and name in ("html", "body", "meta"):
            found = (_META if name == "meta" else _LANG).search(tag[3])
            declared = found[1].lower() if found else ""
        if not tag[1] and name in NO_PROSE and not tag[3].endswith("/"):
            skip = name
            continue
        out.append(" " + part[tag.end() :])
    return declared, html.unescape("".join(out))


def host_of(url: Column) -> Column:
    """Lower-case host of an address, without port and ``www.``; empty if it has none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def suffix_of(host: Column) -> Column:
    """The last label of a host that has several; else empty."""
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def cells_of(text: str) -> np.ndarray:
    """Hashed byte triples of a text, lower-cased and with a blank at either end."""
    raw = np.frombuffer(b" " + lower_ascii(text.lower()) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    mixed = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA6B) + raw[2:] * np.uint32(0xC2B2AE35)
    return mixed >> np.uint32(17)


@dataclass(frozen=True)
class Model:
    """Languages in code point order, and the log probability of each cell in each (cells by languages)."""

    languages: tuple[str, ...]
    log_p: np.ndarray

    def likelihoods(self, text: str) -> np.ndarray:
        """Log likelihood of a whole text in each language, tempered; zeros without text."""
        total, n = np.zeros(len(self.languages)), 0
        cells = cells_of(text) if text.strip() else ()
        for at in range(0, len(cells), 1 << 16):
            part = cells[at : at + (1 << 16)]
            total += self.log_p[part].sum(axis=0, dtype=np.float64)
            n += len(part)
        return total / n * STRENGTH * math.sqrt(n) if n else total


def fit(labelled: DataFrame, lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """The text model, from at most about ``sample_rows`` texts with a language."""
    rows = texts(labelled, id_col, text_col, F.lower(F.trim(F.col(lang_col))).alias("lang"))
    rows = rows.where("lang != '' AND doc_id IS NOT NULL AND text != ''")
    total = rows.count()
    if total > sample_rows:
        grid = 1 << 20
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < math.ceil(grid * sample_rows / total))
    sample = write_once(rows.select("lang", "text"), "langid-sample")
    found = sample.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    languages = tuple(sorted(r.lang for r in found))
    if not languages:
        return Model((), np.zeros((CELLS, 0), np.float32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros(CELLS, np.int64) for lang in languages}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang in sums:
                    sums[lang] += np.bincount(cells_of(text), minlength=CELLS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "cells"]
        )

    # The sample is bounded, so its counts come from a bounded number of tasks.
    parts = sample.coalesce(8).mapInArrow(count, "lang string, cells binary").collect()
    counts = np.zeros((len(languages), CELLS))
    for r in parts:
        counts[languages.index(r.lang)] += np.frombuffer(r.cells, np.int64)
    smooth = counts + 0.1
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max())
    return p / p.sum()


def scored(rows: DataFrame, model: Model, keys: tuple[str, ...]) -> DataFrame:
    """``rows`` (``keys``, ``host``, ``text``, ``markup``) with their likelihoods, without texts.

    Where ``markup`` is true the text is HTML and may declare a language.
    """
    names = [*keys, "host", "suffix", "declared", "likelihoods", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            declared, likely = [], []
            for text, markup in zip(batch.column("text").to_pylist(), batch.column("markup").to_pylist()):
                said, prose = read_page(text) if markup else (NONE, text)
                declared.append(said)
                likely.append(model.likelihoods(prose))
            lists = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in (*keys, "host", "suffix")]
                + [pa.array(declared, pa.string()), pa.array(likely, lists), pa.array([_softmax(v) for v in likely], lists)],
                names=names,
            )

    rows = rows.select(*keys, "host", suffix_of(F.col("host")).alias("suffix"), "text", "markup")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return write_once(
        rows.mapInArrow(run, f"{fields}, declared string, likelihoods array<double>, first array<double>"), "langid"
    )


def _shares(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """Summed first posteriors of each language by ``keys``: an array ``sums``."""
    sums = [F.sum(F.element_at("first", k + 1)).alias(f"s{k}") for k in range(n)]
    grouped = rows.groupBy(*keys).agg(*sums)
    return grouped.select(*keys, F.array(*[F.coalesce(f"s{k}", F.lit(0.0)) for k in range(n)]).alias("sums"))


def _smoothed(sums: Column, prior: Column, weight: float) -> Column:
    """(sums + weight * prior) / (total of sums + weight)."""
    total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.zip_with(sums, prior, lambda s, p: s + p * weight), lambda x: x / (total + weight))


def identify(rows: DataFrame, model: Model, keys: tuple[str, ...], smoothing: float = SMOOTHING) -> DataFrame:
    """``keys``, ``host``, ``declared``, ``lang`` and its ``probability`` of every row.

    ``rows`` has ``keys``, ``host`` (null: none), ``text`` (null: empty) and ``markup``.
    """
    n = len(model.languages)
    rows = rows.withColumns({"host": F.coalesce("host", F.lit(NONE)), "text": F.coalesce("text", F.lit(""))})
    if not n:
        empty = F.lit(None)
        return rows.select(*keys, "host", F.lit(NONE).alias("declared"), empty.cast("string").alias("lang"),
                           empty.cast("double").alias("probability"))
    seen = scored(rows, model, keys)
    # A text has a say when its likelihoods differ; the others vote nowhere.
    say = F.array_max("likelihoods") > F.array_min("likelihoods")
    nothing = F.array(*[F.lit(0.0)] * n)
    text_alone = _shares(seen.withColumn("first", F.when(say, F.col("first")).otherwise(nothing)), n).first().sums
    logs = F.zip_with("likelihoods", F.array(*[F.lit(math.log((s + 1) / (sum(text_alone) + n))) for s in text_alone]), lambda a, b: a + b)
    raw = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    first = F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda a, y: a + y))
    seen = seen.withColumn("first", F.when(say, first).otherwise(nothing))
    one = _shares(seen, n).first().sums
    shares = [(s + 1) / (sum(one) + n) for s in one]
    everywhere = F.array(*map(F.lit, shares))
    suffixes = _shares(seen, n, "suffix").select("suffix", _smoothed(F.col("sums"), everywhere, smoothing).alias("above"))
    hosts = _shares(seen, n, "host", "suffix").join(suffixes, "suffix")
    hosts = hosts.select("host", _smoothed(F.col("sums"), F.col("above"), smoothing).alias("prior"))

    # P(declared | language): smoothed by how often a language is declared at all.
    by_declared = _shares(seen, n, "declared")
    said = F.aggregate("sums", F.lit(0.0), lambda a, x: a + x)
    every = sum(one) or 1.0
    usual = (said + 1) / F.lit(every + 1)
    declared = by_declared.select(
        "declared",
        F.zip_with("sums", F.array(*[F.lit(float(s)) for s in one]), lambda s, t: (s + usual * smoothing) / (t + smoothing)).alias("spoken"),
    )
    joined = seen.join(hosts, "host").join(declared, "declared")
    logs = F.zip_with(
        F.zip_with("likelihoods", "prior", lambda a, p: a + F.log(p)),
        F.when(F.col("declared") == NONE, F.array(*[F.lit(1.0)] * n)).otherwise(F.col("spoken")),
        lambda a, s: a + F.log(s),
    )
    top = F.array_max("logs")
    return (
        joined.withColumn("logs", logs)
        .withColumn("place", F.array_position("logs", top))
        .select(
            *keys, "host", "declared",
            F.element_at(F.array(*map(F.lit, model.languages)), F.col("place").cast("int")).alias("lang"),
            (1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("logs")))).alias("probability"),
        )
    )


def pages(table: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Web pages as rows for ``identify``."""
    return table.select(
        F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"),
        F.col(html_col).alias("text"), F.lit(True).alias("markup"),
    )


def plain_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Texts without markup as rows for ``identify``; where they come from stands for the host."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        F.col(text_col).alias("text"), F.lit(False).alias("markup"),
    )
