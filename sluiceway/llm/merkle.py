"""A Merkle manifest of a table: leaf digests, a subroot per source, one root, and proofs.

Every row is a leaf: the SHA-256 (lowercase hex) of its fields, each written ``-`` if null,
else as its UTF-8 byte count, ``:``, and its value. Per source, leaves ascend by ``doc_id``
(nulls first, ties by leaf); while more than one node remains, every run of 16 consecutive
nodes (the last run may be shorter, even one) becomes the digest of their hex digests
concatenated. What remains of a source is its subroot; subroots ordered by source (null
first, UTF-8 bytewise) make the root the same way.

Method: concatenated-level strings. Nodes are cut into aligned blocks of 16^3, one row each,
that keep a level as one hex string (held as its ASCII bytes, so that a substring is found by
its offset rather than by walking the characters before it). A parent is the digest of a fixed-width substring (16
digests), so a block climbs three levels with SQL functions alone; its root is a node of the
next round, and rounds recur until a source has one node. The proof of a node is read from
the same strings: at each level, the substrings left and right of it inside its run (its
siblings). Proofs are assembled top-down: a block joins the path of its own root (one row per
block), so no row of a leaf is ever joined with a level.

Places inside a source come from global prefix sums (``prefix.running``), so a source with a
third of all rows spans many tasks, and so do its blocks. No step collects more than one
block (4,096 digests) into a row.

Defined results: nulls in any field are written ``-`` (a null source is one source, ordered
first); repeated rows are repeated leaves, each in its place; empty texts are ``0:``; very
long texts are hashed whole; an empty table gives no rows; other columns of ``docs`` are not
carried. ``proof_sha256`` is the digest of all siblings level by level, left to right (the
digest of nothing for a lone leaf of a lone source). With ``check_text``, ``folded_root``
climbs from the leaf of the row with that text through the original siblings, and
``verified`` says whether it meets the root.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .prefix import running

FAN = 16
DEPTH = 3
BLOCK = FAN**DEPTH
HEX = 64
PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def _levels_for(m: Column) -> Column:
    """Levels until ``m`` nodes become one."""
    found = F.lit(DEPTH)
    for k in reversed(range(DEPTH)):
        found = F.when(m <= FAN**k, F.lit(k)).otherwise(found)
    return found


def _upto(n: Column, first: int = 1) -> Column:
    """first, ..., n; empty below first."""
    return F.when(n >= first, F.sequence(F.lit(first), n)).otherwise(F.array().cast("array<int>"))


def _parent(level: Column) -> Column:
    """The level above, as ASCII bytes: substrings of bytes are found by offset, not by a walk."""
    runs = ((F.length(level) - 1) / (FAN * HEX)).cast("int")
    return F.array_join(
        F.transform(F.sequence(F.lit(0), runs), lambda j: F.sha2(level.substr(j * (FAN * HEX) + 1, F.lit(FAN * HEX)), 256)),
        "",
    ).cast("binary")


def _blocks(nodes: DataFrame, keys: list[str], payload: list[str], run: str) -> DataFrame:
    """One row per aligned block of ``nodes`` (keys, pos, node, n = nodes of its keys, payload):
    its items in order, its levels as strings, and its root."""
    grouped = nodes.groupBy(*keys, F.floor(F.col("pos") / BLOCK).alias("mblock")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("items"), F.max("n").alias("n")
    )
    nlev = F.when(F.col("n") > BLOCK, F.lit(DEPTH)).otherwise(_levels_for(F.size("items")))
    first = F.array(F.array_join(F.transform("items", lambda it: it["node"]), "").cast("binary"))
    climbed = F.aggregate(_upto(F.col("nlev")), first, lambda acc, _: F.concat(acc, F.array(_parent(F.element_at(acc, -1)))))
    blocks = grouped.withColumn("nlev", nlev).withColumn("levels", climbed)
    return write_once(blocks.withColumn("top", F.element_at("levels", -1).cast("string")), "merkle-blocks", run)


def _climb(nodes: DataFrame, keys: list[str], payload: list[str], run: str) -> list[DataFrame]:
    """Blocks of every round, from ``nodes`` up to one node per keys."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [_blocks(nodes, keys, payload, run)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        above = rounds[-1].select(*keys, F.col("mblock").alias("pos"), F.col("top").alias("node"), F.ceil(F.col("n") / BLOCK).alias("n"))
        rounds.append(_blocks(above, keys, [], run))
    return rounds


def _flanks(index: Column) -> Column:
    """Siblings of the node at ``index`` of a block, level by level: the rest of its run."""

    def at(level: Column) -> Column:
        idx = (index / F.pow(F.lit(FAN), level)).cast("int")
        start = (idx / FAN).cast("int") * FAN
        text = F.element_at("levels", level + 1)
        return F.struct(
            text.substr(start * HEX + 1, (idx - start) * HEX).alias("left"),
            text.substr((idx + 1) * HEX + 1, (start + FAN - 1 - idx) * HEX).alias("right"),
        )

    return F.transform(_upto(F.col("nlev") - 1, 0), at)


def _down(blocks: DataFrame, keys: list[str], up: DataFrame, carried: list[str], payload: list[str]) -> DataFrame:
    """Every node of ``blocks`` with its path to the top: its own siblings, then those of ``up``
    (keys, mblock, up_path and ``carried``, one row per block)."""
    hidden = up.select(*[F.col(k).alias(f"_u_{k}") for k in [*keys, "mblock"]], "up_path", *carried)
    on = [blocks[k].eqNullSafe(hidden[f"_u_{k}"]) for k in [*keys, "mblock"]]
    joined = blocks.join(hidden, reduce(and_, on))

    def node(it: Column) -> Column:
        path = F.concat(_flanks(it["pos"] - F.col("mblock") * BLOCK), F.col("up_path"))
        return F.struct(it["pos"].alias("pos"), it["node"].alias("node"), *[it[p].alias(p) for p in payload], path.alias("path"))

    return joined.select(*keys, *carried, F.inline(F.transform("items", node)))


def _paths(rounds: list[DataFrame], keys: list[str], up: DataFrame, carried: list[str], payload: list[str], run: str) -> DataFrame:
    """Nodes of the first round with their paths, from the top round down."""
    for depth in range(len(rounds) - 1, 0, -1):
        nodes = _down(rounds[depth], keys, up, carried, [])
        up = write_once(nodes.select(*keys, F.col("pos").alias("mblock"), F.col("path").alias("up_path"), *carried), "merkle-up", run)
    return _down(rounds[0], keys, up, carried, payload)


def manifest(docs: DataFrame, check_text: Column | None = None, run: str = "") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``
    (doc_id, source, lang, n_chars, text)."""
    spark = docs.sparkSession
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    checked = leaf(*fields[:4], check_text) if check_text is not None else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        leaf(*fields).alias("node"), checked.alias("check"),
    )
    placed = running(rows, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("node")], {"one": F.lit(1)}, run=run)
    leaves = placed.withColumnRenamed("one_all", "n")
    rounds = _climb(leaves, ["source"], ["doc_id", "check"], run)

    subroots = rounds[-1].select("source", F.col("top").alias("node"))
    ranked = running(subroots, [], [F.col("source").asc_nulls_first()], {"one": F.lit(1)}, run=run)
    tops = _climb(ranked.withColumnRenamed("one_all", "n"), [], ["source"], run)
    crown = tops[-1].select("mblock", F.array().cast(PATH).alias("up_path"), F.col("top").alias("root"))
    by_source = _paths(tops, [], crown, ["root"], ["source"], run)
    above = by_source.select("source", F.lit(0).cast("long").alias("mblock"), F.col("path").alias("up_path"),
                             F.col("node").alias("subroot"), "root")

    found = _paths(rounds, ["source"], above, ["subroot", "root"], ["doc_id", "check"], run)
    siblings = F.aggregate("path", F.lit(bytearray()), lambda acc, f: F.concat(acc, f["left"], f["right"]))
    proof = F.sha2(siblings, 256)
    start = F.coalesce(F.col("check"), F.col("node"))
    folded = F.aggregate("path", start, lambda cur, f: F.sha2(F.concat(f["left"], cur.cast("binary"), f["right"]), 256))
    result = found.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    )
    assert spark
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
