"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are normalised and put into shards, the cells of two codebooks: each into its ``OVERLAP``
nearest. A shard with more than ``NODES`` vectors is split, so a graph's size is bounded. In
each graph a vector takes the neighbours that robust pruning leaves of its nearest ones and
some random ones: a candidate goes if one kept before is nearer to it by the factor ``ALPHA``
than the vector itself (Subramanya et al., "DiskANN", 2019). A vector's adjacency lists from all
its shards are united. Then each vector searches the graphs of its shards: greedily from the
medoid with a beam, and from what lies within the range (with some slack) onwards, until
nothing new in range appears. What is found is verified by cosines in double precision.

A pair counts in the first shard both are in. Graphs give each vector's number of links
and one edge to the least vector of its group there, never the pairs, so a group of copies
writes as many rows as it has members. Equal vectors are one node with a weight.

The recall is audited: ``AUDIT`` vectors, and up to ``MOST_AUDITED`` until ``ENOUGH`` of each order
of link counts are seen, are compared with all rows. The recall is the mean over vectors, that of the
worst order of link counts, so a large group does not hide small ones. While it is below ``RECALL``
the whole is done again with twice the overlap. Without a true link seen it is not audited.

Within a group of m near copies that are not equal, all m * m cosines are measured, in bounded
memory, since a link's cosine is what is asked for; see the README.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .components import connected_components
from .vectors import Cells, chunks, least_hashed, matrix, sample_of, usable, with_class

SHARD = 1024  # vectors of a shard before overlap, on average
NODES = 6144  # vectors of a graph, about
QUERIES = 6144  # queries of a chunk, about
OVERLAP = 4
POOL, RANDOM, DEGREE, ALPHA = 40, 8, 20, 1.2
BEAM, SLACK = 4, 0.06
AUDIT, MOST_AUDITED, ENOUGH, RECALL = 1024, 1 << 14, 64, 0.99


def unit(x: np.ndarray) -> np.ndarray:
    """Normalised rows; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; the same for a pair wherever it is computed."""
    return (a * b).sum(axis=1)


def robust_prune(x: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a graph over unit vectors: pruned neighbours and their reverse."""
    n = len(x)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rng, near = np.random.default_rng(seed), min(POOL, n - 1)
    src, dst = [], []
    light = x.astype(np.float32)
    for tile in chunks(n, 256):
        rows = np.arange(tile.start, tile.stop)
        sims = light[tile] @ light.T
        sims[np.arange(len(rows)), rows] = -np.inf
        pool = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        pool = np.column_stack([pool, rng.integers(0, n, (len(rows), RANDOM))])
        far = 1 - np.take_along_axis(sims, pool, axis=1)  # half the squared distance
        order = np.argsort(far, axis=1, kind="stable")
        pool, far = np.take_along_axis(pool, order, axis=1), np.take_along_axis(far, order, axis=1)
        between = 1 - np.einsum("bid,bjd->bij", light[pool], light[pool], optimize=True)
        alive = np.isfinite(far)
        each = np.arange(len(rows))
        for _ in range(DEGREE):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            src.append(rows[some])
            dst.append(pool[each, pick][some])
            # Squared distances, so the factor is squared; the picked one itself has distance 0.
            alive &= ALPHA**2 * between[each, pick] > far
            alive[each, pick] = False
    src, dst = np.concatenate(src), np.concatenate(dst)
    both = np.unique(np.concatenate([src * n + dst, dst * n + src]))
    return both // n, both % n


def _beam(best: np.ndarray, by: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Each query's ``BEAM`` largest cosines of those in ``best`` and the new ones."""
    order = np.lexsort((-near, by))
    by, near = by[order], near[order]
    place = np.arange(len(by)) - np.searchsorted(by, by)
    top = place < BEAM
    more = np.full(best.shape, -2, np.float32)
    more[by[top], place[top]] = near[top]
    return -np.sort(-np.concatenate([best, more], axis=1), axis=1)[:, :BEAM]


def range_search(x: np.ndarray, starts: np.ndarray, edges: np.ndarray, q: np.ndarray, least: float) -> np.ndarray:
    """Which nodes each query finds within cosine ``least``: a boolean array, queries by nodes.

    ``edges[starts[i]:starts[i + 1]]`` are the neighbours of node i.
    """
    n = len(x)
    light, asked = x.astype(np.float32), q.astype(np.float32)
    centre = light.mean(axis=0)
    entry = int((light @ centre).argmax())  # the medoid
    found = np.zeros((len(q), n), dtype=bool)
    degree = np.diff(starts)
    for tile in chunks(len(q), 128):
        rows = tile.stop - tile.start
        sims = np.full((rows, n), -2, np.float32)
        sims[:, entry] = asked[tile] @ light[entry]
        best = np.full((rows, BEAM), -2, np.float32)
        best[:, 0] = sims[:, entry]
        marks = np.zeros((rows, n), np.int32)
        qi, ni = np.arange(rows), np.full(rows, entry)
        while len(qi):
            met = []
            for some in chunks(len(qi), 1 << 14):
                many = degree[ni[some]]
                first = np.repeat(starts[ni[some]] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
                to, by = edges[first + np.arange(many.sum())], np.repeat(qi[some], many)
                new = sims[by, to] == -2
                by, to = by[new], to[new]
                # One of the pairs that are the same stays.
                marks[by, to] = np.arange(len(by))
                one = marks[by, to] == np.arange(len(by))
                by, to = by[one], to[one]
                sims[by, to] = np.einsum("ij,ij->i", asked[tile][by], light[to])
                met.append((by, to))
            by, to = (np.concatenate(part) for part in zip(*met))
            near = sims[by, to]
            best = _beam(best, by, near)
            # On from each query's best so far, and from all that is in range. The floor only
            # rises, so what lies below it when it is met is never needed.
            floor = np.minimum(np.maximum(best.min(axis=1), -1.5), np.float32(least - SLACK))
            on = near >= floor[by]
            qi, ni = by[on], to[on]
        qi, ni = np.nonzero(sims >= least - 1e-4)
        for some in chunks(len(qi), 1 << 16):
            a, b = qi[some], ni[some]
            found[tile.start + a, b] = cosines(q[tile.start + a], x[b]) >= least
    return found


def _groups(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, least id of its group) of the linked ids, where left[i] and right[j] are linked if found[i, j]."""
    waiting = found.any(axis=1)
    ids, roots = [], []
    while waiting.any():
        rows = np.zeros(len(left), dtype=bool)
        rows[waiting.argmax()] = True
        while True:
            columns = found[rows].any(axis=0)
            wider = rows | found[:, columns].any(axis=1)
            if wider.sum() == rows.sum():
                break
            rows = wider
        waiting &= ~rows
        group = np.union1d(left[rows], right[columns])
        ids.append(group)
        roots.append(np.full(len(group), group[0]))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(roots)


def _membership(nodes: DataFrame, cells: Cells, overlap: int) -> DataFrame:
    """``nodes`` with the array ``shards`` of the nearest cells, in order of number."""
    kind = nodes.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = np.sort(cells.nearest(unit(matrix(batch.column("vector"))), overlap), axis=1)
            shards = pa.array(list(lists.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rep", "weight", "vector")), shards],
                names=["rep", "weight", "vector", "shards"],
            )

    return nodes.select("rep", "weight", "vector").mapInArrow(
        run, f"rep long, weight long, vector {kind}, shards array<int>"
    )


def _split(members: DataFrame) -> DataFrame:
    """A row for each vector and shard: ``shard`` and ``part``, its part of a split shard, and the ``parts``."""
    each = members.select("rep", "weight", "vector", "shards", F.explode("shards").alias("shard"))
    # What is broadcast has a row for each shard: at most a million.
    sizes = members.select(F.explode("shards").alias("shard")).groupBy("shard").agg(
        F.ceil(F.count("*") / NODES).cast("int").alias("parts"),
        F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"),
    )
    return each.join(F.broadcast(sizes), "shard").withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    )


def adjacency(each: DataFrame) -> DataFrame:
    """``rep``, ``near``: the united adjacency lists of every vector."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        ids = group["rep"].to_numpy()
        src, dst = robust_prune(unit(matrix(group["vector"])))
        bounds = np.searchsorted(src, np.arange(len(ids) + 1)).astype(np.int32)
        return pa.table({"rep": pa.array(ids), "near": pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids[dst]))})

    lists = each.groupBy("shard", "part").applyInArrow(build, "rep long, near array<long>")
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _search(each: DataFrame, near: DataFrame, least: float) -> DataFrame:
    """``rep``, ``links`` (weighted), ``root``: what each vector finds in each graph of its shards."""
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk")
    columns = ["rep", "weight", "vector", "shards"]
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    graphs = each.join(near, "rep").select("shard", "part", every("chunks", "chunk"), "near", *columns)
    asked = each.select("shard", every("parts", "part"), chunk, *columns)
    asked = asked.toDF(*asked.columns)  # both sides come from one table

    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        if not graph.num_rows or not queries.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        graph, queries = graph.sort_by("rep"), queries.sort_by("rep")
        ids, names = graph["rep"].to_numpy(), queries["rep"].to_numpy()
        x, q = unit(matrix(graph["vector"])), unit(matrix(queries["vector"]))
        lists = graph["near"].combine_chunks()
        to = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
        here = ids[at] == to  # neighbours from other shards are not in this graph
        owner, to = owner[here], at[here]
        order = np.lexsort((to, owner))
        starts = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        found = range_search(x, starts, to[order], q, least)
        if np.array_equal(ids, names):
            found |= found.T
        found &= names[:, None] != ids[None, :]
        # A pair counts in the first shard that has both.
        shard = graph["shard"][0].as_py()
        own, theirs = np.array(queries["shards"].to_pylist()), np.array(graph["shards"].to_pylist())
        earlier = np.zeros(found.shape, dtype=bool)
        for k in range(own.shape[1]):
            for j in range(theirs.shape[1]):
                low = own[:, k][:, None] == np.where(theirs[:, j] < shard, theirs[:, j], -1)[None, :]
                earlier |= low
        root_of = dict(zip(*map(np.ndarray.tolist, _groups(found, names, ids)))) if found.any() else {}
        weight = graph["weight"].to_numpy()
        links = np.concatenate([(found[t] & ~earlier[t]) @ weight for t in chunks(len(names), 256)])
        known = dict(zip(names.tolist(), links.tolist()))
        linked = sorted(root_of.keys() | {r for r, n in known.items() if n})
        return pa.table(
            {
                "rep": pa.array(linked, pa.int64()),
                "links": pa.array([known.get(r, 0) for r in linked], pa.int64()),
                "root": pa.array([root_of.get(r, r) for r in linked], pa.int64()),
            }
        )

    keys = ("shard", "part", "chunk")
    return graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "rep long, links long, root long")


def stratified_recall(true: np.ndarray, links: np.ndarray) -> float | None:
    """The least mean recall of vectors with about as many true links; None without any.

    Orders of link counts with less than ``ENOUGH`` vectors go with the next ones.
    """
    linked = true > 0
    true, links = true[linked], links[linked]
    if not len(true):
        return None
    order = np.argsort(true, kind="stable")
    recall, level = np.minimum(links / true, 1)[order], np.log2(true[order]).astype(int)
    cuts = [0]
    for end in np.flatnonzero(np.diff(level)) + 1:
        if end - cuts[-1] >= ENOUGH and len(true) - end >= ENOUGH:
            cuts.append(int(end))
    return min(float(recall[i:j].mean()) for i, j in zip(cuts, [*cuts[1:], len(true)]))


def _true_links(nodes: DataFrame, few: pa.Table, least: float) -> DataFrame:
    """``rep``, ``true``: the links of a few vectors among all."""
    ids, q = few["rep"].to_numpy(), unit(matrix(few["vector"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true, light = np.zeros(len(ids), np.int64), q.astype(np.float32)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, x = batch.column("rep").to_numpy(), unit(matrix(batch.column("vector")))
            weight, thin = batch.column("weight").to_numpy(), x.astype(np.float32)
            for some in chunks(len(ids), 256):
                i, j = np.nonzero(light[some] @ thin.T >= least - 1e-4)
                for part in chunks(len(i), 1 << 16):
                    a, b = some.start + i[part], j[part]
                    sure = (ids[a] != own[b]) & (cosines(q[a], x[b]) >= least)
                    np.add.at(true, a[sure], weight[b[sure]])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true)], names=["rep", "true"])

    true = nodes.select("rep", "weight", "vector").mapInArrow(run, "rep long, true long")
    return true.groupBy("rep").agg(F.sum("true").alias("true"))


def _audited(nodes: DataFrame, total: int, found: DataFrame, least: float, many: int = AUDIT) -> float | None:
    """The recall of vectors drawn until enough of them have links; None if none has and not all were drawn."""
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    while True:
        true = _true_links(nodes, least_hashed(nodes, many, total), least)
        seen = true.where(F.col("true") > 0).join(links, "rep", "left").select("true", F.coalesce("links", F.lit(0)).alias("links"))
        seen = seen.toArrow()
        true, got = seen["true"].to_numpy(), seen["links"].to_numpy()
        orders = np.bincount(np.log2(true).astype(int)) if len(true) else np.zeros(1, int)
        scarce = not len(true) or orders[orders > 0].min() < ENOUGH
        if not scarce or many >= min(total, MOST_AUDITED):
            break
        many = min(many * 4, MOST_AUDITED)
    recall = stratified_recall(true, got)
    return 1.0 if recall is None and many >= total else recall


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD, overlap: int = OVERLAP, audit: dict | None = None,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Links join rows whose cosine is at least ``threshold``. Rows that are null, empty, zero, of
    another than the usual length, or hold null or non-finite components have no links and are
    their own component; repeated rows are other rows with equal vectors; a row without an id has
    links but is never the least of a component; an empty table gives no rows; other columns
    are ignored. ``audit``, if given, receives the audited ``recall`` (None: not audited, as no true link was seen) and the ``overlap`` used.
    """
    rows = usable(vectors, id_col, vector_col)
    fit = write_once(with_class(rows).select("vec_id", "class", "vector", "usable"), "vectors")
    nodes = write_once(
        fit.where("usable").groupBy("class").agg(
            F.xxhash64(F.col("class.a"), F.col("class.b")).alias("key"), F.min("vec_id").alias("least"),
            F.count("*").alias("weight"), F.first("vector").alias("vector"),
        ).select("class", F.coalesce("least", "key").alias("rep"), "least", "weight", "vector"),
        "flatgraph-nodes",
    )
    total = nodes.count()
    alone = fit.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), "usable")
    if total:
        cells = Cells(unit(sample_of(nodes, total)), total / shard_rows)
        while True:
            each = write_once(_split(_membership(nodes, cells, overlap)), "flatgraph-shards")
            near = write_once(adjacency(each), "flatgraph-adjacency")
            found = write_once(_search(each, near, threshold), "flatgraph-links")
            recall = _audited(nodes, total, found, threshold)
            if audit is not None:
                audit |= {"recall": recall, "overlap": min(overlap, len(cells))}
            if recall is None or recall >= RECALL or overlap >= len(cells):
                break
            overlap *= 2
        links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        joined = connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
        placed = (
            nodes.join(links, "rep", "left")
            .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
            .select("class", "weight", "least", F.coalesce("links", F.lit(0)).alias("links"),
                    F.coalesce("root", "rep").alias("root"))
        )
        ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        by_class = placed.join(ids, "root").select(
            "class", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id"
        )
        linked = fit.where("usable").join(by_class, "class").select("vec_id", "n_links", "component_id", "usable")
        result = linked.unionByName(alone.where("NOT usable"))
    else:
        result = alone
    return result.select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
