"""Approximate nearest neighbours by inner product, with an adaptive scan of dimensions.

With M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) turn the largest inner
product into the least distance, whatever the norms. A random rotation spreads the distance
evenly over the dimensions. Vectors are put into lists, the cells of two codebooks, and each list
into blocks of about ``BLOCK`` rows, stored as columns of ``COLUMNS`` dimensions each.

A query probes its nearest lists. From the partial distance over the first d of D dimensions the
scan tests whether the whole distance can still be below the query's k-th best so far: if
partial * D / d exceeds that by the factor (1 + EPSILON / sqrt(d))^2, the candidate is abandoned
(Gao and Long, "High-Dimensional Approximate Nearest Neighbor Search", 2023). The nearest list is
searched first, so that the other lists start with a k-th best. Survivors are measured
exactly, on the original vectors in double precision.

How many lists to probe is measured, not set: ``CALIBRATE`` queries are answered exactly
against all rows, and enough lists are probed to hold ``RECALL`` of those answers.

Equal vectors are searched once: only the k + 1 least ids of a class of equal vectors can be in
an answer, so a vector that a third of all rows share costs one candidate. Lists that many
queries probe, or that hold many vectors, are split into blocks and query chunks, so a task's
memory is bounded.

Defined results: see ``search``. The index is fitted on at most ``vectors.SAMPLE`` rows; every row
is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once
from .vectors import Cells, chunks, least_hashed, matrix, sample_of, usable, with_class

LIST = 4096  # rows of a list, on average
BLOCK = 2048  # rows of a block, about
QUERIES = 1024  # queries of a chunk, about
COLUMNS = 16
EPSILON = 1.5
CALIBRATE = 64
RECALL = 0.98


class Space:
    """The augmented, rotated space of an index."""

    def __init__(self, dimensions: int, longest: float, seed: int = 3):
        self.longest = longest
        noise = np.random.default_rng(seed).standard_normal((dimensions + 1, dimensions + 1))
        self.rotation = np.linalg.qr(noise)[0]

    def points(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        return np.column_stack([x, more]) @ self.rotation

    def queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision; a pair's does not depend on the pairs beside it."""
    return (q * x).sum(axis=1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= floor)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))[:k]]


def scan(
    q: np.ndarray, rotated_q: np.ndarray, floors: np.ndarray, longest: float,
    x: np.ndarray, columns: list[np.ndarray], ids: np.ndarray, k: int, epsilon: float = EPSILON,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's best k of a block at or above its floor: query, ids, scores.

    ``columns`` are the block's rotated dimensions, one array for each run of them.
    """
    width = sum(c.shape[0] for c in columns)
    for tile in chunks(len(q), 128):
        known, floor, norms = q[tile], floors[tile].copy(), (rotated_q[tile] ** 2).sum(axis=1)
        lead = 0
        if np.isneginf(floor).any():
            # Without a k-th best so far, the first rows of the block give one.
            lead = min(len(x), max(4 * k, 128))
            first = np.array([exact(np.broadcast_to(v, (lead, len(v))), x[:lead]) for v in known])
            if lead >= k:
                floor = np.maximum(floor, np.partition(first, lead - k, axis=1)[:, lead - k])
        # Distances of this kind and inner products of that floor are the same test.
        limit = norms + longest**2 - 2 * floor
        done, at, partial, qi, xi = 0, 0, None, None, None
        for column in columns:
            part, upto = rotated_q[tile, at : at + len(column)], done + len(column)
            if partial is None:
                near = (part**2).sum(axis=1)[:, None] + (column**2).sum(axis=0)[None, :] - 2 * part @ column
            else:
                near = partial + ((part[qi] - column[:, xi].T) ** 2).sum(axis=1)
            allowed = limit * upto / width * (1 + epsilon / np.sqrt(upto)) ** 2 * (1 + 1e-9) + 1e-9 * longest**2
            if upto == width:
                allowed = limit * (1 + 1e-6) + 1e-6 * longest**2
            if partial is None:
                qi, xi = np.nonzero(near <= allowed[:, None])
                partial = near[qi, xi]
            else:
                stays = near <= allowed[qi]
                qi, xi, partial = qi[stays], xi[stays], near[stays]
            done, at = upto, at + len(column)
        for some in chunks(len(qi), 1 << 17):
            partial[some] = exact(known[qi[some]], x[xi[some]])
        stays = partial >= floor[qi]
        qi, xi, scores = qi[stays], xi[stays], partial[stays]
        bounds = np.searchsorted(qi, np.arange(len(known) + 1))
        for j in range(len(known)):
            own = slice(bounds[j], bounds[j + 1])
            if bounds[j] < bounds[j + 1]:
                top = best(scores[own], ids[xi[own]], k)
                yield tile.start + j, ids[xi[own]][top], scores[own][top]


_BLOCK_SCHEMA = "list int, block int, ids array<long>, vectors array<{}>, columns array<array<float>>"


def _number(classes: DataFrame) -> tuple[str, pa.DataType]:
    """The components' type: float stays float, all else is double."""
    own = classes.schema["vector"].dataType.elementType.simpleString()
    return ("float", pa.float32()) if own == "float" else ("double", pa.float64())


def _blocks(classes: DataFrame, space: Space, cells: Cells) -> DataFrame:
    """The index: a row for each block of each list."""
    kind, arrow = _number(classes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            own = cells.nearest(space.points(x), 1)[:, 0] if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array(own.astype(np.int32)), batch.column("vector")],
                names=["rep", "list", "vector"],
            )

    placed = write_once(
        classes.select("rep", F.col("vector").cast(f"array<{kind}>")).mapInArrow(
            assign, f"rep long, list int, vector array<{kind}>"
        ),
        "ann-lists",
    )
    sizes = placed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))

    def form(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        x = matrix(group["vector"])
        turned = space.points(x).astype(np.float32)
        columns = [turned[:, c].T.reshape(-1) for c in chunks(turned.shape[1], COLUMNS)]
        return pa.table(
            {
                "list": pa.array([group["list"][0].as_py()], pa.int32()),
                "block": pa.array([group["block"][0].as_py()], pa.int32()),
                "ids": pa.array([group["rep"].to_pylist()], pa.list_(pa.int64())),
                "vectors": pa.array([x.reshape(-1)], pa.list_(arrow)),
                "columns": pa.array([columns], pa.list_(pa.list_(pa.float32()))),
            }
        )

    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")
    # What is broadcast has a row for each list: at most a million.
    spread = placed.join(F.broadcast(sizes), "list").select("list", block, "rep", "vector")
    return write_once(spread.groupBy("list", "block").applyInArrow(form, _BLOCK_SCHEMA.format(kind)), "ann-index")


def _opened(rows, at: int) -> tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]:
    """List, ids, vectors and columns of one of the blocks in a batch or table."""
    ids = rows["ids"][at].values.to_numpy()
    x = rows["vectors"][at].values.to_numpy().astype(np.float64).reshape(len(ids), -1)
    columns = [c.values.to_numpy().astype(np.float64).reshape(-1, len(ids)) for c in rows["columns"][at]]
    return rows["list"][at].as_py(), ids, x, columns


_FOUND = "query long, rep long, score double, list int"
_FOUND_NAMES = ["query", "rep", "score", "list"]


def _rows(found: list[tuple]) -> pa.RecordBatch:
    """(query id, ids, scores, list) as rows."""
    if not found:
        return pa.RecordBatch.from_arrays(
            [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], pa.int32())],
            names=_FOUND_NAMES,
        )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
            pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
            pa.array(np.concatenate([f[2] for f in found]), pa.float64()),
            pa.array(np.repeat([f[3] for f in found], [len(f[1]) for f in found]), pa.int32()),
        ],
        names=_FOUND_NAMES,
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def brute_force(index: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """The k best of all rows for a few queries, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                number, own, x, _ = _opened(batch, at)
                found = []
                for j, v in enumerate(q):
                    scores = exact(np.broadcast_to(v, x.shape), x)
                    top = best(scores, own, k)
                    found.append((ids[j], own[top], scores[top], number))
                yield _rows(found)

    return _top(index.mapInArrow(run, _FOUND), k)


def _filled(index: DataFrame, cells: Cells) -> np.ndarray:
    """The number of rows of each list: at most a million numbers."""
    filled = np.zeros(len(cells), np.int64)
    for r in index.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).collect():
        filled[r.list] = r.n
    return filled


def _probes(queries: DataFrame, space: Space, cells: Cells, filled: np.ndarray, n: int, k: int) -> DataFrame:
    """``queries`` with the lists to probe: ``list`` and ``nth``, nearest first.

    The nearest ``n`` lists that hold rows, and more where these hold fewer than ``k``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("vector"))
            if not len(q):
                continue
            lists = cells.nearest_filled(space.queries(q), n, filled, k)
            rows = np.repeat(np.arange(len(q)), [len(own) for own in lists])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep").take(pa.array(rows)),
                    batch.column("vector").take(pa.array(rows)),
                    pa.array(np.concatenate(lists).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(len(own), dtype=np.int32) for own in lists])),
                ],
                names=["query", "vector", "list", "nth"],
            )

    kind, _ = _number(queries)
    return queries.select("rep", F.col("vector").cast(f"array<{kind}>")).mapInArrow(
        run, f"query long, vector array<{kind}>, list int, nth int"
    )


def _searched(probes: DataFrame, index: DataFrame, space: Space, k: int) -> DataFrame:
    """``probes`` (with ``floor``) against the blocks of their lists."""
    per_list = probes.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    blocks = index.groupBy("list").agg(F.count("*").cast("int").alias("blocks"))
    # A row for each list: at most a million.
    sizes = F.broadcast(per_list.join(blocks, "list"))
    chunk = F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int").alias("chunk")
    upto = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = probes.join(sizes, "list").select("list", upto, chunk, "query", "vector", "floor")
    parts = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    held = index.join(sizes, "list").select("list", "block", parts, "ids", "vectors", "columns")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows:
            names = left["query"].to_numpy()
            q = matrix(left["vector"])
            turned, floors = space.queries(q), left["floor"].to_numpy().astype(np.float64)
            for at in range(right.num_rows):
                number, ids, x, columns = _opened(right, at)
                for j, best_ids, scores in scan(q, turned, floors, space.longest, x, columns, ids, k):
                    found.append((names[j], best_ids, scores, number))
        return pa.Table.from_batches([_rows(found)])

    keys = ("list", "block", "chunk")
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, _FOUND)


def probes_needed(index: DataFrame, queries: DataFrame, asking: int, space: Space, cells: Cells, filled: np.ndarray, k: int,
                  recall: float = RECALL, many: int = CALIBRATE) -> int:
    """Lists to probe so that at least ``recall`` of the true answers of a few queries lie in them."""
    few = least_hashed(queries, many, asking)
    if not few.num_rows:
        return 1
    ids, q = few["rep"].to_numpy(), matrix(few["vector"])
    order = cells.nearest(space.queries(q), len(cells))
    rows = {int(i): lists[filled[lists] > 0] for i, lists in zip(ids, order)}
    truth = brute_force(index, ids, q, k).select("query", "list").collect()
    ranks = np.sort([int(np.flatnonzero(rows[t.query] == t.list)[0]) for t in truth])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           list_rows: int = LIST) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's k nearest found.

    ``is_query`` is a condition on ``vec_id``. Nearest is the largest inner product in double
    precision, ties to the smaller id; a query's own id is no candidate, equal vectors of other
    ids are. Vectors that are null, empty, zero, of another than the usual length, or hold null or
    non-finite components take no part, nor do rows without an id; repeated rows count once;
    fewer candidates than k are all returned; empty tables give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = with_class(usable(vectors, id_col, vector_col).where("usable").where("vec_id IS NOT NULL"))
    rows = rows.select("vec_id", "class", "vector", is_query.alias("asks"))
    # The k + 1 least ids of a class: what ranks first in each task goes to the shuffle, no more.
    first = Window.partitionBy("class").orderBy("vec_id")
    ids = rows.select("class", "vec_id", "asks").dropDuplicates(["class", "vec_id"])
    members = ids.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("class", "vec_id")
    classes = write_once(
        rows.groupBy("class").agg(
            F.min("vec_id").alias("rep"), F.first("vector").alias("vector"), F.max("asks").alias("asks"),
            F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
            .alias("norm"),
        ),
        "ann-classes",
    )
    n, longest, width, asks = classes.agg(
        F.count("*"), F.max("norm"), F.max(F.size("vector")), F.count_if("asks")
    ).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(width, longest)
    cells = Cells(space.points(sample_of(classes, n)), n / list_rows, rotated=True)
    index = _blocks(classes, space, cells)
    asking = classes.where("asks")
    filled = _filled(index, cells)
    depth = probes_needed(index, asking, asks, space, cells, filled, k)
    probes = write_once(_probes(asking, space, cells, filled, depth, k + 1), "ann-probes")
    first_list = probes.where("nth = 0").withColumn("floor", F.lit(float("-inf")))
    found = write_once(_top(_searched(first_list, index, space, k + 1), k + 1), "ann-first")
    floors = found.where(F.col("place") == k + 1).select("query", F.col("score").alias("floor"))
    others = probes.where("nth > 0").join(floors, "query", "left").fillna(float("-inf"), ["floor"])
    more = _searched(others, index, space, k + 1)
    answers = _top(found.drop("place").unionByName(more), k + 1).select("query", "rep", "score")

    named = classes.select("class", "rep")
    member_ids = members.join(named, "class").select("rep", "vec_id")
    query_ids = ids.where("asks").join(named, "class").select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"))
    candidates = answers.join(member_ids, "rep").join(query_ids, "query").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
