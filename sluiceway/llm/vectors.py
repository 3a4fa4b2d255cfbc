"""What both vector operators share: rows that take part, classes of equal vectors, centroids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that the centroids are fitted on at most.
SAMPLE = 20_000
#: Centroids of a codebook at most, which the sample can carry: a million cells for two.
MOST_CENTROIDS = 1024


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``vector`` and ``usable``: neither null, empty nor zero, and only finite components.

    If vectors differ in length, those of the most frequent length (the smallest of these) are usable.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    top = F.lit(float("inf"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top)) & F.exists(
        "vector", lambda x: x != 0
    )
    rows = rows.withColumn("usable", F.coalesce(fine, F.lit(False)))
    widths = rows.where("usable").groupBy(F.size("vector").alias("d")).count()
    best = widths.orderBy(F.desc("count"), "d").first()
    return rows.withColumn("usable", F.col("usable") & (F.size("vector") == (best.d if best else -1)))


def with_class(rows: DataFrame) -> DataFrame:
    """``rows`` with ``class``: 128 bits of hash, the same for equal vectors."""
    return rows.withColumn("class", F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b")))


def least_hashed(vectors: DataFrame, rows: int, total: int) -> pa.Table:
    """``rep`` and ``vector`` of at most ``rows`` of ``total`` vectors, those with the least hashes of their id.

    Tasks send about twice as many in all, however many there are, to the one that takes the least.
    """
    grid = 1 << 40
    within = F.shiftrightunsigned("h", 24) <= int(min(1.0, (2 * rows + 64) / max(total, 1)) * grid)
    marked = vectors.select(F.xxhash64("rep").alias("h"), "rep", "vector").where(within)
    return marked.orderBy(F.shiftrightunsigned("h", 24), "rep").limit(rows).toArrow()


def sample_of(vectors: DataFrame, total: int, rows: int = SAMPLE) -> np.ndarray:
    return matrix(least_hashed(vectors, rows, total)["vector"])


def matrix(column) -> np.ndarray:
    """A column of equally long lists as an array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def centroids(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Lloyd's k-means; an empty cell keeps its centre."""
    k = max(1, min(k, len(sample)))
    centres = sample[np.random.default_rng(seed).permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        own = nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows, less the points' own norms."""
    return (centres**2).sum(axis=1) - 2 * points @ centres.T


def nearest(points: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """For each point its ``k`` nearest centres, nearest first, equal ones by number."""
    k = min(k, len(centres))
    out = np.empty((len(points), k), np.int64)
    for some in chunks(len(points), 1024):
        far = distances(points[some], centres)
        out[some] = far.argmin(axis=1)[:, None] if k == 1 else np.argsort(far, axis=1, kind="stable")[:, :k]
    return out


class Cells:
    """Cells of a product of two codebooks: one centroid for either half of the dimensions.

    Two codebooks of k centroids make k * k cells, so a bounded sample and a small model give as
    many cells as the rows need (Babenko and Lempitsky, "The Inverted Multi-Index", 2012). The
    dimensions are rotated first, so that either half tells as much, unless they are already.
    """

    def __init__(self, sample: np.ndarray, wanted: float, rotated: bool = False, seed: int = 9):
        d = sample.shape[1]
        noise = np.random.default_rng(seed).standard_normal((d, d))
        self.rotation = None if rotated else np.linalg.qr(noise)[0]
        self.half = (d + 1) // 2
        k = max(1, min(MOST_CENTROIDS, round(np.sqrt(wanted))))
        first, second = self._halves(sample)
        self.first = centroids(first, k)
        self.second = centroids(second, k) if d > 1 else np.zeros((1, 0))

    def __len__(self) -> int:
        return len(self.first) * len(self.second)

    def _halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = points if self.rotation is None else points @ self.rotation
        return turned[:, : self.half], turned[:, self.half :]

    def nearest(self, points: np.ndarray, n: int) -> np.ndarray:
        """For each point its ``n`` nearest cells, nearest first."""
        first, second = self._halves(points)
        n, width = min(n, len(self)), len(self.second)
        if n == 1:
            return nearest(first, self.first, 1) * width + nearest(second, self.second, 1)
        # Cell (i, j) by rank in either half comes after all (i', j') with i' <= i and j' <= j, so
        # the n nearest are among those with (i + 1) * (j + 1) <= n.
        i, j = np.divmod(np.arange(min(len(self.first), n) * min(width, n)), min(width, n))
        some = (i + 1) * (j + 1) <= n
        i, j = i[some], j[some]
        out = np.empty((len(points), n), np.int64)
        for tile in chunks(len(points), max(1, (1 << 20) // len(i))):
            a, b = distances(first[tile], self.first), distances(second[tile], self.second)
            by_a, by_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
            a, b = np.take_along_axis(a, by_a, axis=1), np.take_along_axis(b, by_b, axis=1)
            top = np.argsort(a[:, i] + b[:, j], axis=1, kind="stable")[:, :n]
            rows = np.arange(len(top))[:, None]
            out[tile] = by_a[rows, i[top]] * width + by_b[rows, j[top]]
        return out

    def nearest_filled(self, points: np.ndarray, n: int, filled: np.ndarray, least: int) -> list[np.ndarray]:
        """For each point its ``n`` nearest cells that hold rows, and more until they hold ``least`` rows.

        ``filled`` has the number of rows of each cell.
        """
        out: list = [None] * len(points)
        waiting, m = np.arange(len(points)), min(2 * n, len(self))
        while len(waiting):
            left = []
            for some in chunks(len(waiting), max(1, (1 << 20) // m)):
                rows = waiting[some]
                order = self.nearest(points[rows], m)
                held = filled[order]
                rank = np.cumsum(held > 0, axis=1)
                before = np.cumsum(held, axis=1) - held
                for k, row in enumerate(rows):
                    if m < len(self) and (rank[k, -1] < n or before[k, -1] + held[k, -1] < least):
                        left.append(row)
                    else:
                        out[row] = order[k, (held[k] > 0) & ((rank[k] <= n) | (before[k] < least))]
            waiting, m = np.array(left, np.int64), min(4 * m, len(self))
        return out


def chunks(n: int, size: int) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))
