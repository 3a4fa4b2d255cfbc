"""Connected components of a graph given as edges, as Spark joins and aggregates.

Alternates the large-star and small-star steps of Kiveris et al., "Connected
Components in MapReduce and Beyond" (2014). Each step takes a minimum per node, which
combines before the shuffle, and one join; the edges never outnumber those given, and
no node's neighbours are gathered. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("src", "dst").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("low"))
    low = F.least("src", "low")
    return (
        both.where(F.col("dst") > F.col("src"))
        .join(least, "src")
        .select(F.col("dst").alias("src"), low.alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the least of them; ``src`` is the larger end."""
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(least, "src").where(F.col("dst") != F.col("low"))
    return (
        moved.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .unionByName(least.select("src", F.col("low").alias("dst")))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) of every node in an edge (``src``, ``dst``: long).

    Loops, repeated and reversed edges and edges with a null end make no difference;
    no edges give no rows.
    """
    spark = edges.sparkSession
    tidy = edges.select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    ).where("src != dst").where(edges["src"].isNotNull() & edges["dst"].isNotNull())
    now = write_once(tidy.distinct(), "components")
    state = _state(now)
    while state[0]:
        now = write_once(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
        if before == state:
            break
    if not state[0]:
        return spark.createDataFrame([], "node long, root long")
    roots = now.select(F.col("dst").alias("node")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
