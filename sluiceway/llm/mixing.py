"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents that belong to the same set of sources are one pattern, so the flow has as many
nodes as there are patterns and sources. Each pattern supplies its words once at no cost,
again at cost 1, and so on up to ``repeats`` times (costs rise, so no document is repeated
while another that fits is unused); arcs lead to the pattern's sources, and these to the
sink with their quotas. Parts of the network that share no source are solved apart; a
pattern of one source alone needs no search.

What a pattern gives is selected by document: a seeded hash orders its documents, all get
the whole repeats, and those up to the remaining words one more. The document on the border
comes from two histograms of 1,024 slices of the hash and a ranking of one slice of a slice,
so a source with a third of all rows is never in one task. The same rows, seed and quotas give
the same mix.

Only patterns and sources come to the driver; more than ``max_patterns`` raise an error.
Defined results: a null source is a source, last in order; null and empty texts have size 0
and are never taken; equal ids and repeated rows are taken each by itself; an empty table
gives no rows; other columns are kept by ``mix`` if named (names the operator uses itself cannot be) and else ignored;
``mixed`` keeps all, whatever their names.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once
from .common import WORD

#: The weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 17
_SLICE = 10  # bits


def targets(sizes: dict, weights: tuple = WEIGHTS, share: float = SHARE, most: float = REPEATS) -> dict:
    """Words per source: ``share`` of all sizes by weight, none above ``most`` times its size.

    What is above is shared again by weight among the others until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    found = {s: 0.0 for s in order}
    left, waiting = share * sum(sizes.values()), list(order)
    while waiting:
        each = left / sum(weight[s] for s in waiting)
        above = [s for s in waiting if each * weight[s] > most * sizes[s]]
        if not above:
            found |= {s: each * weight[s] for s in waiting}
            break
        for s in above:
            found[s] = float(most * sizes[s])
            left -= found[s]
        waiting = [s for s in waiting if s not in set(above)]
    return found


def _search(patterns: dict, quotas: dict, repeats: int) -> dict:
    """Min-cost flow by successive shortest paths (Dijkstra with potentials)."""
    arcs: list[list] = []  # to, capacity, cost; each arc is followed by its reverse
    out = defaultdict(list)

    def arc(a, b, capacity, cost):
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for pattern, size in patterns.items():
        for k in range(repeats):
            arc("from", ("p", pattern), size, k)
    routes = {}
    for pattern, size in patterns.items():
        for source in pattern:
            routes[pattern, source] = len(arcs)
            arc(("p", pattern), ("s", source), repeats * size, 0)
    for source, quota in quotas.items():
        arc(("s", source), "to", quota, 0)
    potential = defaultdict(int)
    while True:
        far, via, heap, count = {"from": 0}, {}, [(0, 0, "from")], 0
        done = set()
        while heap:
            d, _, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for k in out[node]:
                to, capacity, cost = arcs[k]
                step = d + cost + potential[node] - potential[to]
                if capacity and step < far.get(to, float("inf")):
                    far[to], via[to] = step, k
                    count += 1
                    heapq.heappush(heap, (step, count, to))
        if "to" not in far:
            break
        for node, d in far.items():
            potential[node] += min(d, far["to"])
        path, node = [], "to"
        while node != "from":
            path.append(via[node])
            node = arcs[via[node] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
    return {route: arcs[k ^ 1][1] for route, k in routes.items()}


def flow(patterns: dict[tuple, int], quotas: dict, repeats: int = REPEATS) -> dict[tuple, int]:
    """Words from each pattern to each of its sources, meeting the quotas as far as words allow at least cost."""
    parent = {s: s for s in quotas}

    def top(s):
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for pattern in patterns:
        for source in pattern:
            parent[top(source)] = top(pattern[0])
    parts = defaultdict(dict)
    for pattern, size in patterns.items():
        parts[top(pattern[0])][pattern] = size
    found = {}
    for part in parts.values():
        if len(part) == 1 and len(next(iter(part))) == 1:
            (pattern, size), = part.items()
            found[pattern, pattern[0]] = min(repeats * size, quotas[pattern[0]])
        else:
            found |= _search(part, {s: quotas[s] for p in part for s in p}, repeats)
    return found


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _border(cells: DataFrame, left: str, cell: str) -> DataFrame:
    """For each pattern the cell in which the words ``left`` run out, and what is left at its beginning."""
    upto = Window.partitionBy("pattern").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cells.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
        .where((F.col("before") <= F.col(left)) & (F.col(left) < F.col("before") + F.col("words")))
        .withColumn(left, F.col(left) - F.col("before"))
        .drop("before", "words")
    )


def mix(
    docs: DataFrame,
    members: Column,
    keep: tuple[str, ...] = (),
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = SEED,
    whole: bool = False,
    max_patterns: int = 100_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and the columns in ``keep``.

    ``members`` is the array of a document's sources. ``taken`` is in words, repeats counted; the
    last document of a pattern gives only the words still missing, unless ``whole``, when it is
    taken or left, whichever is nearer. ``source_size`` and ``target`` are those of the first source.
    """
    spark = docs.sparkSession
    mark = F.xxhash64(F.lit(seed), F.col(id_col).cast("long"))
    own = [
        F.col(id_col).cast("long").alias("doc_id"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        # Nulls last in an ascending sort; JSON keeps them apart from the text "null".
        F.to_json(F.sort_array(F.array_distinct(members)), {"ignoreNullFields": "false"}).alias("pattern"),
        mark.alias("mark"),
        F.shiftrightunsigned(mark, 64 - _SLICE).alias("slice"),
        F.shiftrightunsigned(mark, 64 - 2 * _SLICE).bitwiseAND(F.lit((1 << _SLICE) - 1)).alias("part"),
    ]
    narrow = write_once(docs.select(*own), "mixing")
    per_pattern = narrow.groupBy("pattern").agg(F.sum("size").alias("words"))
    found = per_pattern.limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; raise max_patterns")
    patterns = {tuple(json.loads(r.pattern)): r.words for r in found}
    names = {tuple(json.loads(r.pattern)): r.pattern for r in found}
    sizes: dict = defaultdict(int)
    for pattern, words in patterns.items():
        for source in pattern:
            sizes[source] += words
    goal = targets(sizes, weights, share, repeats)
    routed = flow({p: w for p, w in patterns.items() if p}, {s: round(t) for s, t in goal.items()}, repeats)
    wanted: dict = defaultdict(int)
    for (pattern, _), words in routed.items():
        wanted[pattern] += words
    rows = []
    for pattern, words in patterns.items():
        times, rest = divmod(wanted[pattern], words) if words else (0, 0)
        first = pattern[0] if pattern else None
        rows.append((names[pattern], sizes[first] if pattern else 0, goal[first] if pattern else 0.0, times, rest))
    plan = spark.createDataFrame(rows, "pattern string, source_size long, target double, times long, rest long")

    # What is broadcast has one row for each pattern, so at most ``max_patterns``.
    rest = plan.where("rest > 0").select("pattern", "rest")
    cells = narrow.groupBy("pattern", "slice").agg(F.sum("size").alias("words")).join(F.broadcast(rest), "pattern")
    border = F.broadcast(_border(cells, "rest", "slice"))
    inner = narrow.join(border, ["pattern", "slice"]).groupBy("pattern", "slice", "rest", "part")
    border = write_once(_border(inner.agg(F.sum("size").alias("words")), "rest", "part"), "mixing-border")

    ends = border.select("pattern", F.struct("slice", "part").alias("end"), F.col("rest").alias("missing"))
    placed = docs.select(*own, *keep) if keep else narrow
    placed = placed.join(F.broadcast(plan.drop("rest").join(ends, "pattern", "left")), "pattern")
    here = F.struct("slice", "part")
    clear = placed.where(F.col("end").isNull() | (here != F.col("end"))).withColumn(
        "more", F.when(here < F.col("end"), F.col("size")).otherwise(0)
    )
    ranked = Window.partitionBy("pattern").orderBy("mark", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gap = F.greatest(F.lit(0), F.least(F.col("size"), F.col("missing") - before))
    if whole:
        gap = F.when(gap * 2 >= F.col("size"), F.col("size")).otherwise(0)
    border_rows = placed.where(here == F.col("end")).withColumn("more", gap)
    return clear.unionByName(border_rows).select(
        "doc_id", "size", "source_size", "target",
        (F.col("times") * F.col("size") + F.col("more")).cast("long").alias("taken"), *keep,
    )


def mixed(docs: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: whole documents, repeated as often as they are taken."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    inner = docs.select(row, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), members.alias("members"))
    taken = mix(inner, F.col("members"), keep=("row",), whole=True, **options)
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    repeated = taken.where(copies > 0).select("row", F.explode(F.array_repeat(F.lit(0), copies)))
    return repeated.select("row.*")
