"""Exact top-k by inner product with pairs of cover trees.

Points and queries are dealt into blocks of bounded size, each with a cover tree of its own.
A query block first meets the data block with the highest bound; the scores found there give
every query a worst kth score. Of all other pairs of blocks only those remain whose bound
reaches it. Within a pair both trees are walked together: a pair of nodes is pruned when
``cq.cp + |cq| rp + |cp| rq + rq rp`` (centres c, covering radii r) stays below the worst kth
score of the query group. Bounds only prune; every score that counts is exact.

Of equal vectors only the k + 1 smallest ids can be among the best, so the others are dropped
beforehand, through Spark's group limit; no result is lost by it.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part.
Shorter vectors are filled up with zeros. Rows of one id and vector are one row, and a row never
finds its own id. Null ids are the smallest. Scores beyond a long are cut to its range.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from candlewick.llm.common import id_back, id_or_lowest, stored

BLOCK_ROWS = 2048
LEAF = 64
#: The sample that block centres are chosen from, and their number at most. Every row is indexed.
SAMPLE = 4096
MAX_CENTRES = 256
_SLACK = 1e-9


def whole_vector(column: str, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors that take no part."""
    x = F.col(column).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(
        (F.size(x) > 0) & sound, F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    )


# -- trees -------------------------------------------------------------------------


class CoverTree:
    """Points in tree order; of each node its range, centre, covering radius and children."""

    def __init__(self, ids, points, first, last, centre, radius, child_from, child_to):
        self.ids, self.points = ids, points
        self.first, self.last, self.radius = first, last, radius
        self.child_from, self.child_to = child_from, child_to
        self.centre = centre
        self.norm = np.sqrt((centre**2).sum(axis=1))

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> CoverTree:
        """Breadth first: the points of a node go to children that lie apart by half its radius.

        Each child covers what is within half the radius of its centre; children of few points
        are gathered into leaves.
        """
        exact = points
        points = points.astype(float)
        nodes: list[list] = [[0, len(ids), 0, 0.0, 0, 0]]  # first, last, centre, radius, children
        arranged = np.arange(len(ids))
        at = 0
        while at < len(nodes):
            first, last = nodes[at][:2]
            own = arranged[first:last]
            centre = own[0]
            away = np.sqrt(((points[own] - points[centre]) ** 2).sum(axis=1))
            radius = float(away.max())
            nodes[at][2], nodes[at][3] = int(centre), radius
            if last - first > LEAF and radius > 0:
                groups = _cover(points, own, away, radius / 2)
                arranged[first:last] = np.concatenate(groups)
                nodes[at][4] = len(nodes)
                for group in groups:
                    nodes.append([first, first + len(group), 0, 0.0, 0, 0])
                    first += len(group)
                nodes[at][5] = len(nodes)
            at += 1
        table = np.array([n[:3] + n[4:] for n in nodes], np.int64)
        return cls(
            ids[arranged], exact[arranged], table[:, 0], table[:, 1],
            points[table[:, 2]], np.array([n[3] for n in nodes]), table[:, 3], table[:, 4],
        )

    _FIELDS = ("ids", "points", "first", "last", "centre", "radius", "child_from", "child_to")

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self._FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        held = np.load(io.BytesIO(data))
        return cls(**{name: held[name] for name in cls._FIELDS})

    def leaf(self, node: int) -> bool:
        return self.child_to[node] == 0

    def children(self, node: int) -> range:
        return range(int(self.child_from[node]), int(self.child_to[node]))


def _cover(points: np.ndarray, own: np.ndarray, away: np.ndarray, reach: float) -> list[np.ndarray]:
    """Groups of ``own``, each within ``reach`` of its first point; small ones put together."""
    groups, small, left, far = [], [], own, away
    while len(left):
        centre = left[np.argmax(far)] if groups or small else left[0]
        near = np.sqrt(((points[left] - points[centre]) ** 2).sum(axis=1)) <= reach
        group = np.concatenate([[centre], left[near & (left != centre)]])
        (groups if len(group) > LEAF // 4 else small).append(group)
        left, far = left[~near], far[~near]
    gathered = np.concatenate(small) if small else np.empty(0, np.int64)
    groups += [gathered[i : i + LEAF] for i in range(0, len(gathered), LEAF)]
    # A single group would be the node itself once more.
    return groups if len(groups) > 1 else [own[: len(own) // 2], own[len(own) // 2 :]]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as longs."""
    largest = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    bound = largest * a.shape[1]
    if bound < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


LOWEST = -(2**63)


def search(queries: CoverTree, data: CoverTree, k: int, worst: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the best k of each query among ``data``, score first, then smaller id.

    ``worst`` has for each query a score that its kth best reaches at least; worse ones are left out.
    """
    n = len(queries.ids)
    worst = worst.copy()
    ids: list[np.ndarray] = [np.empty(0, np.int64)] * n
    scores: list[np.ndarray] = [np.empty(0, np.int64)] * n

    def bound(q: int, d: int) -> float:
        value = float(queries.centre[q] @ data.centre[d])
        value += queries.norm[q] * data.radius[d] + data.norm[d] * queries.radius[q]
        value += queries.radius[q] * data.radius[d]
        return value + abs(value) * _SLACK + 1e-6

    stack = [(bound(0, 0), 0, 0)]
    while stack:
        most, q, d = stack.pop()
        q0, q1 = int(queries.first[q]), int(queries.last[q])
        if most < worst[q0:q1].min():
            continue
        if queries.leaf(q) and data.leaf(d):
            d0, d1 = int(data.first[d]), int(data.last[d])
            found = products(queries.points[q0:q1], data.points[d0:d1])
            for i in np.flatnonzero(found.max(axis=1) >= worst[q0:q1]).tolist():
                good = found[i] >= worst[q0 + i]
                s = np.concatenate([scores[q0 + i], found[i][good]])
                x = np.concatenate([ids[q0 + i], data.ids[d0:d1][good]])
                best = np.lexsort((x, -s))[:k]
                scores[q0 + i], ids[q0 + i] = s[best], x[best]
                if len(best) == k:
                    worst[q0 + i] = max(worst[q0 + i], int(s[best[-1]]))
            continue
        split_query = data.leaf(d) or (not queries.leaf(q) and queries.radius[q] > data.radius[d])
        pairs = [(c, d) for c in queries.children(q)] if split_query else [(q, c) for c in data.children(d)]
        # The most promising pair is on top of the stack.
        stack += sorted((bound(a, b), a, b) for a, b in pairs)
    for i in range(n):
        if len(ids[i]):
            yield int(queries.ids[i]), ids[i], scores[i]


# -- blocks ------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other: each next one is the farthest from those before."""
    points = sample.astype(float)
    picked = [0]
    away = ((points - points[0]) ** 2).sum(axis=1)
    while len(picked) < min(count, len(points)) and away.max() > 0:
        picked.append(int(np.argmax(away)))
        away = np.minimum(away, ((points - points[picked[-1]]) ** 2).sum(axis=1))
    return points[picked]


def blocks(points: DataFrame, dims: int, name: str) -> DataFrame:
    """(block, tree, centre, radius) over all rows of ``points`` (id, v)."""
    total = points.count()
    sample = points.orderBy(F.xxhash64("v", "id")).limit(SAMPLE).select("v").toArrow()
    if not total:
        centres = np.zeros((1, dims))
    else:
        centres = _centres(_matrix(sample["v"], dims), min(MAX_CENTRES, -(-total // BLOCK_ROWS)))
    half = (centres**2).sum(axis=1) / 2

    def cells(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), dims).astype(float)
            cell = np.argmin(half - v @ centres.T, axis=1).astype(np.int64)
            yield pa.record_batch(
                [batch.column("id"), batch.column("v"), pa.array(cell)], ["id", "v", "cell"]
            )

    dealt = stored(points.mapInArrow(cells, "id long, v array<long>, cell long"), f"{name}-cells")
    counts = {r["cell"]: r["n"] for r in dealt.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts = F.lit(1)
    for cell, n in counts.items():
        if n > BLOCK_ROWS:
            parts = F.when(F.col("cell") == cell, -(-n // BLOCK_ROWS)).otherwise(parts)
    block = F.col("cell") + MAX_CENTRES * F.pmod(F.xxhash64("id"), parts)

    def tree(group: pa.Table) -> pa.Table:
        made = CoverTree.build(group["id"].to_numpy(), _matrix(group["v"], dims))
        return pa.table({
            "block": group["block"][:1],
            "tree": pa.array([made.to_bytes()], pa.binary()),
            "centre": pa.array([made.centre[0].tolist()]),
            "radius": pa.array([float(made.radius[0])]),
        })

    grown = dealt.select("id", "v", block.alias("block")).groupBy("block").applyInArrow(
        tree, "block long, tree binary, centre array<double>, radius double"
    )
    return stored(grown, f"{name}-trees")


def _bound() -> Column:
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    cq, cd = F.col("q_centre"), F.col("d_centre")
    value = (
        dot(cq, cd) + F.sqrt(dot(cq, cq)) * F.col("d_radius") + F.sqrt(dot(cd, cd)) * F.col("q_radius")
        + F.col("q_radius") * F.col("d_radius")
    )
    return value + F.abs(value) * _SLACK + 1e-6


def _searched(pairs: DataFrame, q_trees: DataFrame, d_trees: DataFrame, k: int) -> DataFrame:
    """(q_block, query, id, score) of all ``pairs`` (q_block, d_block, worst: an array or null)."""
    shipped = (
        pairs.join(q_trees.select(F.col("block").alias("q_block"), F.col("tree").alias("q_tree")), "q_block")
        .join(d_trees.select(F.col("block").alias("d_block"), F.col("tree").alias("d_tree")), "d_block")
        .select("q_block", "q_tree", "d_tree", "worst")
    )

    def walk(row):
        queries = CoverTree.from_bytes(bytes(row["q_tree"]))
        worst = np.full(len(queries.ids), LOWEST, np.int64)
        known = dict(row["worst"] or ())
        for i, q in enumerate(queries.ids.tolist()):
            worst[i] = known.get(q, LOWEST)
        for query, ids, scores in search(queries, CoverTree.from_bytes(bytes(row["d_tree"])), k, worst):
            for x, s in zip(ids.tolist(), scores.tolist(), strict=True):
                yield row["q_block"], query, x, s

    # Rows hold two whole trees, and an RDD hands them over a few at a time; Arrow batches count
    # rows and not bytes.
    spread = shipped.repartition(max(pairs.sparkSession.sparkContext.defaultParallelism, 1) * 2)
    return spread.sparkSession.createDataFrame(
        spread.rdd.flatMap(walk), "q_block long, query long, id long, score long"
    )


def top_k(points: DataFrame, queries: DataFrame, k: int, *, id_col: str, vector_col: str) -> DataFrame:
    """(query_id, rank, id, score) for every row of ``queries`` against every other row of ``points``.

    ``vector_col`` holds arrays of longs in both.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(id_or_lowest(id_col).alias("id"), F.col(vector_col).alias("v")).where(F.size("v") > 0)

    asked = stored(clean(queries).distinct(), "topk-queries")
    smallest = F.row_number().over(W.partitionBy("v").orderBy("id"))
    held = stored(
        clean(points).distinct().withColumn("r", smallest).where(F.col("r") <= k + 1).drop("r"), "topk-points"
    )
    kinds = asked.groupBy("v").agg(F.min("id").alias("id"))
    dims = max(
        held.agg(F.max(F.size("v"))).first()[0] or 1, asked.agg(F.max(F.size("v"))).first()[0] or 1
    )
    d_trees = blocks(held, dims, "topk-data")
    # One query stands for all with its vector.
    q_trees = blocks(stored(kinds, "topk-kinds"), dims, "topk-asked")

    def side(trees: DataFrame, p: str) -> DataFrame:
        return trees.select(*[F.col(c).alias(f"{p}_{c}") for c in ("block", "centre", "radius")])

    pairs = stored(
        side(q_trees, "q").crossJoin(side(d_trees, "d"))
        .select("q_block", "d_block", _bound().alias("bound")),
        "topk-pairs",
    )
    place = F.row_number().over(W.partitionBy("q_block").orderBy(F.desc("bound"), "d_block"))
    first = pairs.withColumn("place", place).where("place = 1").select("q_block", "d_block")
    no_worst = F.lit(None).cast("array<struct<query: long, score: long>>")
    begun = stored(_searched(first.withColumn("worst", no_worst), q_trees, d_trees, k + 1), "topk-first")
    # Queries of a block whose first list is not full have no worst score yet.
    per_query = begun.groupBy("q_block", "query").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    full = per_query.where(F.col("n") > k)
    worst = full.groupBy("q_block").agg(
        F.collect_list(F.struct("query", "score")).alias("worst"),
        F.count("*").alias("n_full"), F.min("score").alias("least"),
    )
    sizes = per_query.groupBy("q_block").agg(F.count("*").alias("n_queries"))
    left = (
        pairs.join(first, ["q_block", "d_block"], "left_anti")
        .join(sizes, "q_block", "left").join(worst, "q_block", "left")
        .where(
            F.col("n_full").isNull() | (F.col("n_full") < F.col("n_queries"))
            | (F.col("bound") >= F.col("least"))
        )
        .select("q_block", "d_block", "worst")
    )
    rest = _searched(left, q_trees, d_trees, k + 1)
    every = stored(begun.union(rest).select("query", "id", "score"), "topk-found")
    best = W.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = every.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    named = asked.join(kinds.withColumnRenamed("id", "query"), "v").select(F.col("id").alias("query_id"), "query")
    own = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "id")
    ranked = (
        named.join(lists, "query").where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    )
    return ranked.select(id_back("query_id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                         id_back("id").alias("id"), "score")
