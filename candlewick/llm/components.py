"""Connected components by contraction within tasks and large and small stars across them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import discard, stored

#: Edges that one task contracts in memory: some 100 MB.
TASK_EDGES = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the least node around: all larger ones, or a node and its smaller ones.

    The minima are written out, so that the join behind shuffles both sides and Spark can split
    a node with very many neighbours.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where(F.col("b") < F.col("a"))
    least = stored(
        near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"
    )
    if large:
        linked = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    made = stored(linked.where(F.col("a") != F.col("b")).distinct(), "star")
    discard(least)
    return made


def _contract(batches):
    """Stars in place of the edges of one task: every node goes to the least one it is linked with here."""
    head: dict = {}

    def find(x):
        while head[x] != x:
            head[x] = x = head[head[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            head.setdefault(a, a)
            head.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                head[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in head if head[x] != x]
    if stars:
        yield pa.record_batch([pa.array(c, kind) for c in zip(*stars, strict=True)], ["a", "b"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node that it is connected with.

    Edges are dealt into tasks of at most TASK_EDGES, each of which contracts its own. What is
    still linked across tasks is joined by a large and a small star, and so on until nothing
    changes; the number of rounds grows with the logarithm of the number of nodes. Where one
    task has all edges, nothing is left across.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")).select("a", "b"), "edges")
    schema = ", ".join(f"{name} {kind}" for name, kind in edges.dtypes)
    mark = _mark(edges)
    while mark[0]:
        tasks = -(-mark[0] // TASK_EDGES)
        dealt = edges.repartition(tasks, "b") if tasks > 1 else edges.coalesce(1)
        stars = stored(dealt.mapInArrow(_contract, schema), "stars")
        discard(edges)
        edges = stars
        if tasks == 1:
            break
        large = _star(edges, large=True)
        discard(edges)
        edges = _star(large, large=False)
        discard(large)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return labels.union(roots)
