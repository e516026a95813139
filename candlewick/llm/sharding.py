"""Sharding by vector bin packing: bytes, tokens and rows in balance.

Documents with equal texts form a group. Groups that weigh little are hashed into a fixed number
of buckets; heavy ones stand for themselves. Only these items, a number bounded whatever the size
of the data, come to the driver, heavy groups as counted pieces. Groups are placed whole, heaviest
first, into the shard whose residual capacity has the highest dot product with their weights. Only
a group that no shard has room for is cut, into as few shards as hold it. ``law = "bytes"`` holds:
sizes are near equal.

Defined cases: a null text has no bytes and counts as an empty one. Rows are placed one by one,
so repeated and null ids each get a slot, and a group of them is cut like any other. With fewer rows than shards some shards stay empty. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from candlewick.llm.common import stored

SHARDS = 8
BUCKETS = 4096
#: A group is heavy with more than this share of all bytes, tokens or rows; at most three times
#: its inverse can be. Its pieces, of which only a group without room makes use, are about as
#: heavy as that.
HEAVY = 1 / 2048
RUN_ROWS = 500_000
WEIGHTS = ("bytes", "tokens", "rows")


def _weights(text: Column) -> list[Column]:
    return [
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("grp"),
    ]


def pack(items: np.ndarray, shards: int, groups: np.ndarray | None = None) -> np.ndarray:
    """The shard of each item (rows of weights), by the highest dot product with what is left.

    Weights are shares of their totals. A shard's capacity is an equal part in each dimension.
    Items of one number in ``groups`` stay together where a shard has room for them all. Groups
    go in order of their largest share; the last ones only even out.
    """
    totals = items.sum(axis=0).astype(float)
    shares = items / np.where(totals > 0, totals, 1)
    of = np.arange(len(items)) if groups is None else np.unique(groups, return_inverse=True)[1]
    members = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of))[:-1]) if len(items) else []
    whole = np.array([shares[m].sum(axis=0) for m in members]).reshape(-1, items.shape[1])
    left = np.full((shards, items.shape[1]), 1 / shards)
    placed = np.zeros(len(items), np.int64)

    def room(share: np.ndarray) -> np.ndarray:
        return (left >= share - 1e-12).all(axis=1)

    def put(which: np.ndarray, share: np.ndarray, among: np.ndarray | None = None) -> None:
        # Bytes first among near equals: the law that is promised.
        score = left @ (share * np.array([2.0, 1.0, 1.0]))
        k = int(np.argmax(score if among is None else np.where(among, score, -np.inf)))
        placed[which] = k
        left[k] -= share

    for g in np.lexsort((np.arange(len(members)), -whole.max(axis=1))):
        pieces, fits = members[g], room(whole[g])
        if len(pieces) == 1:
            put(pieces, whole[g])
        elif fits.any():
            put(pieces, whole[g], fits)
        else:
            used = np.where(whole[g] > 0, whole[g], np.inf)
            while len(pieces):
                k = int(np.argmax((left / used + np.where(np.isinf(used), np.inf, 0)).min(axis=1)))
                upto = np.cumsum(shares[pieces], axis=0)
                n = int((left[k] >= upto - 1e-12).all(axis=1).sum())
                if not n:
                    break
                placed[pieces[:n]] = k
                left[k] -= upto[n - 1]
                pieces = pieces[n:]
            for i in pieces:
                put(i, shares[i])
    return placed


def shard(docs: DataFrame, *, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, tokens, text_crc32, shard, slot): where each row goes, and its place there."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spark = docs.sparkSession
    # Written out, so that a row keeps its number, which tells also rows of one id or of none apart.
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), *_weights(text), F.monotonically_increasing_id().alias("row")),
        "shard-rows",
    )

    groups = rows.groupBy("grp").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    totals = rows.agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    ).first()
    n_rows = totals["rows"]
    share = F.greatest(*[F.col(c) / F.lit(float(max(totals[c] or 0, 1))) for c in WEIGHTS])
    # At most 3 / HEAVY groups are heavy, so the list is bounded and may be broadcast.
    heavy = groups.select("grp", F.ceil(share / HEAVY).cast("long").alias("pieces")).where(
        (share > HEAVY)
    )
    heavy = stored(heavy, "shard-heavy")
    piece = F.pmod(F.xxhash64("row"), F.col("pieces"))
    bucket = F.pmod(F.xxhash64("grp"), F.lit(BUCKETS))
    items = rows.join(F.broadcast(heavy), "grp", "left").withColumn(
        "item",
        F.when(F.col("pieces").isNull(), F.concat(F.lit("b"), bucket))
        .otherwise(F.concat("grp", F.lit(":"), piece)),
    )
    listed = sorted(
        items.groupBy("item").agg(
            F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
        ).collect()
    )
    weights = np.array([[r[c] for c in WEIGHTS] for r in listed], float).reshape(-1, 3)
    placed = pack(weights, shards, np.array([r["item"].split(":")[0] for r in listed], str))
    where = spark.createDataFrame(
        [(r["item"], int(s)) for r, s in zip(listed, placed, strict=True)], "item string, shard int"
    )
    put = items.join(F.broadcast(where), "item")
    return numbered(put, n_rows).select("doc_id", "size", "tokens", "text_crc32", "shard", "slot")


def numbered(put: DataFrame, n_rows: int) -> DataFrame:
    """Slots without gaps: ranks within runs of bounded length, plus the rows of earlier runs.

    The number of runs follows the number of rows, so no task ranks a whole shard.
    """
    runs = max(1, -(-n_rows // RUN_ROWS)) * 16
    put = put.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)))
    before = (
        put.groupBy("shard", "run").agg(F.count("*").alias("n"))
        .select(
            "shard", "run",
            F.sum("n").over(W.partitionBy("shard").orderBy("run")).alias("upto"), "n",
        )
        .select("shard", "run", (F.col("upto") - F.col("n")).alias("before"))
    )
    rank = F.row_number().over(
        W.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size", "row")
    )
    ranked = put.withColumn("rank", rank)
    return ranked.join(before, ["shard", "run"]).withColumn(
        "slot", (F.col("before") + F.col("rank") - 1).cast("long")
    )


