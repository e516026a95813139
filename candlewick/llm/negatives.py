"""Hard-negative mining with full exact scores by the method of the Four Russians.

Vectors are integers. The components of an anchor are cut into groups of eight; for each group a
table holds the sums of all 256 subsets. A candidate is kept as bit planes: plane p has bit p of
each of its components in two's complement, so eight components give one byte, which is the place
of their sum in the table. A score is the sum over planes of ``2**p`` times the looked-up sums (the
top plane counts negative): shifts and additions, no product.

Anchors are dealt into blocks and rows into chunks, both of bounded size; a block meets a chunk in a
group of its own, however the labels are spread. Each pair is scored once: rows of the anchor's label
first, which settles its positives, then the others against those.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part.
An empty vector scores 0, a shorter one is filled up with zeros. Scores are 64-bit whole numbers and
wrap as such. Rows of the anchor's own id are not its candidates; any other row is one, repeated rows
included. Repeated anchors count once; different anchor rows of one id are mined apart. Null ids are
candidates after all others among equal scores. An anchor without positives, and a positive without
negatives in its range, give no row. An empty table gives none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from candlewick.llm.common import discard, stored

#: Components to a table; a table has two to the power of this many sums.
GROUP = 8
CHUNK_ROWS = 8192
BLOCK_ANCHORS = 4096
#: Anchors and rows that are scored in one go, so that tables and sums stay in the cache.
TABLE_ANCHORS = 64
SCORED_ROWS = 1024
MAX_TASKS = 20_000
#: Stands for a null id, so that it comes after all others.
LAST_ID = 2**63 - 1


def whole_vector(column: str, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors that take no part."""
    x = F.col(column).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(sound, F.transform(x, lambda c: F.floor(c * scale).cast("long")))


# -- scoring -------------------------------------------------------------------------


def planes_for(low: int, high: int) -> int:
    """Bits of two's complement that hold all of low..high."""
    return max(int(low).bit_length() if low >= 0 else (-int(low) - 1).bit_length(), int(high).bit_length()) + 1


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups): the bytes that eight components have in each plane."""
    return np.stack(
        [np.packbits((vectors >> p & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(planes)], axis=1
    )


def subset_tables(anchors: np.ndarray, planes: int) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of eight components of each anchor."""
    largest = max((sum(abs(int(x)) for x in row) for row in anchors), default=0)
    kind = np.int32 if largest << planes < 2**31 else np.int64
    parts = anchors.T.reshape(-1, GROUP, len(anchors)).astype(kind)
    sums = np.zeros((len(parts), 1 << GROUP, len(anchors)), kind)
    for i in range(GROUP):
        sums[:, 1 << i : 2 << i] = sums[:, : 1 << i] + parts[:, i, None]
    return sums


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors): the exact inner products, from the top plane down."""
    out = np.zeros((len(packed), tables.shape[2]), tables.dtype)
    for at in range(0, len(packed), SCORED_ROWS):
        rows = packed[at : at + SCORED_ROWS]
        total, found = out[at : at + SCORED_ROWS], np.empty((len(rows), tables.shape[2]), tables.dtype)
        for p in reversed(range(packed.shape[1])):
            np.left_shift(total, 1, out=total)
            for g in range(packed.shape[2]):
                np.take(tables[g], rows[:, p, g], axis=0, out=found)
                np.add(total, found, out=total)
            if p == packed.shape[1] - 1:
                np.negative(total, out=total)
    return out


def best_of(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest values, equal ones in order of place."""
    if len(values) > n:
        places = np.flatnonzero(values >= np.partition(values, len(values) - n)[len(values) - n])
    else:
        places = np.arange(len(values))
    return places[np.argsort(-values[places], kind="stable")][:n]


# -- one block of anchors against one chunk of rows ---------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, *shape: int, kind=np.uint8) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, *shape)


def _scored(chunk: pa.Table, block: pa.Table, planes: int, groups: int, same: bool) -> Iterator[tuple]:
    """(anchor's place in block, scores, ids) against the rows of its label, or of all others."""
    if not chunk.num_rows or not block.num_rows:
        return
    chunk = chunk.sort_by("id")
    ids, labels = chunk["id"].to_numpy(), chunk["label"].to_numpy()
    packed = _matrix(chunk["packed"], planes, groups)
    vectors, of = _matrix(block["vector"], groups * GROUP, kind=np.int64), block["label"].to_numpy()
    for label in np.unique(of):
        mine = (labels == label) == same
        own_ids, own = ids[mine], packed[mine]
        places = np.flatnonzero(of == label)
        for at in range(0, len(places), TABLE_ANCHORS):
            some = places[at : at + TABLE_ANCHORS]
            found = scores(subset_tables(vectors[some], planes), own)
            for k, place in enumerate(some):
                yield place, found[:, k], own_ids


def _positives(planes: int, groups: int, n: int) -> Callable:
    def pick(chunk: pa.Table, block: pa.Table) -> pa.Table:
        anchors, keys = block["id"].to_numpy(), block["key"].to_numpy()
        out = []
        for place, found, ids in _scored(chunk, block, planes, groups, same=True):
            others = ids != anchors[place]
            found, ids = found[others], ids[others]
            out += [(int(keys[place]), int(ids[i]), int(found[i])) for i in best_of(found, n)]
        return _table(out, ["key", "id", "score"])

    return pick


def _negatives(planes: int, groups: int, n: int, least: int, most: int) -> Callable:
    def pick(chunk: pa.Table, block: pa.Table) -> pa.Table:
        anchors, keys, wanted = block["id"].to_numpy(), block["key"].to_numpy(), block["positives"].to_pylist()
        out = []
        for place, found, ids in _scored(chunk, block, planes, groups, same=False):
            goals = [(p["rank"], p["score"]) for p in wanted[place]]
            # Python's whole numbers do not overflow in the products of the bounds.
            ranges = [(-(-least * s // 100), most * s // 100) for _, s in goals]
            low, high = min(a for a, _ in ranges), max(b for _, b in ranges)
            near = np.flatnonzero((found >= low) & (found <= high) & (ids != anchors[place]))
            near = near[np.argsort(-found[near], kind="stable")]
            falling = -found[near].astype(np.int64)
            for (rank, _), (a, b) in zip(goals, ranges, strict=True):
                first, last = np.searchsorted(falling, -b), np.searchsorted(falling, -a, side="right")
                out += [
                    (int(keys[place]), rank, int(ids[i]), int(found[i])) for i in near[first : min(last, first + n)]
                ]
        return _table(out, ["key", "of", "id", "score"])

    return pick


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns, strict=True)})


# -- the plan ----------------------------------------------------------------------------


def _packed(planes: int, groups: int) -> Callable:
    """Rows with their bit planes; anchors also keep the components themselves."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = lists.value_lengths().to_numpy()
            vectors = np.zeros((batch.num_rows, groups * GROUP), np.int64)
            vectors[np.arange(groups * GROUP) < sizes[:, None]] = lists.flatten().to_numpy()
            whole = [x.tobytes() if a else None for x, a in zip(vectors, batch.column("anchor").to_pylist(), strict=True)]
            yield pa.record_batch(
                [
                    batch.column("id"), batch.column("label"),
                    pa.array([x.tobytes() for x in bit_planes(vectors, planes)], pa.binary()), pa.array(whole, pa.binary()),
                ],
                ["id", "label", "packed", "vector"],
            )

    return pack


def hard_negatives(rows: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "v", positives: int = 5, negatives: int = 5, least: int = 80,
                   most: int = 100) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds whole numbers. Positives are an anchor's ``positives`` best rows of its label;
    their negatives the best rows of other labels that score from ``least`` to ``most`` per cent of
    the positive's score.
    """
    sound = rows.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<long>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("label").isNotNull() & F.col("v").isNotNull())
    shape = sound.agg(
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.max(F.size("v")).alias("dims")
    ).first()
    groups = max(1, -(-(shape["dims"] or 0) // GROUP))
    planes = planes_for(shape["low"] or 0, shape["high"] or 0)

    packed = stored(
        sound.mapInArrow(_packed(planes, groups), "id long, label long, packed binary, vector binary")
        # Fixed once written: a number for the row that does not depend on its values.
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    anchors = stored(
        packed.where(F.col("vector").isNotNull()).dropDuplicates(["id", "label", "vector"])
        .select("id", "label", "vector", F.monotonically_increasing_id().alias("key")),
        "anchors",
    )
    chunks = max(1, -(-packed.count() // CHUNK_ROWS))
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    tasks = min(4 * chunks * blocks, MAX_TASKS)

    def dealt(df: DataFrame, own: str, row: str, n: int, other: str, others: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64(row), F.lit(n)).cast("int"))
        placed = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        # The number of tasks follows the work, which the size of the rows does not show.
        return placed.repartition(tasks, "block", "chunk")

    def met(block: DataFrame, pick: Callable, fields: str) -> DataFrame:
        chunk = dealt(packed.select("id", "label", "packed", "row"), "chunk", "row", chunks, "block", blocks)
        return chunk.groupBy("block", "chunk").cogroup(
            dealt(block, "block", "key", blocks, "chunk", chunks).groupBy("block", "chunk")
        ).applyInArrow(pick, fields)

    def ranked(df: DataFrame, n: int, *keys: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    found = ranked(met(anchors, _positives(planes, groups, positives), "key long, id long, score long"), positives, "key")
    # At most ``positives`` to an anchor.
    listed = found.groupBy("key").agg(F.collect_list(F.struct("rank", "id", "score")).alias("positives"))
    goals = stored(anchors.join(listed, "key"), "positives")
    hits = met(goals, _negatives(planes, groups, negatives, least, most), "key long, of long, id long, score long")
    pairs = goals.select("key", F.col("id").alias("anchor_id"), F.inline("positives").alias("of", "positive", "positive_score"))

    def id_of(column: str) -> Column:
        return F.when(F.col(column) != LAST_ID, F.col(column))

    made = ranked(hits, negatives, "key", "of").join(pairs, ["key", "of"]).select(
        id_of("anchor_id").alias("anchor_id"), id_of("positive").alias("positive_id"),
        F.col("of").cast("int").alias("positive_rank"), "rank", id_of("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
    result = stored(made, "negatives")
    for spent in (packed, anchors, goals):
        discard(spent)
    return result
