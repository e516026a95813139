"""N-gram Jaccard join by chosen paths.

Texts become sets of five-word shingles; equal sets are one class. A MinHash signature embeds
each set as 128 tokens, of which two sets share as large a part as their Jaccard similarity.
A run samples two coordinates at the root, the same for all classes, and sends each class to the
buckets of its tokens there. Buckets that are still too large are split again at coordinates
sampled for that bucket; small ones are compared whole. Runs are repeated until a pair at the
threshold is met with the target recall.

A first run over one level, with large buckets cut into blocks, links most copies. The others
then leave out buckets whose members are linked already, so a large group of near copies costs
no more than its rows. What is linked so far are candidates by signature. The candidates of a
component are then compared exactly, all with all in blocks: links are counted, and only links
that hold make the final groups. No pair of texts is ever a row.

Defined cases: null and empty texts have the empty set, form one class and no links. A text of
one to four words has all of them as its one shingle. Rows that repeat are copies. Ids may be
null or repeat. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import discard, free_name, id_back, id_or_lowest, small_batches, stored, texts
from candlewick.llm.components import components
from candlewick.llm.shingles import COORDS, WORDS, digest, mixed, shingle_set, signature

SIMILARITY = (4, 5)  # as a fraction: 0.8
RECALL = 0.999
#: Coordinates sampled for each bucket that is split.
BRANCHES = 2
#: Buckets up to this size are compared whole.
SMALL = 256
MAX_DEPTH = 12
#: Signatures of pairs at the threshold agree in less only once in some 100,000 cases.
ESTIMATE = 0.64
#: Size of the bit set of candidates' ids: at most 131,072 words of 64 bits.
ID_BITS = 1 << 23
#: Shingles of a block of candidates.
BLOCK_SHINGLES = 400_000


def survival(similarity: float, depth: int, branches: int = BRANCHES) -> float:
    """Chance that a pair stays together in some bucket of one run, down to ``depth`` levels."""
    q = 1.0
    for _ in range(depth):
        q = 1 - (1 - similarity * q) ** branches
    return q


def runs_for(recall: float, similarity: float, depth: int = MAX_DEPTH) -> int:
    miss = 1 - survival(similarity, depth)
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1


# -- classes -----------------------------------------------------------------------


def _marks(batches):
    for batch in batches:
        rows = []
        for text in texts(batch.column(1)):
            s = shingle_set(text, WORDS)
            rows.append((digest(s), xxhash.xxh3_128_digest(text), len(s), signature(s).tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc", "node", "body", "n", "sig"],
        )


def _classes(marks: DataFrame) -> DataFrame:
    """(node, first, n_texts, n, sig): one row per set, with its smallest id and number of texts."""
    bodies = marks.groupBy("node", "body").agg(
        F.min("doc").alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    return stored(
        bodies.groupBy("node").agg(
            F.min("first").alias("first"), F.count("*").alias("n_texts"),
            F.first("n").alias("n"), F.first("sig").alias("sig"),
        ),
        "classes",
    )


# -- buckets -----------------------------------------------------------------------


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def _paths(paths: np.ndarray, sigs: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets below: coordinates are sampled by the path, and their tokens extend it."""
    rows = np.arange(len(paths))
    at = (mixed(paths) % np.uint64(COORDS)).astype(np.int64)
    for _ in range(BRANCHES):
        token = (at.astype(np.uint64) << np.uint64(32)) | sigs[rows, at].astype(np.uint64)
        yield mixed(paths ^ mixed(token))
        step = mixed(paths + np.uint64(1)) % np.uint64(COORDS - 1)
        at = (at + 1 + step.astype(np.int64)) % COORDS


def _split(batches):
    for batch in batches:
        sigs = _signatures(batch.column("sig"))
        paths = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for below in _paths(paths, sigs):
            yield pa.record_batch([pa.array(below.view(np.int64)), batch.column("node")], ["path", "node"])


def _descend(rows: DataFrame) -> DataFrame:
    return rows.select("path", "node", "sig").mapInArrow(_split, "path long, node binary")


def _sizes(rows: DataFrame) -> DataFrame:
    """Buckets with members that are not linked yet. Written out, so that a large bucket's rows can be split."""
    sizes = rows.groupBy("path").agg(
        F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return stored(sizes.where(F.col("low") != F.col("high")).select("path", "size"), "sizes")


def _consecutive(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with one key each, from batches sorted by it."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = table[key].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            if held and held[-1][key][-1].as_py() != int(keys[lo]):
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def _star_edges(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """(member, first member) of each connected part of a symmetric boolean matrix."""
    seen = np.zeros(len(near), bool)
    for root in np.flatnonzero(near.any(axis=1)):
        if seen[root]:
            continue
        part = np.zeros(len(near), bool)
        edge = part.copy()
        edge[root] = True
        while edge.any():
            part |= edge
            edge = near[edge].any(axis=0) & ~part
        seen |= part
        for i in np.flatnonzero(part):
            if i != root:
                yield int(i), int(root)


def _alike(batches):
    """Edges between members of a bucket that look similar and are not linked yet."""
    for group in _consecutive(batches, "bucket"):
        labels = group["label"].to_pylist()
        sigs = _signatures(group["sig"])
        if len(sigs) == 2:
            near = np.array([[False, True], [True, False]]) & ((sigs[0] == sigs[1]).mean() >= ESTIMATE)
        else:
            near = np.stack([(sigs == s).mean(axis=1) >= ESTIMATE for s in sigs])
            np.fill_diagonal(near, False)
        codes = np.unique(labels, return_inverse=True)[1] if len(set(labels)) < len(labels) else None
        if codes is not None:
            near &= codes[:, None] != codes[None, :]
        nodes = group["node"]
        edges = [(nodes[i].as_py(), nodes[j].as_py()) for i, j in _star_edges(near)]
        if edges:
            yield pa.record_batch(
                [pa.array(c, pa.binary()) for c in zip(*edges, strict=True)], ["a", "b"]
            )


def _compared(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) found in the buckets of ``leaves`` (bucket, node, label)."""
    rows = leaves.join(classes.select("node", "sig"), "node")
    return rows.repartition("bucket").sortWithinPartitions("bucket").select(
        "bucket", "node", "label", "sig"
    ).mapInArrow(_alike, "a binary, b binary")


def _first_wave(classes: DataFrame) -> DataFrame:
    """One level of one run; buckets that are too large are cut into blocks at random."""
    rows = stored(
        _descend(classes.select(F.lit(0).cast("long").alias("path"), "node", "sig")).withColumn("label", F.col("node")),
        "paths",
    )
    sizes = _sizes(rows)
    blocks = F.ceil(F.col("size") / SMALL)
    bucket = F.when(F.col("size") > SMALL, F.xxhash64("path", F.pmod(F.xxhash64("node", "path"), blocks)))
    leaves = rows.join(sizes, "path").select(bucket.otherwise(F.col("path")).alias("bucket"), "node", "label")
    edges = stored(_compared(leaves, classes), "wave")
    discard(rows)
    discard(sizes)
    return edges


def _second_wave(classes: DataFrame, labels: DataFrame, runs: int) -> DataFrame:
    """All levels of all runs, leaving out what is linked already.

    A bucket is compared when all but SMALL of its members are linked with each other: the rest
    then go to every block of it, which stays in proportion to its rows. Other buckets are split.
    """
    known = classes.join(labels, "node", "left").select(
        "node", "sig", F.coalesce("label", "node").alias("label")
    )
    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs).cast("long")))
    known = stored(known, "known")
    rows = stored(
        _descend(known.select(roots.alias("path"), "node", "sig")).join(known.drop("sig"), "node"), "paths"
    )
    found = None
    for depth in range(1, MAX_DEPTH + 1):
        parts = rows.groupBy("path", "label").agg(F.count("*").alias("n"))
        sizes = stored(
            parts.groupBy("path").agg(
                F.sum("n").alias("size"), F.max("n").alias("most"),
                F.max_by("label", F.struct("n", "label")).alias("main"),
            ).where(F.col("most") < F.col("size")),
            "sizes",
        )
        ready = (F.col("size") - F.col("most") <= SMALL) | F.lit(depth == MAX_DEPTH)
        placed = rows.join(sizes, "path")
        edges = stored(_compared(_blocks_of(placed.where(ready)), classes), "wave")
        found = edges if found is None else found.union(edges)
        large = stored(placed.where(~ready).select("path", "node"), "large")
        discard(rows)
        discard(sizes)
        if large.isEmpty():
            break
        rows = stored(
            _descend(large.join(known.drop("label"), "node")).join(known.drop("sig"), "node"), "paths"
        )
        discard(large)
    return found


def _blocks_of(placed: DataFrame) -> DataFrame:
    """Blocks of buckets: the largest linked part is dealt out, and all others go to every block,
    so each pair that is not linked meets in one."""
    blocks = F.ceil(F.col("size") / SMALL).cast("long")
    own = F.array(F.pmod(F.xxhash64("node"), blocks))
    everywhere = F.sequence(F.lit(0).cast("long"), blocks - 1)
    block = F.explode(F.when(F.col("label") == F.col("main"), own).otherwise(everywhere))
    dealt = placed.select("path", "node", "label", block.alias("block"))
    return dealt.select(F.xxhash64("path", "block").alias("bucket"), "node", "label")


# -- exact comparison ----------------------------------------------------------------


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs, through slices of their incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(place, minlength=len(tokens)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    width = 4096
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(place, [lo, lo + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], place[a:b] - lo] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def _verified(rows):
    """From rows (pair of blocks, side, node, n_texts, set), sorted by the pair: links and edges."""

    def compare(group):
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in group]
        sizes = np.array([len(s) for s in sets])
        inter = intersections(sets)
        union = sizes[:, None] + sizes[None, :] - inter
        near = inter * SIMILARITY[1] >= union * SIMILARITY[0]
        np.fill_diagonal(near, False)
        side = np.array([r["side"] for r in group])
        if side.any():  # two blocks: only pairs across count here
            near &= side[:, None] != side[None, :]
        links = near @ np.array([r["n_texts"] for r in group], np.int64)
        for i in np.flatnonzero(links):
            yield group[i]["node"], None, int(links[i])
        for i, j in _star_edges(near):
            yield group[i]["node"], group[j]["node"], 0

    group: list = []
    for row in rows:
        if group and group[0]["pair"] != row["pair"]:
            yield from compare(group)
            group = []
        group.append(row)
    if group:
        yield from compare(group)


def _shingle_rows(batches):
    for batch in batches:
        sets = [shingle_set(t, WORDS) for t in texts(batch.column(1))]
        yield pa.record_batch(
            [batch.column(0), pa.array([digest(s) for s in sets], pa.binary()),
             pa.array([s.tobytes() for s in sets], pa.binary())],
            ["first", "node", "shingles"],
        )


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc`` is among ``ids``.

    A bit set of the ids' hashes, of a fixed size and therefore broadcast, keeps most other
    texts out of the shuffle of the join.
    """
    place = F.pmod(F.xxhash64("doc"), F.lit(ID_BITS))
    bit = F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bits")
    words = ids.withColumn("place", place).select(*bit).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = stored(words, "id-bits")
    near = (
        docs.withColumn("place", place).withColumn("word", F.shiftright("place", 6))
        .join(F.broadcast(words), "word")
        .where(F.expr("(shiftright(bits, cast(place & 63 as int)) & 1) = 1"))
    )
    return near.select("doc", "text").join(ids, "doc", "left_semi")


def _exact(docs: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, other, n_links) from all pairs within the candidate components."""
    members = stored(
        labels.join(classes.select("node", "first", "n_texts", "n"), "node"), "members"
    )
    totals = stored(
        members.groupBy("label").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")), "totals"
    )
    blocks = F.greatest(F.ceil(F.col("size") / SMALL), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    # The text of each member is that of a row with its smallest id; the digest tells which.
    wanted = with_ids(docs, members.select(F.col("first").alias("doc")).distinct())
    sets = wanted.select("doc", "text").mapInArrow(_shingle_rows, "first long, node binary, shingles binary")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
    dealt = (
        members.join(totals.select("label", blocks.alias("blocks")), "label")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
            (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "n_texts",
        )
    )
    return verified_pairs(dealt.join(stored(sets, "sets"), "node"))


def verified_pairs(rows: DataFrame) -> DataFrame:
    """(node, other, n_links) from rows (pair, side, node, n_texts, shingles).

    All nodes of a pair of blocks are compared with each other; where there are two sides, only
    across. Links are counted in rows without ``other``, and connected nodes are edges in the rest.
    """
    sorted_rows = rows.repartition("pair").sortWithinPartitions("pair")
    # Sets may be long: an RDD hands rows over by bytes, Arrow by number.
    return rows.sparkSession.createDataFrame(
        sorted_rows.rdd.mapPartitions(_verified), "node binary, other binary, n_links long"
    )


def near_classes(docs: DataFrame, *, recall: float = RECALL, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links) for every row of ``docs``.

    ``class_id`` is the smallest id among the documents connected by links of similarity 0.8 or
    more, ``n_links`` the number of different other texts linked to the text itself.
    """
    source = small_batches(docs).select(id_or_lowest(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    marks = stored(source.mapInArrow(_marks, "doc long, node binary, body binary, n long, sig binary"), "marks")
    classes = _classes(marks)
    full = classes.where(F.col("n") > 0)
    wave = _first_wave(full)
    labels = stored(components(wave), "labels")
    more = _second_wave(full, labels, runs_for(recall, SIMILARITY[0] / SIMILARITY[1]))
    labels = stored(components(wave.union(more)), "labels")
    found = stored(_exact(source, full, labels), "found")
    groups = stored(components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))), "groups")
    links = found.where("other is null").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    placed = (
        classes.select("node", "first", "n_texts").join(groups, "node", "left").join(links, "node", "left")
        .select("node", "first", F.coalesce("label", "node").alias("label"),
                (F.coalesce("n_links", F.lit(0)) + F.col("n_texts") - 1).alias("n_links"))
    )
    placed = stored(placed, "placed")
    heads = placed.groupBy("label").agg(F.min("first").alias("class_id"))
    by_node = stored(placed.join(heads, "label").select("node", "class_id", "n_links"), "by-node")
    return marks.select("doc", "node").join(by_node, "node").select(
        id_back("doc").alias(id_col), id_back("class_id").alias("class_id"), "n_links"
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the first of their class; rows of one id stay or go together."""
    doc = free_name(docs, "__doc")
    found = near_classes(docs, id_col=id_col, text_col=text_col)
    heads = found.where(F.col(id_col).eqNullSafe(F.col("class_id"))).select(id_or_lowest(id_col).alias(doc)).distinct()
    return docs.withColumn(doc, id_or_lowest(id_col)).join(heads, doc, "left_semi").select(*[f"`{c}`" for c in docs.columns])
