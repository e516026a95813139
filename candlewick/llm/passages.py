"""Substring dedup: paragraphs and passages that repeat across documents.

Two kinds of stretches are looked at. Lines of 20 words or more are paragraphs: MinHash bands of
their five-word shingles, with as many bands as the target recall takes, make similar ones
collide, and all pairs that collide are compared by exact Jaccard similarity. Passages may also
start in the middle of a line. For these, windows of 32 words start at anchors, the shingle with
the least hash among any 20 neighbours. Whatever the surroundings, two copies of a passage of
more than 50 words share an anchor with its whole window, and equal windows are repeats. The
first shared window starts at most 19 words behind the passage's start, the last ends as many before
its end. Where a run of windows that go begins or ends, the 19 words beyond are compared with those of
the window's first copy; copies that part from it at some word, but alike, are a group of their own
and compared with the first of these, and so on. Removals thus reach from the first equal word to the
last. Words beyond windows are compared by 32 bits of their hashes.

Repeats are clustered by connected components. The first stretch of a cluster (smallest id, then
position) stays, all others are removals, further copies inside the keeping document included;
overlapping removals of a document are merged. Clusters within a single document are no repeats.
Documents that share a stretch, directly or through others, are one class. Which stretches are
shared with which keeper is told by ``members``, as a hot passage makes a class very wide.

Defined cases: null and empty texts have no stretches, and an empty table has no rows. Rows of one id
and one text are one document; different texts of one id, null or not, are different ones, told apart
by a hash. A null id is the smallest. Texts may be of any length; one is looked at as a whole. Offsets
are code points, ends exclusive. Other columns, whatever their names, are passed on, and a clashing
name for the result is an error.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from candlewick.llm.common import discard, free_name, id_back, id_or_lowest, small_batches, stored, texts
from candlewick.llm.components import components
from candlewick.llm.jaccard import BLOCK_SHINGLES, SMALL, verified_pairs
from candlewick.llm.shingles import WORDS, digest, mixed, signatures, window_codes, word_codes

PARAGRAPH = 20
WINDOW = 32
NEIGHBOURS = 20
SIMILARITY = 0.8
RECALL = 0.99
BAND_ROWS = 3
#: At most so many bits mark the keys of a set: 32 MB.
MOST_BITS = 1 << 28
#: Texts are looked at together up to so many bytes; a longer one is by itself.
CHUNK_BYTES = 1 << 18


def bands_for(recall: float, similarity: float, rows: int = BAND_ROWS) -> int:
    """Bands after which a pair of this similarity has collided with the given chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _blanks(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


class Words:
    """Words of texts: where they are in their text, in code points, and codes of them in lower case."""

    def __init__(self, texts: list[bytes]):
        text = b"\n".join([*texts, b""])  # so no word or line goes on in the next text
        data = np.frombuffer(text, np.uint8)
        before = np.cumsum([0, *(len(t) + 1 for t in texts)])  # bytes before each text
        edge = np.flatnonzero(np.diff(_blanks(data), prepend=True))
        first, last = edge[::2], edge[1::2]
        #: Words before each text, and the text of each word.
        self.first = np.searchsorted(first, before)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.start, self.end = first - before[self.text], last - before[self.text]
        if not text.isascii():
            more = np.cumsum(np.r_[0, (data & 0xC0) == 0x80])  # bytes before each byte that start no code point
            there = more[before][self.text]
            self.start -= more[first] - there
            self.end -= more[last] - there
        self.codes = word_codes(text.lower().split())
        #: Those that start at each word, also if they end in the next text.
        self.shingles = window_codes(self.codes, WORDS)
        #: Words before the end of each line.
        self.line_ends = np.searchsorted(first, np.flatnonzero(data == 0x0A))


def anchors(words: Words) -> np.ndarray:
    """Words at which windows start: shingles with the least hash among their neighbours, the first of equal ones."""
    least, at, width = words.shingles, np.arange(len(words.shingles)), 1
    while width < NEIGHBOURS:
        step = min(width, NEIGHBOURS - width)
        right = least[step:] < least[:-step]
        at, least = np.where(right, at[step:], at[:-step]), np.where(right, least[step:], least[:-step])
        width += step
    long = np.diff(words.first) >= WINDOW
    last = np.repeat(words.first[1:], np.diff(words.first))  # words up to the end of the word's text
    within = np.arange(len(at)) + NEIGHBOURS + WORDS - 1 <= last[: len(at)]
    at = at[within & long[words.text[: len(at)]]]
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]  # they never go back
    return at[at + WINDOW <= last[at]]


#: Odd numbers whose powers weigh the words of a window, once for each half of its key.
_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_keys(codes: np.ndarray, at: np.ndarray, width: int | np.ndarray = WINDOW) -> list[np.ndarray]:
    """128 bits, as two numbers, for the words of each window: weighted sums from running totals."""
    keys = []
    for base in _BASES:
        inverse = np.uint64(pow(int(base), -1, 2**64))
        total = np.r_[np.uint64(0), np.cumsum(codes * _powers(base, len(codes)))]
        inside = total[at + width] - total[at]
        keys.append(mixed(inside * _powers(inverse, len(codes))[at]).view(np.int64))
    return keys


_SCHEMA = "doc long, code long, one long, two long, start int, end int, n int, bands array<long>"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))


def _paragraph_sets(words: Words):
    """(text, start, end, one, two) of each line of PARAGRAPH words or more, its shingles, which follow one
    another in one array, and their bounds in it."""
    first, last = np.r_[0, words.line_ends[:-1]], words.line_ends
    long = last - first >= PARAGRAPH
    first, last = first[long], last[long]
    n = last - first - WORDS + 1
    bounds = np.r_[0, np.cumsum(n)]
    shingles = words.shingles[np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], n)]
    for a, b in pairwise(bounds.tolist()):
        shingles[a:b].sort()
    new = np.diff(shingles, prepend=np.uint64(0)) != 0
    new[bounds[:-1]] = True
    bounds, shingles = np.r_[0, np.cumsum(new)][bounds], shingles[new]
    keys = b"".join([digest(shingles[a:b]) for a, b in pairwise(bounds.tolist())])
    one, two = np.frombuffer(keys, ">i8").reshape(-1, 2).T.astype(np.int64)
    places = words.start[first].astype(np.int32), words.end[last - 1].astype(np.int32)
    return (words.text[first], *places, one, two), shingles, bounds


def _chunks(batch: pa.RecordBatch):
    """(rows, words) of the texts of a batch, up to CHUNK_BYTES of them at a time."""
    found, size, first = [], 0, 0
    for k, text in enumerate(texts(batch.column("text"))):
        if found and size + len(text) > CHUNK_BYTES:
            yield slice(first, k), Words(found)
            found, size, first = [], 0, k
        found.append(text)
        size += len(text)
    if found:
        yield slice(first, first + len(found)), Words(found)


def _stretches(bands: int):
    """Windows, without bands, and paragraphs of each text."""
    names = ["doc", "code", "one", "two", "start", "end", "n", "bands"]

    def find(batches):
        for batch in batches:
            found, lines, keys = [], [], []
            for rows, words in _chunks(batch):
                doc, code = (batch.column(c).to_numpy()[rows] for c in ("doc", "code"))
                at = anchors(words)
                of, (one, two) = words.text[at], window_keys(words.codes, at)
                start, end = words.start[at].astype(np.int32), words.end[at + WINDOW - 1].astype(np.int32)
                found.append((doc[of], code[of], one, two, start, end))
                (of, start, end, one, two), shingles, bounds = _paragraph_sets(words)
                if len(of):
                    lines.append((doc[of], code[of], one, two, start, end, np.diff(bounds).astype(np.int32)))
                    keys.append(_band_keys(signatures(shingles, bounds[:-1], bands * BAND_ROWS), bands))
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                lacking = [pa.nulls(len(columns[0]), kind) for kind in _KINDS[6:]]
                yield pa.record_batch([*columns, *lacking], names)
            if lines:
                columns = [pa.array(np.concatenate(c)) for c in zip(*lines, strict=True)]
                ends = pa.array(np.arange(0, bands * len(columns[0]) + 1, bands, dtype=np.int32))
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys).reshape(-1))))
                yield pa.record_batch(columns, names)

    return find


def _band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """The keys of the bands of each signature."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), bands, BAND_ROWS)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for k in range(BAND_ROWS):
        keys = mixed(keys ^ parts[:, :, k])
    return keys.view(np.int64)


def _node() -> Column:
    """The digest that the numbers ``one`` and ``two`` were read from."""
    return F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("one", "two")]))


def _set_rows(shared):
    """The sets of paragraphs to compare. ``shared`` has the keys of their documents, and those xor the first
    numbers of the paragraphs; a few others slip through."""

    def find(batches):
        marks = shared.value
        for batch in batches:
            part = batch.filter(pa.array(_among(batch.column("key").to_numpy(), marks)))
            rows = []
            for at, words in _chunks(part):
                (of, _, _, one, two), shingles, bounds = _paragraph_sets(words)
                for k in np.flatnonzero(_among(one ^ part.column("key").to_numpy()[at][of], marks)).tolist():
                    rows.append((one[k], two[k], shingles[bounds[k] : bounds[k + 1]].tobytes()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, ["one", "two", "shingles"])

    return find


def _similar(source: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(node, label) of paragraphs that are linked by similarity, through bands and exact comparison.

    Only the sets of paragraphs that collide are made, from the texts of their first documents, which are
    marked in a set of bits so that no text is shuffled.
    """
    kinds = stored(
        paragraphs.groupBy("one", "two").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("one", "two", "doc", "n", "bands"),
        "paragraph-kinds",
    )
    rows = kinds.select("one", "two", "doc", "n", F.explode("bands").alias("band"))
    sizes = stored(
        rows.groupBy("band").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1"),
        "bands",
    )
    blocks = F.greatest(F.ceil(F.col("size") / SMALL), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    placed = stored(rows.join(sizes.select("band", blocks.alias("blocks")), "band"), "collisions")
    dealt = (
        placed.withColumn("block", F.pmod(F.xxhash64("one", "two"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
            (F.col("block") > F.col("other")).cast("int").alias("side"), "one", "two", F.lit(1).alias("n_texts"),
        )
    )
    key = F.xxhash64("doc")
    marks = _bit_set(placed.select(F.explode(F.array(key, key.bitwiseXOR(F.col("one")))).alias("key")))
    shared = source.sparkSession.sparkContext.broadcast(marks)
    sets = stored(
        source.select("text", key.alias("key")).mapInArrow(_set_rows(shared), "one long, two long, shingles binary")
        .groupBy("one", "two").agg(F.first("shingles").alias("shingles")),
        "paragraph-sets",
    )
    found = stored(
        verified_pairs(dealt.join(sets, ["one", "two"]).select("pair", "side", _node().alias("node"), "n_texts", "shingles")),
        "paragraph-links",
    )
    for table in (kinds, sizes, placed, sets):
        discard(table)
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    return components(edges)


def _place(*more: str) -> Column:
    return F.struct("doc", "code", "start", "end", *more)


def _document(of: str = "") -> Column:
    return F.struct(F.col(f"{of}doc").alias("doc"), F.col(f"{of}code").alias("code"))


def _across(stretches: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(key, doc, code, start, end, first) of stretches whose key occurs in two documents or more;
    ``first`` is (doc, code, start, end) of the stretch that stays.

    The keys found are written out, so Spark can split the rows of a common one.
    """
    repeated = stored(
        stretches.groupBy(*keys).agg(F.min(_place()).alias("first"), F.max(_document()).alias("high"))
        .where(_document("first.") < F.col("high")).select(*keys, "first"),
        name,
    )
    return stretches.join(repeated, keys).select(keys[0], "doc", "code", "start", "end", "first")


def _likely(windows: DataFrame) -> DataFrame:
    """``windows`` without nearly all whose key occurs in one document only.

    The keys are counted by one of their numbers and a hash of the document, so that rows stay short, and
    marked in a set of bits. What slips through is left to the exact comparison behind this.
    """
    several = (
        windows.select("one", F.xxhash64("doc", "code").alias("who"))
        .groupBy("one").agg(F.min("who").alias("low"), F.max("who").alias("high"))
        .where("low < high").select(F.col("one").alias("key"))
    )
    shared = windows.sparkSession.sparkContext.broadcast(_bit_set(several))

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_among(batch.column("one").to_numpy(), shared.value)))

    return windows.mapInArrow(keep, windows.schema)


def _removal() -> Column:
    """The span of a stretch that goes, or null; it leaves alone a first one that it overlaps."""
    own = _document() == _document("first.")
    start = F.when(own, F.greatest("start", "first.end")).otherwise(F.col("start"))
    goes = (~own | (F.col("start") != F.col("first.start"))) & (start < F.col("end"))
    return F.when(goes, F.struct(start.alias("start"), "end"))


def _places(key, bits: int) -> tuple:
    """The two places of a 64-bit key, a column or an array, in a set of that many bits."""
    if isinstance(key, Column):
        return key.bitwiseAND(bits - 1), F.shiftrightunsigned(key, 32).bitwiseAND(bits - 1)
    key = key.view(np.uint64)
    return key & np.uint64(bits - 1), (key >> np.uint64(32)) & np.uint64(bits - 1)


def _bit_set(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of ``key``, bounded in size: it has every key, and few others."""
    keys = stored(keys.distinct(), "edge-keys")
    bits = min(MOST_BITS, max(64, 1 << (32 * keys.count()).bit_length()))
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("place"))
    words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _among(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    places = _places(keys, 64 * len(marks))
    return np.logical_and(*[(marks[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)) == 1 for p in places])


_BESIDE = (
    "doc long, code long, one long, two long, left boolean, start int, end int, words array<int>, reach array<int>"
)


def _inside_runs(at: np.ndarray, one: np.ndarray, step: int) -> np.ndarray:
    """Whether two equal windows, each overlapping or touching the next, lie on one side of a window.

    ``step`` is 1 for the side before it. This is so inside a run of words that repeat with a short period.
    """
    order = np.argsort(one, kind="stable")[::step]
    near = (one[order][1:] == one[order][:-1]) & (np.abs(np.diff(at[order])) <= WINDOW)
    inside = np.zeros(len(at), bool)
    inside[order[2:][near[1:] & near[:-1]]] = True
    return inside


def _beside(shared):
    """Windows with the words on one side of them: up to NEIGHBOURS - 1, nearest first, and how far
    each reaches beyond the window.

    ``shared`` has the documents to look at and the windows: their first numbers for words before,
    the complements for words behind. Others that slip through cost time and change nothing.
    """

    def find(batches):
        marks, more = shared.value, np.arange(1, NEIGHBOURS)
        for batch in batches:
            part = batch.filter(pa.array(_among(batch.column("key").to_numpy(), marks)))
            found, lists = [], []
            for rows, words in _chunks(part):
                doc, code = (part.column(c).to_numpy()[rows] for c in ("doc", "code"))
                at = anchors(words)
                text, (one, two) = words.text[at], window_keys(words.codes, at)
                first, last = words.first[text], words.first[text + 1]
                apart = at + text * (WINDOW + 1)  # so windows of different texts never touch
                short = (words.codes >> np.uint64(32)).astype(np.uint32).view(np.int32)
                start, end = words.start[at], words.end[at + WINDOW - 1]
                for left, key in ((True, one), (False, ~one)):
                    of = np.flatnonzero(_among(key, marks) & ~_inside_runs(apart, one, 1 if left else -1))
                    beside = at[of, None] - more if left else at[of, None] + WINDOW - 1 + more
                    inside = (beside >= first[of, None]) & (beside < last[of, None])
                    beside, owner = beside[inside], np.repeat(of, inside.sum(axis=1))
                    reach = start[owner] - words.start[beside] if left else words.end[beside] - end[owner]
                    found.append((
                        doc[text[of]], code[text[of]], key[of], two[of], np.full(len(of), left),
                        start[of].astype(np.int32), end[of].astype(np.int32),
                    ))
                    lists.append((inside.sum(axis=1), short[beside], reach.astype(np.int32)))
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                sizes, codes, reach = (np.concatenate(c) for c in zip(*lists, strict=True))
                ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                columns += [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (codes, reach)]
                yield pa.record_batch(columns, ["doc", "code", "one", "two", "left", "start", "end", "words", "reach"])

    return find


def _alike(rows: DataFrame) -> DataFrame:
    """``rows`` of groups in two documents or more, with the first of the group and ``k``, the number of
    nearest words equal to those of the first."""
    firsts = stored(
        rows.groupBy("one", "two").agg(F.min(_place("words", "reach")).alias("first"), F.max(_document()).alias("high"))
        .where(_document("first.") < F.col("high")).drop("high"),
        "first-besides",
    )
    parting = F.array_position(F.zip_with("words", "first.words", lambda x, y: ~x.eqNullSafe(y)), True)
    joined = rows.join(firsts, ["one", "two"])
    made = stored(
        joined.withColumn("k", F.when(parting == 0, F.size("words")).otherwise(parting - 1).cast("int"))
        .withColumn("first", F.col("first").dropFields("words")),
        "besides-alike",
    )
    discard(firsts)
    return made


def _reaching(alike: DataFrame) -> DataFrame:
    """(doc, code, start, end, first): the windows made longer by the words that are equal.

    A copy in the document of the first one counts as far as other documents go.
    """
    own = _document() == _document("first.")
    others = alike.where(~own)
    most = others.groupBy("one", "two").agg(F.max("k").alias("most"))
    kept = alike.where(own).join(most, ["one", "two"]).withColumn("k", F.least("k", "most")).drop("most")
    left, k = F.col("left"), F.col("k")

    def place(of: str) -> list[Column]:
        start, end, reach = F.col(f"{of}start"), F.col(f"{of}end"), F.element_at(F.col(f"{of}reach"), k)
        return [
            F.when(left, start - reach).otherwise(start).alias("start"),
            F.when(left, end).otherwise(end + reach).alias("end"),
        ]

    first = F.struct(F.col("first.doc").alias("doc"), F.col("first.code").alias("code"), *place("first."))
    return others.unionByName(kept).where("k > 0").select("doc", "code", *place(""), first.alias("first"))


def _parted(alike: DataFrame) -> DataFrame:
    """Copies that part from the first of their group, grouped by their words up to that place."""
    prefix = F.slice("words", 1, F.col("k") + 1)
    return alike.where(F.size("words") > F.col("k")).select(
        "doc", "code", F.xxhash64("one", prefix).alias("one"), F.xxhash64(prefix, "two").alias("two"),
        "left", "start", "end", "words", "reach",
    )


def _extended(source: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, code, start, end, first) of windows with the equal words next to them, from repeated ``windows``.

    Within a run of overlapping windows that go, only the outermost need it. All copies of such a
    window are extended, so the first one of each length is known; but of equal windows that overlap, as
    where few words repeat over and over, the outermost two: others are covered by these and have no words
    beside them that these lack. Each round takes one word more at
    least, so there are at most NEIGHBOURS of them, over fewer and fewer rows.
    """
    by_place = W.partitionBy("doc", "code").orderBy("start", "end")
    outer = (
        windows.where(_removal().isNotNull())
        .withColumn("before", F.lag("end").over(by_place)).withColumn("behind", F.lead("start").over(by_place))
        .select(
            F.when(F.col("before").isNull() | (F.col("before") < F.col("start")), F.col("one")).alias("left"),
            F.when(F.col("behind").isNull() | (F.col("behind") > F.col("end")), F.bitwise_not("one")).alias("right"),
        )
    )
    keys = outer.select(F.explode(F.array("left", "right")).alias("key")).where("key is not null")
    marks = _bit_set(keys.union(windows.select(F.xxhash64("doc", "code").alias("key"))))
    shared = source.sparkSession.sparkContext.broadcast(marks)
    rows = stored(
        source.select("doc", "code", "text", F.xxhash64("doc", "code").alias("key")).mapInArrow(_beside(shared), _BESIDE),
        "besides",
    )
    found = []
    while True:
        alike = _alike(rows)
        discard(rows)
        found.append(stored(_reaching(alike), "longer-windows"))
        rows = stored(_parted(alike), "parted")
        discard(alike)
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found)


_RESULT = (
    "n_stretches bigint, removed array<struct<start: int, end: int>>, "
    "members array<struct<start: int, end: int, keeper: bigint, keeper_start: int>>"
)
_REMOVED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_MEMBERS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("keeper", pa.int64()), ("keeper_start", pa.int32())])
)


def _joined(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with those of a group that overlap or touch made one: the places of their first ones, given
    the order by group and start, their starts and their ends."""
    upto = np.maximum.accumulate((group << 32) + end)
    first = np.flatnonzero(np.r_[True, (group[1:] << 32) + start[1:] > upto[:-1]][: len(start)])
    last = np.r_[first[1:], len(start)][: len(first)] - 1
    return first, start[first], upto[last] - (group[last] << 32)


def _numbers(*columns: np.ndarray) -> np.ndarray:
    """For sorted rows the number of the group of equal ones each is in."""
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.r_[0, np.cumsum(new)][: len(columns[0])].astype(np.int64)


def _lists(rows: np.ndarray, n: int, kind: pa.ListType, **fields: np.ndarray) -> pa.ListArray:
    """One list of structs for each of ``n`` rows, from items in the order of their rows."""
    values = [pa.array(fields[f.name]).cast(f.type) for f in kind.value_type]
    ends = np.r_[0, np.cumsum(np.bincount(rows, minlength=n))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(values, fields=list(kind.value_type)))


def _merged(spans: pa.Array) -> pa.Array:
    """How many stretches, what goes, and the stretches by keeper: those that lie alike in it are merged."""
    n, flat = len(spans), spans.flatten()
    row = np.repeat(np.arange(n), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    kind, start, end, keeper, code, there = (
        flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64)
        for f in ("kind", "start", "end", "keeper", "code", "keeper_start")
    )
    goes = flat.field("cut").is_valid().to_numpy(zero_copy_only=False)
    cut = flat.field("cut").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    order = np.lexsort((end[goes], cut[goes], row[goes]))
    gone = row[goes][order]
    first, a, b = _joined(gone, cut[goes][order], end[goes][order])
    removed = _lists(gone[first], n, _REMOVED, start=a, end=b)

    shift = there - start
    order = np.lexsort((end, start, shift, code, keeper, row))
    row_, keeper, shift = row[order], keeper[order], shift[order]
    first, a, b = _joined(_numbers(row_, keeper, code[order], shift), start[order], end[order])
    of, keeper, there = row_[first], keeper[first], a + shift[first]
    order = np.lexsort((there, keeper, b, a, of))
    members = _lists(of[order], n, _MEMBERS, start=a[order], end=b[order], keeper=keeper[order], keeper_start=there[order])
    counts = np.bincount(row[kind > 0], minlength=n)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), removed, members], ["n_stretches", "removed", "members"])


def _with_code(docs: DataFrame, id_col: str, text_col: str, doc: str = "doc", code: str = "code") -> DataFrame:
    """``docs`` with the two numbers that name a document: its id and a hash of its text."""
    return docs.withColumns({doc: id_or_lowest(id_col), code: F.xxhash64(F.col(text_col).cast("string"))})


def _name(of: str = "") -> Column:
    """A document as one value: the 16 bytes of its two numbers."""
    return F.unhex(F.concat(*[F.lpad(F.hex(f"{of}{c}"), 16, "0") for c in ("doc", "code")]))


def repeats(docs: DataFrame, *, recall: float = RECALL, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc, code, class_id, n_stretches, removed, members) for documents with stretches that repeat elsewhere.

    ``code`` is the hash of the text, ``class_id`` the smallest id of the documents connected by shared
    stretches, ``removed`` the merged spans that go. ``members`` has the spans of all clusters the document
    is in: where each lies, the document that keeps its first copy (perhaps this one), and where that starts.
    """
    source = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = _with_code(source, "id", "text").select("doc", "code", "text")
    bands = bands_for(recall, SIMILARITY)
    every = stored(source.mapInArrow(_stretches(bands), _SCHEMA), "all-stretches")
    paragraphs, windows = every.where("bands is not null"), every.where("bands is null")
    labels = stored(_similar(source, paragraphs), "paragraph-labels")
    labelled = paragraphs.select("doc", "code", "start", "end", _node().alias("node")).join(labels, "node", "left").select(
        "doc", "code", "start", "end", F.coalesce("label", "node").alias("label")
    )
    kind = lambda df, n: df.select("doc", "code", "start", "end", "first", F.lit(n).alias("kind"))
    alike = stored(kind(_across(labelled, ["label"], "repeated-paragraphs"), 2), "paragraphs")
    likely = stored(_likely(windows.select("doc", "code", "one", "two", "start", "end")), "likely-windows")
    discard(every)
    windows = stored(_across(likely, ["one", "two"], "repeated-windows"), "windows")
    discard(likely)
    found = alike.union(kind(windows, 1)).union(kind(_extended(source, windows), 0))
    links = (
        found.where("kind > 0").where(_document() != _document("first."))
        .select(_name().alias("a"), _name("first.").alias("b"), "doc", F.col("first.doc").alias("keeper"))
    )
    links = stored(links.distinct(), "links")
    labels = stored(components(links.select("a", "b")), "classes")
    # The smallest id of a class is that of a keeper.
    heads = links.join(labels, F.col("b") == F.col("node")).groupBy("label").agg(F.min("keeper").alias("class_id"))
    classes = labels.join(stored(heads, "heads"), "label").select("node", "class_id")
    span = F.struct(
        "kind", "start", "end", F.col("first.doc").alias("keeper"), F.col("first.code").alias("code"),
        F.col("first.start").alias("keeper_start"), _removal()["start"].alias("cut"),
    )
    merge = F.arrow_udf(_merged, f"struct<{_RESULT}>")
    merged = found.groupBy("doc", "code").agg(F.collect_set(span).alias("spans"))
    return (
        merged.select("doc", "code", _name().alias("node"), merge("spans").alias("m")).join(classes, "node", "left")
        .select("doc", "code", F.coalesce("class_id", "doc").alias("class_id"), "m.*")
    )


def marked_repeats(docs: DataFrame, *, recall: float = RECALL, id_col: str = "doc_id",
                   text_col: str = "text", name: str = "repeats") -> DataFrame:
    """``docs`` with a struct: class_id, n_stretches, removed and members, for every row."""
    if free_name(docs, name) != name:
        raise ValueError(f"there is a column {name} already")
    doc, code, mark = (free_name(docs, stem) for stem in ("__doc", "__code", "__mark"))
    found = repeats(docs, recall=recall, id_col=id_col, text_col=text_col)
    marks = found.select(F.col("doc").alias(doc), F.col("code").alias(code), F.struct("class_id", "n_stretches", "removed", "members").alias(mark))
    joined = _with_code(docs, id_col, text_col, doc, code).join(marks, [doc, code], "left")
    m = F.col(mark)
    none = F.array().cast("array<struct<start: int, end: int>>")
    return joined.withColumn(
        name,
        F.struct(
            id_back(F.coalesce(m["class_id"], F.col(doc))).alias("class_id"),
            F.coalesce(m["n_stretches"], F.lit(0)).alias("n_stretches"),
            F.coalesce(m["removed"], none).alias("removed"),
            F.coalesce(
                F.transform(m["members"], lambda s: s.withField("keeper", id_back(s["keeper"]))),
                F.array().cast("array<struct<start: int, end: int, keeper: bigint, keeper_start: int>>"),
            ).alias("members"),
        ),
    ).select(*[f"`{c}`" for c in docs.columns], name)


def _cut(text: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for value, spans in zip(text.to_pylist(), removed.to_pylist(), strict=True):
        parts, at = [], 0
        for span in spans or ():
            parts.append((value or "")[at : span["start"]])
            at = span["end"]
        out.append("".join(parts) + (value or "")[at:])
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, *, recall: float = RECALL, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The documents with their removals cut out of the text."""
    name = free_name(docs, "__repeats")
    cut = F.arrow_udf(_cut, "string")
    marked = marked_repeats(docs, recall=recall, id_col=id_col, text_col=text_col, name=name)
    return marked.withColumn(
        text_col, cut(F.col(text_col).cast("string"), F.col(name)["removed"])
    ).drop(name)
