"""Spelling variant grouping with a dictionary of trie-node pairs.

Every prefix of a word is a node of a forward trie and every suffix one of a reversed trie. Nodes
are numbered: in the sorted list of words the ones with a given prefix stand together, so a node's
number is the rank of the first of them with the prefix's length. A word skipped at position i gives
the pair (node of what is before i, node of what is behind i); a word split at i, into which a letter
could be inserted, the pair of both its sides. Words that meet in a pair of integers are neighbours,
and all neighbours meet:

* two skips of one pair differ in the skipped letter: a replacement;
* a skip and a split of one pair differ by that letter: an insertion or deletion. Equal letters in a
  row would give it several times; only the skip of the last of them counts.

A pair holds at most one word for each letter of the alphabet and one split, so none is large, and no
string is compared. Sorted words are numbered in ranges of bounded size; only the stack of nodes that
one range hands to the next goes through the driver.

Defined cases: a null text has no words; a null id is written as an empty one. Rows are counted one by
one, repeated ids included. An empty table gives no words. A text without blanks is one long word and
costs time and memory in proportion to its length. Among near words of equal counts the smallest in
code-point order is the form. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import discard, small_batches, stored

MIN_CHARS, MIN_COUNT = 6, 5
#: A word gives way to a near word that is so many times as frequent.
FACTOR = 5
#: Words in one range of the sorted list, and words a task counts before it hands them on.
RANGE_WORDS = 20_000
HELD_WORDS = 200_000

#: Latin-1 bytes: A-Z in lower case, a-z and 0xC0-0xFF as they are, blanks for everything else.
_LETTERS = bytes(
    i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256)
)


# -- counting words ------------------------------------------------------------------


def words_of(text: str, doc: str, min_chars: int, typo_every: int | None) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences); one word in ``typo_every`` by hash lacks a letter."""
    seed = crc32(f"{doc}:".encode())
    for word, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(word) < min_chars:
            continue
        if typo_every:
            mark = crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
            if mark % typo_every == 0:
                at = mark % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < min_chars:
                    continue
        yield word, n


def _counted(min_chars: int, typo_every: int | None) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def batch_of() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.record_batch([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(text.as_py() or "", doc or "", min_chars, typo_every):
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield batch_of()
                    held.clear()
        yield batch_of()

    return count


def word_counts(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                typo_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, with their occurrences over all texts.

    With ``typo_every`` a letter is missing from those runs of a document whose CRC-32 of
    ``<id>:<run>`` that number divides, which gives a corpus with known variants.
    """
    texts = small_batches(docs).select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    partial = texts.mapInArrow(_counted(min_chars, typo_every), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- numbering trie nodes --------------------------------------------------------------


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _stacks(words: list[str], first: int, carried: list[int]) -> Iterator[tuple[int, list[int]]]:
    """(rank, ranks of the first words with each prefix of 1, 2, ... letters) of sorted words.

    ``carried`` has these ranks for the prefixes that the first word shares with earlier ranges.
    """
    stack, before = carried, None
    for rank, word in enumerate(words, first):
        if before is not None:
            stack = stack[: shared(before, word)]
        stack = stack + [rank] * (len(word) - len(stack))
        yield rank, stack
        before = word


def _ends(part: pa.Table) -> pa.Table:
    """What the next ranges need of a range: its size, its ends, and the stack of its last word."""
    words = sorted(part["word"].to_pylist())
    for _, stack in _stacks(words, 0, []):
        last = stack
    return pa.table({
        "part": part["part"][:1], "n": pa.array([len(words)], pa.int64()), "first": [words[0]], "last": [words[-1]],
        "stack": pa.array([last], pa.list_(pa.int64())),
    })


def _starts(ranges: list) -> dict[int, tuple[int, list[int]]]:
    """The first rank of each range, and the ranks of the nodes that earlier ranges hand to it."""
    starts, at, stack, before = {}, 0, [], ""
    for r in sorted(ranges, key=lambda r: r["part"]):
        carried = stack[: shared(before, r["first"])]
        starts[r["part"]] = at, carried
        # Nodes of the first word that were carried in keep their number in the last word's stack.
        own = shared(r["first"], r["last"])
        stack = [
            carried[i] if i < min(len(carried), own) else at + rank for i, rank in enumerate(r["stack"])
        ]
        at, before = at + r["n"], r["last"]
    return starts


def with_nodes(words: DataFrame, count: int, longest: int) -> DataFrame:
    """``words`` with their rank in code-point order and the number of the node of every prefix.

    ``word`` is unique. A node's number is made of the rank of the first word that has it and its
    depth; prefixes go from the empty one to the whole word.
    """
    n_parts = max(1, -(-count // RANGE_WORDS))
    placed = stored(
        words.repartitionByRange(n_parts, "word").withColumn("part", F.spark_partition_id().cast("long")), "ranges"
    )
    # One row for each RANGE_WORDS words.
    ends = placed.select("part", "word").groupBy("part").applyInArrow(
        _ends, "part long, n long, first string, last string, stack array<long>"
    )
    starts, span = _starts(ends.collect()), longest + 1
    names = words.columns

    def number(part: pa.Table) -> pa.Table:
        part = part.sort_by("word")
        first, carried = starts[part["part"][0].as_py()]
        ranks, nodes = [], []
        for rank, stack in _stacks(part["word"].to_pylist(), first, carried):
            ranks.append(rank)
            nodes.append([0] + [r * span + depth for depth, r in enumerate(stack, 1)])
        made = part.select(names)
        made = made.append_column("rank", pa.array(ranks, pa.int64()))
        return made.append_column("nodes", pa.array(nodes, pa.list_(pa.int64())))

    kinds = ", ".join(f"{name} {kind}" for name, kind in words.dtypes)
    return placed.groupBy("part").applyInArrow(number, f"{kinds}, rank long, nodes array<long>")


# -- neighbours ----------------------------------------------------------------------------

#: What a word is in a pair: split, skipped, or skipped at the last of equal letters in a row.
SPLIT, SKIP, LAST_SKIP = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """(before, behind, n, id, kind) for words (id, word, n, prefixes, suffixes)."""
    size = F.length("word")
    letters = F.split("word", "")

    def pair(i: Column, behind: Column, kind: Column) -> Column:
        return F.struct(
            F.element_at("prefixes", i + 1).alias("before"), F.element_at("suffixes", behind + 1).alias("behind"),
            kind.alias("kind"),
        )

    splits = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, size - i, F.lit(SPLIT)))
    skips = F.transform(
        letters,
        lambda letter, i: pair(
            i, size - i - 1,
            F.when(F.try_element_at("letters", i + 2).eqNullSafe(letter), SKIP).otherwise(LAST_SKIP),
        ),
    )
    return words.withColumn("letters", letters).select("id", "n", F.inline(F.concat(splits, skips)))


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best: n and minus id of the most frequent near word) of words that have any."""
    met = (
        node_pairs(words).groupBy("before", "behind")
        # At most one word for each letter, and one split.
        .agg(F.collect_list(F.struct("n", "id", "kind")).alias("met"))
        .where(F.size("met") > 1)
    )

    def near(x: Column, y: Column) -> Column:
        both_skip = (x["kind"] != SPLIT) & (y["kind"] != SPLIT)
        return (x["id"] != y["id"]) & (both_skip | (x["kind"] + y["kind"] == LAST_SKIP))

    def seen(x: Column) -> Column:
        return F.struct(
            x["id"].alias("id"),
            F.transform(
                F.filter("met", lambda y: near(x, y)), lambda y: F.struct(y["n"].alias("n"), (-y["id"]).alias("place"))
            ).alias("others"),
        )

    each = met.select(F.inline(F.transform("met", seen))).where(F.size("others") > 0)
    return each.groupBy("id").agg(
        F.sum(F.size("others")).cast("long").alias("n_near"), F.max(F.array_max("others")).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for (id, form): forms followed to the last, twice as far in every round.

    Counts rise by FACTOR with each step, so there are few rounds.
    """
    reached = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("further"))
        longer = stored(reached.join(ahead, "root", "left").select("id", "root", "further"), "roots")
        discard(reached)
        if longer.where(F.col("further").isNotNull()).isEmpty():
            return longer.select("id", "root")
        reached = stored(longer.select("id", F.coalesce("further", "root").alias("root")), "roots")
        discard(longer)


def spelling_variants(words: DataFrame, *, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words (word, n), each of them once.

    Near words differ by one inserted, deleted or replaced code point. ``form`` is the most frequent
    of them, if it is ``factor`` times as frequent; ``root`` the last form of forms.
    """
    counted = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    size = counted.agg(F.count("*").alias("n"), F.max(F.length("word")).alias("longest")).first()
    count, longest = size["n"], size["longest"] or 0
    forward = stored(
        with_nodes(counted, count, longest).select(F.col("rank").alias("id"), "word", "n", F.col("nodes").alias("prefixes")),
        "forward",
    )
    discard(counted)
    turned = forward.select("id", F.reverse("word").alias("word"))
    backward = with_nodes(turned, count, longest).select("id", F.col("nodes").alias("suffixes"))
    near = stored(near_words(forward.join(backward, "id")), "near")
    words = forward.select("id", "word", "n")

    chosen = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= factor * F.col("n"), F.col("best")).alias("best"),
    )
    forms = chosen.where(F.col("best").isNotNull()).select("id", (-F.col("best.place")).alias("form"))
    named = words.select(F.col("id").alias("other"), F.col("word").alias("text"))
    led = (
        forms.join(roots(forms), "id")
        .join(named.withColumnsRenamed({"other": "form", "text": "form_word"}), "form")
        .join(named.withColumnsRenamed({"other": "root", "text": "root_word"}), "root")
    )
    return chosen.join(led.select("id", "form_word", "root_word"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        F.col("best.n").alias("form_n"),
    )
