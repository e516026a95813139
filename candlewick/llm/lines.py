"""Line dedup: drop lines that many documents share.

Lines are exploded from each text, normalised and hashed to 128 bits; documents are counted
per hash; lines over the threshold go, except in the document with the largest id; what is
left is put together by position.

Defined cases: a null or empty text has one empty line. Rows of one id are one document: they
count once, and if it is the largest, all of them keep their lines. A null id counts as the
lowest id. Other columns, whatever their names, are passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import BLANKS, free_name, id_or_lowest, small_batches, stored, texts

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the line without outer white space and with A-Z in lower case; None when short."""
    key = line.strip(BLANKS).lower()  # bytes: only A-Z change
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _line_keys(min_chars: int):
    def keys(batches):
        for batch in batches:
            ids, counts, found = batch.column(0).to_numpy(), [], []
            for text in texts(batch.column(1)):
                own = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                counts.append(len(own))
                found += own
            yield pa.record_batch(
                [pa.array(np.repeat(ids, counts)), pa.array(found, pa.binary())], ["doc", "key"]
            )

    return keys


def _without(min_chars: int):
    result = pa.struct(
        [("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]
    )

    def without(text: pa.Array, dropped: pa.Array) -> pa.Array:
        kept, n_lines, n_dropped = [], [], []
        for value, keys in zip(texts(text), dropped.to_pylist(), strict=True):
            lines = value.split(b"\n")
            gone = set(keys or ())
            left = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            kept.append(b"\n".join(left).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            fields=list(result),
        )

    return F.arrow_udf(without, "text string, n_lines long, n_dropped long")


def shared_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, keys): for each document the hashes of the lines it loses.

    Lines are counted through (key, document) pairs, so a line that a third of all documents
    share is spread over all tasks. The keys over the threshold are written out: the join that
    finds their documents then shuffles both sides, and Spark can split a common key.
    """
    lines = stored(
        small_batches(docs).select(id_or_lowest(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_line_keys(min_chars), "doc long, key binary"),
        "lines",
    )
    over = stored(
        lines.groupBy("key")
        .agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("key", "last"),
        "shared-lines",
    )
    return (
        lines.join(over, "key").where(F.col("doc") < F.col("last"))
        .groupBy("doc").agg(F.collect_set("key").alias("keys"))
    )


def drop_shared_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      id_col: str = "doc_id", text_col: str = "text",
                      counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents with their shared lines dropped from the text.

    ``counts`` names two columns to add: lines before dropping, and lines dropped.
    """
    doc, keys, made = (free_name(docs, stem) for stem in ("__doc", "__keys", "__made"))
    dropped = shared_lines(docs, min_chars=min_chars, min_docs=min_docs, id_col=id_col, text_col=text_col)
    joined = docs.withColumn(doc, id_or_lowest(id_col)).join(
        dropped.select(F.col("doc").alias(doc), F.col("keys").alias(keys)), doc, "left"
    ).withColumn(made, _without(min_chars)(F.col(text_col).cast("string"), F.col(keys)))
    columns = [
        F.col(made)["text"].alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
    ]
    if counts:
        columns += [F.col(made)["n_lines"].alias(counts[0]), F.col(made)["n_dropped"].alias(counts[1])]
    return joined.select(*columns)

