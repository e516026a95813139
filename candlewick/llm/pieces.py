"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model crosses a white space marker or a line feed, so a text falls into chunks
(markers with the word behind them, and single line feeds) whose segmentations do not depend on
each other. A block of texts is cut into chunks, each distinct chunk is segmented and decoded
once by the library, and ids and decoded text are joined back by position. A task keeps what it
has learned for its next blocks; when the table is full it is started anew, which bounds memory
and changes no result.

Defined cases: a null text is empty and has no ids. Texts are never cut short. Each row is
encoded by itself. Other columns are passed on.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import small_batches, texts

MARK = "▁"
TABLE_SIZE = 400_000
BLOCK_BYTES = 8_000_000
GROUP = 256


def check_pieces(pieces: list[str]) -> None:
    """Raise unless the model's pieces allow texts to be cut before markers and at line feeds."""
    crossing = [p for p in pieces if MARK in p.lstrip(MARK) or ("\n" in p and p != "\n")]
    if crossing:
        raise ValueError(f"pieces cross chunk boundaries: {crossing[:5]}")


def _chunk_starts(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where chunks start: at texts, at and behind line feeds, and at blanks behind other bytes."""
    blank, feed = data == 0x20, data == 0x0A
    starts = feed | blank
    starts[1:] &= ~blank[:-1] | feed[1:]
    starts[1:] |= feed[:-1]
    starts[doc_starts] = True
    return np.flatnonzero(starts)


class ChunkTable:
    """Ids (as packed 32-bit numbers) and decoded bytes of distinct chunks."""

    def __init__(self, model_file: str, size: int = TABLE_SIZE):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        check_pieces(self.model.id_to_piece(list(range(self.model.vocab_size()))))
        self.size = size
        #: A line feed after the marker that the library puts in front of every text.
        self.lead = self.model.encode("\n")
        self._empty()

    def _empty(self) -> None:
        self.known: dict[bytes, tuple[bytes, bytes]] = {
            b"\n": (array("i", self.lead[1:]).tobytes(), b"\n")
        }

    def _learn(self, chunks: list[bytes]) -> None:
        """Segment and decode chunks, some hundreds at a time joined by line feeds into one text.

        Its ids between two line feeds are those of one chunk, as no other piece has a line
        feed. Behind a line feed, decoding leaves markers in place.
        """
        for at in range(0, len(chunks), GROUP):
            group = chunks[at : at + GROUP]
            ids = np.array(self.model.encode("\n" + b"\n".join(group).decode()), np.int32)
            ids = ids[len(self.lead) :]
            decoded = self.model.decode(self.lead[1:] + ids.tolist())[1:].encode().split(b"\n")
            ends = [*np.flatnonzero(ids == self.lead[-1]).tolist(), len(ids)]
            packed, start = ids.tobytes(), 0
            for chunk, end, back in zip(group, ends, decoded, strict=True):
                self.known[chunk] = (packed[4 * start : 4 * end], back)
                start = end + 1

    def encode(self, values: list[bytes]) -> tuple[pa.ListArray, pa.Array]:
        """Ids of each text, and their decoding."""
        full = [i for i, x in enumerate(values) if x]
        # The blank in front is the marker that the library puts there; a literal marker is a blank to it.
        marked = [b" " + values[i].replace(MARK.encode(), b" ") for i in full]
        doc_ends = np.cumsum([len(x) for x in marked], dtype=np.int64)
        doc_starts = doc_ends - [len(x) for x in marked]
        buffer = b"".join(marked)
        starts = _chunk_starts(np.frombuffer(buffer, np.uint8), doc_starts.astype(np.int64))
        offsets = np.r_[starts, len(buffer)].astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)]
        ).dictionary_encode()
        distinct, places = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()

        if len(self.known) + len(distinct) > self.size:
            self._empty()
        self._learn([x for x in distinct if x not in self.known])
        found = [self.known[x] for x in distinct]

        # Join back by position: how many ids each chunk of the block has, and which.
        sizes = np.fromiter((len(x) // 4 for x, _ in found), np.int64, len(found))
        first = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(x for x, _ in found), np.int32)
        count = sizes[places]
        upto = np.cumsum(count)
        at = np.repeat(first[places] - (upto - count), count) + np.arange(int(count.sum()))
        last_chunk = np.searchsorted(starts, doc_ends) - 1  # of each text that is not empty
        ends = np.zeros(len(values), np.int64)
        ends[full] = upto[last_chunk] if len(full) else 0
        ends = np.maximum.accumulate(ends)
        ids = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat[at]))

        backs = np.fromiter((len(x) for _, x in found), np.int64, len(found))
        text = pa.array([x for _, x in found], pa.large_binary()).take(pa.array(places))
        upto = np.cumsum(backs[places])
        ends = np.zeros(len(values), np.int64)
        ends[full] = upto[last_chunk] if len(full) else 0
        ends = np.r_[0, np.maximum.accumulate(ends)]
        joined = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(values), [None, pa.py_buffer(ends), text.buffers()[2]]
        )
        # Without the marker put in front.
        return ids, pa.array([x[1:].decode() for x in joined.to_pylist()], pa.string())


def _blocks(values: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about BLOCK_BYTES in all; a longer text is a run by itself."""
    run, size = [], 0
    for value in values:
        if run and size + len(value) > BLOCK_BYTES:
            yield run
            run, size = [], 0
        run.append(value)
        size += len(value)
    yield run


def encoder(model_file: str):
    """A column function: text to struct<ids, decoded>."""
    held: list[ChunkTable] = []  # each task has its own copy, and so its own table

    def encode(text: pa.Array) -> pa.Array:
        if not held:
            held.append(ChunkTable(model_file))
        parts = [held[0].encode(block) for block in _blocks(texts(text))]
        return pa.StructArray.from_arrays(
            [pa.concat_arrays(column) for column in zip(*parts, strict=True)], names=["ids", "decoded"]
        )

    return F.arrow_udf(encode, "ids array<int>, decoded string")


def encoded(docs: DataFrame, model_file: str, *, text_col: str = "text", name: str = "pieces") -> DataFrame:
    """``docs`` with a struct column: the ids of the text, and their decoding.

    ``model_file`` must lie at this path on every executor.
    """
    return small_batches(docs).withColumn(name, encoder(model_file)(F.col(text_col).cast("string")))
