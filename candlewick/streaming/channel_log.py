"""Channel logs: files of lines that writers append to, read as a stream that can be replayed.

Spark's file source takes each new file once, as it is when it is first seen. Here lines appended
to a file already read arrive too, each once, also after a restart: the stream's offset says for
every file up to which byte it has been read, and the range between two offsets always gives the
same lines. A line counts once its line feed is there, so one half written waits for the next batch.

Files are looked up in one folder, without its subfolders; names that start with ``_`` or ``.`` are
left out. They may only grow: a file that is shorter than what was read of it is an error, as its
lines cannot be replayed. One that is gone is forgotten, so a log is closed by deleting or moving its
file, and the offset names the files present only. A range is cut into slices of at most
``slice_bytes``, so one file that grows fast is read by many tasks; a slice has the lines that start in it.
Batch reads (``spark.read``) give all whole lines there are.

Bytes that are not UTF-8 become replacement characters, blank lines are rows like others, a carriage
return before the line feed goes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from candlewick.schemas import TICK_ENVELOPE

# The source travels by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "channel_log"
SLICE_BYTES = 64 << 20
BLOCK = 4 << 20
TAIL = 64 << 10

# ``position`` is the byte at which the line starts.
LINES = "file string, position bigint, line string"


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


@dataclass
class Slice(InputPartition):
    """The lines of a file that start at a byte from ``start`` to before ``end``; ``limit`` is the end of the
    last whole line. ``first`` says that a line starts at ``start`` for sure."""

    file: str
    start: int
    end: int
    limit: int
    first: bool


def _slices(start: dict[str, int], end: dict[str, int], size: int) -> list[Slice]:
    out = []
    for file, upto in sorted(end.items()):
        begin = start.get(file, 0)
        if upto < begin:
            raise ValueError(f"{file} has become shorter: {begin} bytes of it were read, {upto} are whole lines now")
        for at in range(begin, upto, size):
            out.append(Slice(file, at, min(at + size, upto), upto, at == begin))
    return out


def _whole_lines_end(source, size: int) -> int:
    """The byte behind the last line feed."""
    at = size
    while at:
        begin = max(0, at - TAIL)
        source.seek(begin)
        feed = source.read(at - begin).rfind(b"\n")
        if feed >= 0:
            return begin + feed + 1
        at = begin
    return 0


class _Log:
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("a channel log needs the path of its folder")
        self.folder = options["path"]
        self.slice_bytes = int(options.get("slice_bytes", SLICE_BYTES))
        if self.slice_bytes < 1:
            raise ValueError("slice_bytes must be positive")
        self.seen: dict[str, tuple[int, int]] = {}

    def ends(self) -> dict[str, int]:
        """For every file the end of its last whole line. Only tails of files that have grown are read."""
        system, root = _opened(self.folder)
        seen = {}
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")):
                continue
            size, end = self.seen.get(info.base_name, (-1, 0))
            if size != info.size:
                with system.open_input_file(info.path) as source:
                    end = _whole_lines_end(source, info.size)
            seen[info.base_name] = (info.size, end)
        self.seen = seen
        return {file: end for file, (_, end) in seen.items()}

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        system, root = _opened(self.folder)
        with system.open_input_file(f"{root}/{part.file}") as source:
            # A line starts where the byte before is a line feed.
            at = part.start if part.first else part.start - 1
            source.seek(at)
            skip, rest = not part.first, b""
            while at < part.end:
                block = source.read(min(BLOCK, part.limit - at - len(rest)))
                if not block:
                    raise OSError(f"{part.file} ends before byte {part.limit}, up to which it was to be read")
                rest += block
                if skip:
                    feed = rest.find(b"\n")
                    if feed < 0:
                        at, rest = at + len(rest), b""
                        continue
                    at, rest, skip = at + feed + 1, rest[feed + 1 :], False
                whole = rest.rfind(b"\n") + 1
                if whole:
                    yield from self._rows(part, at, rest[:whole])
                    at, rest = at + whole, rest[whole:]

    @staticmethod
    def _rows(part: Slice, at: int, data: bytes) -> Iterator[pa.RecordBatch]:
        feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A)
        position = at + np.r_[0, feeds[:-1] + 1]
        n = int(np.searchsorted(position, part.end))
        lines = [line.removesuffix("\r") for line in data.decode("utf-8", "replace").split("\n")[:n]]
        if n:
            columns = [pa.array([part.file] * n), pa.array(position[:n]), pa.array(lines, pa.string())]
            yield pa.record_batch(columns, ["file", "position", "line"])


class _StreamReader(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return _slices(start, end, self.slice_bytes)

    def commit(self, end: dict) -> None:
        """Nothing is kept for ranges that are done."""


class _BatchReader(_Log, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return _slices({}, self.ends(), self.slice_bytes)

    def read(self, part: Slice | None) -> Iterator[pa.RecordBatch]:
        # An empty folder has one partition, which is None.
        return iter(()) if part is None else super().read(part)


class ChannelLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(dict(self.options))


def log_lines(spark: SparkSession, folder: str, *, streaming: bool = True, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(file, position, line) of a folder of channel logs, as a stream or as it stands."""
    spark.dataSource.register(ChannelLog)
    reader = spark.readStream if streaming else spark.read
    return reader.format(FORMAT).option("slice_bytes", slice_bytes).load(folder)


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_e", F.from_json("line", TICK_ENVELOPE))


def _usable():
    return F.coalesce(F.col("_e.seq").isNotNull() & F.col("_e.channel").isNotNull(), F.lit(False))


def envelopes(lines: DataFrame) -> DataFrame:
    """Raw ticks from lines that are JSON objects with a ``seq`` and a ``channel``."""
    return _parsed(lines).where(_usable()).select("_e.*")


def unreadable_lines(lines: DataFrame) -> DataFrame:
    """The quarantine side of :func:`envelopes`; blank lines are in neither."""
    return _parsed(lines).where(~_usable() & (F.trim("line") != "")).drop("_e")
