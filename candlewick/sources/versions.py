"""A table as a log of versions: every write adds files, and reading merges them.

Each write is one numbered version, a folder of its own below ``rows`` or ``changes``:

* ``rows/version=N/date=D`` has rows whose keys no earlier version holds;
* ``changes/version=N/date=D`` has upserted rows: the newest version of a key counts.

So a write costs what its batch costs, however large the table is. A version counts once its marker
stands in ``_commits``: ``N.open`` is made before the files are written and renamed to ``N`` when they
are complete, which is one step in a file system. What a lost writer leaves behind is never read. A
marker ``N.reset`` lists days that version N holds in full; older files of those days no longer count.
They stay for readers that have already listed them, until :meth:`vacuum`.

Days without changes are read as they are. On the others the changes, reduced to the newest of each
key, replace the rows of their keys; :meth:`compact` writes such days anew.

Tables without a time have no ``date`` folders and count as one day.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import merge
from candlewick.sources import folders

ROWS, CHANGES = "rows", "changes"
#: The only day of a table without a time.
ALWAYS = date.min


@dataclass(frozen=True)
class Part:
    version: int
    day: date
    path: str


@dataclass
class Snapshot:
    """The files that count at one moment."""

    rows: list[Part] = field(default_factory=list)
    changes: list[Part] = field(default_factory=list)
    dead: list[Part] = field(default_factory=list)

    def days(self) -> list[date]:
        return sorted({part.day for part in (*self.rows, *self.changes)})


class VersionedTable:
    """``schema`` is that of the table; ``key`` tells its rows apart and has the time where there is one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]):
        self.spark, self.path, self.schema, self.key = spark, path, schema, list(key)
        self.timed = "time" in schema.names

    # -- the log -------------------------------------------------------------------

    @property
    def _log(self) -> str:
        return f"{self.path}/_commits"

    def _markers(self) -> list[tuple[int, str]]:
        found = (name.partition(".") for name in folders.names(self.spark, self._log))
        return sorted((int(number), state) for number, _, state in found)

    def _open(self) -> int:
        version = max((number for number, _ in self._markers()), default=0) + 1
        while not folders.create(self.spark, f"{self._log}/{version}.open"):
            version += 1
        return version

    def _commit(self, version: int, days: Iterable[date] | None) -> None:
        marker = f"{self._log}/{version}"
        if days is not None:
            folders.write_text(self.spark, f"{marker}.open", "\n".join(sorted(d.isoformat() for d in days)))
        folders.rename(self.spark, f"{marker}.open", marker if days is None else f"{marker}.reset")

    def snapshot(self) -> Snapshot:
        """The committed files, by listing the log and the folders of versions; no job is started."""
        markers = self._markers()
        committed = {number for number, state in markers if state != "open"}
        full: dict[date, int] = {}
        for number, state in markers:
            if state == "reset":
                for line in folders.read_text(self.spark, f"{self._log}/{number}.reset").split():
                    full[date.fromisoformat(line)] = number
        found = Snapshot()
        for kind, live in ((ROWS, found.rows), (CHANGES, found.changes)):
            for name in folders.names(self.spark, f"{self.path}/{kind}"):
                version, place = int(name.removeprefix("version=")), f"{self.path}/{kind}/{name}"
                if version not in committed:
                    continue
                for day, path in self._days_in(place):
                    part = Part(version, day, path)
                    (live if version >= full.get(day, 0) else found.dead).append(part)
        return found

    def _days_in(self, place: str) -> list[tuple[date, str]]:
        if not self.timed:
            return [(ALWAYS, place)]
        return [
            (date.fromisoformat(name[5:]), f"{place}/{name}")
            for name in folders.names(self.spark, place) if name.startswith("date=")
        ]

    # -- reading -----------------------------------------------------------------------

    def exists(self) -> bool:
        return any(state != "open" for _, state in self._markers())

    def _files(self, kind: str, parts: list[Part]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        if self.timed:
            schema = schema.add("date", "date")
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}")
        return reader.parquet(*[part.path for part in parts])

    def _columns(self) -> list[str]:
        return [*self.schema.names, "date"] if self.timed else self.schema.names

    def read(self, days: Iterable[date] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows, of all days or of ``days``, with a column ``date`` where the table has a time."""
        found = snapshot or self.snapshot()
        wanted = None if days is None else set(days)

        def chosen(parts: list[Part]) -> list[Part]:
            return parts if wanted is None else [part for part in parts if part.day in wanted]

        rows, changes = chosen(found.rows), chosen(found.changes)
        columns = self._columns()
        if not changes:
            return self._files(ROWS, rows).select(*columns)
        touched = {part.day for part in changes}
        # The date is among the grouping columns so that a filter on it reaches the files.
        key = [*self.key, "date"] if self.timed else self.key
        newest = merge.last_version(self._files(CHANGES, changes), key, ("version",)).select(*columns)
        standing = self._files(ROWS, [part for part in rows if part.day in touched]).select(*columns)
        pieces = [standing.join(newest.select(*key), key, "left_anti"), newest]
        untouched = [part for part in rows if part.day not in touched]
        if untouched:
            pieces.append(self._files(ROWS, untouched).select(*columns))
        return reduce(DataFrame.unionByName, pieces)

    # -- writing -------------------------------------------------------------------------

    def _write(self, kind: str, df: DataFrame, resets: Iterable[date] | None = None) -> int:
        version = self._open()
        # Rebalancing gathers each day into few files and splits days too large for one task.
        writer = (df.hint("rebalance", "date") if self.timed else df).write
        if self.timed:
            writer = writer.partitionBy("date")
        writer.parquet(f"{self.path}/{kind}/version={version}")
        self._commit(version, resets)
        return version

    def append(self, df: DataFrame) -> int:
        """Add rows whose keys the table does not hold."""
        return self._write(ROWS, df)

    def change(self, df: DataFrame) -> int:
        """Add rows, one for each key, that replace those of their keys."""
        return self._write(CHANGES, df)

    def replace(self, df: DataFrame, days: Iterable[date] | None = None) -> int:
        """Let ``df`` be all there is, or all there is on ``days``. It may read the table itself."""
        replaced = set(self.snapshot().days() if days is None else days)
        return self._write(ROWS, df, replaced)

    # -- upkeep ------------------------------------------------------------------------------

    def compact(self, least: int = 1) -> list[date]:
        """Write days with ``least`` versions of changes or more anew, merged; returns them."""
        found = self.snapshot()
        count: dict[date, int] = {}
        for part in found.changes:
            count[part.day] = count.get(part.day, 0) + 1
        days = sorted(day for day, n in count.items() if n >= least)
        if days:
            self._write(ROWS, self.read(days, found), days)
        return days

    def drop(self, days: Iterable[date]) -> None:
        """Remove whole days: what is left of them no longer counts, and then goes."""
        days = set(days)
        if days:
            self._commit(self._open(), days)
            self.vacuum()

    def vacuum(self) -> None:
        """Delete files that no longer count and the leavings of lost writers.

        For a time without readers that listed the files before, and without another writer.
        """
        for part in self.snapshot().dead:
            folders.delete(self.spark, part.path)
        markers = self._markers()
        for number, state in markers:
            if state == "reset":
                # Nothing older is left of its days.
                folders.rename(self.spark, f"{self._log}/{number}.reset", f"{self._log}/{number}")
        last = max((number for number, _ in markers), default=0)
        for number, state in markers:
            places = [f"{self.path}/{kind}/version={number}" for kind in (ROWS, CHANGES)]
            lost = state == "open"
            if lost or not any(self._days_in(place) for place in places if folders.exists(self.spark, place)):
                for place in places:
                    folders.delete(self.spark, place)
                if number < last:  # the last number stays, so that none is given twice
                    folders.delete(self.spark, f"{self._log}/{number}{'.open' if lost else ''}")

    def changes_held(self) -> int:
        """Versions of changes that reading has to merge."""
        return len({part.version for part in self.snapshot().changes})
