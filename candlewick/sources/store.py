"""The five tables as Parquet folders, with upserts, inserts and retention.

Each table is a log of versions (:mod:`candlewick.sources.versions`): an upsert adds the rows of its
batch and rewrites nothing, and reading merges the newest version of each key. Time tables are
partitioned by ``date``, so time filters prune folders. Compaction merges the changes of a day into its
rows, by itself after ``compact_every`` upserts of a table. There is one writer to a table at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import filters, joins, merge, summary
from candlewick.operators.indicators import LATEST_ROWS, latest_candles
from candlewick.operators.instruments import created_instruments, named_instruments
from candlewick.schemas import TABLES, candle_table, conform
from candlewick.sources import folders
from candlewick.sources.versions import VersionedTable

KEYS = {
    "instruments": ("instrument_id",),
    "candle_data_1min": merge.CANDLE_KEY,
    "candle_data_15sec": merge.CANDLE_KEY,
    "technical_indicators": merge.INDICATOR_KEY,
    "trading_signals": merge.SIGNAL_KEY,
}


class Store:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = 100):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every
        self._views: list[Callable[[], None]] = []
        self._writes_open = 0

    # -- reading ---------------------------------------------------------------

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}")
        return f"{self.root}/{name}"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), TABLES[name], KEYS[name])

    def exists(self, name: str) -> bool:
        return self.table(name).exists()

    def read(self, name: str) -> DataFrame:
        return self._read(name).select(*TABLES[name].names)

    def _read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def instruments(self) -> DataFrame:
        return self.read("instruments")

    def candles(self, timeframe: str = "1min") -> DataFrame:
        return self.read(candle_table(timeframe))

    def indicators(self) -> DataFrame:
        return self.read("technical_indicators")

    def signals(self) -> DataFrame:
        return self.read("trading_signals")

    def candle_range(
        self, instrument_id: int, start: str | date | datetime, end: str | date | datetime, timeframe: str = "1min"
    ) -> DataFrame:
        """As the operator of this name, reading only the days in the range."""
        name = candle_table(timeframe)
        low, high = (date.fromisoformat(str(bound)[:10]) for bound in (start, end))
        table = self.table(name)
        found = table.snapshot()
        days = table.read([day for day in found.days() if low <= day <= high], found)
        days = days.where(F.col("date").between(F.lit(low), F.lit(high)))
        return filters.candle_range(days.select(*TABLES[name].names), instrument_id, start, end)

    def standing_candles(self, keys: DataFrame, timeframe: str) -> DataFrame:
        """The stored candles of the given (time, instrument_id), reading only their days."""
        name = candle_table(timeframe)
        days = self._days_of(name, _dated(name, _nulls(keys, TABLES[name])))
        return days.join(keys.select(*merge.CANDLE_KEY), list(merge.CANDLE_KEY), "left_semi").select(
            *TABLES[name].names
        )

    def newest_candles(
        self, instruments: DataFrame, timeframe: str = "1min", rows: int = LATEST_ROWS
    ) -> DataFrame:
        """The newest ``rows`` candles of each of ``instruments`` (instrument_id).

        Days are read from the newest back, four times as many whenever some instrument
        has too few rows in them, until all have enough or no day is left.
        """
        table = self.table(candle_table(timeframe))
        held = table.snapshot()
        days, span = held.days(), 8
        while True:
            newest = table.read(days[-span:], held).select(*table.schema.names)
            found = latest_candles(newest.join(instruments, "instrument_id", "left_semi"), rows).drop("recency")
            if span >= len(days):
                return found
            full = found.groupBy("instrument_id").count().where(F.col("count") >= rows)
            if instruments.join(full, "instrument_id", "left_anti").isEmpty():
                return found
            span *= 4

    def latest(self, limit: int = 100, symbol: str | None = None, timeframe: str = "1min") -> DataFrame:
        """As :func:`candlewick.operators.joins.latest`, reading days from the newest back.

        Once the days read hold ``limit`` candles of the symbols asked for, no earlier day can have
        one among the newest, so what is read does not grow with the history.
        """
        table = self.table(candle_table(timeframe))
        held, chosen = table.snapshot(), self.instruments()
        if symbol is not None:
            chosen = chosen.where(F.col("symbol") == symbol)
        days, span = held.days(), 1
        while span < len(days):
            rows = table.read(days[-span:], held).select("instrument_id")
            if rows.join(chosen.select("instrument_id"), "instrument_id", "left_semi").limit(limit).count() >= limit:
                break
            span *= 2
        readings = self.table("technical_indicators").read(days[-span:])
        newest = table.read(days[-span:], held).select(*table.schema.names)
        return joins.latest(newest, chosen, readings.drop("date"), timeframe, limit, symbol)

    def register_views(self, as_of: str | datetime | None = None, all_data: bool = True) -> None:
        """Temp views: the tables plus scalping_data, first_two_hours_data and market_summary.

        They are made anew after every write of this store, so that queries see it. After writes
        by others call :meth:`refresh_views`.
        """
        self.keep_views(lambda: self._register(as_of, all_data))

    def keep_views(self, register: Callable[[], None]) -> None:
        """Call ``register`` now and after every write."""
        register()
        self._views.append(register)

    def refresh_views(self) -> None:
        if not self._writes_open:
            for register in self._views:
                register()

    @contextmanager
    def one_refresh(self) -> Iterator[None]:
        """Make the views anew once, after all writes of the block."""
        self._writes_open += 1
        try:
            yield
        finally:
            self._writes_open -= 1
            self.refresh_views()

    def _register(self, as_of: str | datetime | None, all_data: bool) -> None:
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)
        minute, ind, dim = self.candles(), self.indicators(), self.instruments()
        joins.enriched_candles(minute, dim, ind).createOrReplaceTempView("scalping_data")
        filters.first_two_hours(minute).createOrReplaceTempView("first_two_hours_data")
        summary.market_summary(minute, ind, dim, as_of, all_data, lazy=True).createOrReplaceTempView("market_summary")

    # -- writing ----------------------------------------------------------------

    def replace(self, name: str, df: DataFrame) -> None:
        """Replace a whole table; ``df`` may read the table itself."""
        self.table(name).replace(_dated(name, df))
        self.refresh_views()

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows whose keys the table does not hold."""
        self.table(name).append(_dated(name, df))
        self.refresh_views()

    def upsert(
        self, name: str, batch: DataFrame, key: Sequence[str], order: Sequence[str]
    ) -> None:
        """Write ``batch`` over the table, the last row of a key by ``order`` winning.

        Repeating a batch changes nothing. The batch is all that is read and written.
        """
        if sorted(key) != sorted(KEYS[name]):
            raise ValueError(f"{name} is keyed by {KEYS[name]}, not by {tuple(key)}")
        table = self.table(name)
        table.change(_dated(name, merge.last_version(batch, key, order)))
        if table.changes_held() >= self.compact_every:
            # What the compaction before this one replaced has had time to be read to the end.
            table.vacuum()
            table.compact()
        self.refresh_views()

    def insert_ignore(
        self, name: str, batch: DataFrame, key: Sequence[str], order: Sequence[str]
    ) -> None:
        """Append the first row of each key that the table does not hold yet."""
        with self.durable(_dated(name, merge.first_version(batch, key, order))) as incoming:
            new = incoming.join(
                self._days_of(name, incoming).select(*key), list(key), "left_anti"
            )
            self.table(name).append(new)
        self.refresh_views()

    def compact(self, name: str) -> None:
        """Merge all changes of a table into its rows; files replaced stay until :meth:`vacuum`."""
        self.table(name).compact()
        self.refresh_views()

    def vacuum(self, name: str) -> None:
        """Delete files that no longer count, once nobody reads them."""
        self.table(name).vacuum()
        self.refresh_views()

    def create_instruments(self, symbols: DataFrame, as_of: str | None = None) -> None:
        """Append an instrument for each unseen contract symbol; known ones are neither read whole nor written."""
        self._add_instruments(created_instruments(symbols, self.instruments(), as_of), self.table("instruments").append)

    def upsert_instruments(self, tickers: DataFrame, as_of: str | None = None) -> None:
        """Append the instruments named by vendor tickers, as new rows or as newer versions of theirs."""
        self._add_instruments(named_instruments(tickers, self.instruments(), as_of), self.table("instruments").change)

    def _add_instruments(self, rows: DataFrame, write: Callable[[DataFrame], int]) -> None:
        with self.durable(rows) as made:
            if not made.isEmpty():
                write(made)
                self.refresh_views()

    def upsert_candles(self, batch: DataFrame, timeframe: str, order: Sequence[str] = ("seq",)) -> None:
        self.upsert(candle_table(timeframe), batch, merge.CANDLE_KEY, order)

    def upsert_indicators(self, batch: DataFrame) -> None:
        self.upsert("technical_indicators", batch, merge.INDICATOR_KEY, merge.INDICATOR_KEY)

    def upsert_signals(self, batch: DataFrame) -> None:
        self.upsert("trading_signals", batch, merge.SIGNAL_KEY, merge.SIGNAL_KEY)

    def retain(self, name: str, days: int = 7, as_of: datetime | None = None) -> None:
        """Drop rows older than ``days``: whole days as folders, the boundary day by rewriting."""
        as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
        oldest = as_of - timedelta(days=days)
        table = self.table(name)
        held = table.snapshot().days()
        table.drop(day for day in held if day < oldest.date())
        if oldest.date() in held:
            boundary = table.read([oldest.date()])
            stale = boundary.where(F.col("time") < F.lit(str(oldest)).cast("timestamp_ntz"))
            if not stale.isEmpty():
                table.replace(filters.retained(boundary, as_of, days), [oldest.date()])
        self.refresh_views()

    @contextmanager
    def durable(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written out below the root, so that later steps neither recompute it nor read
        what they replace; the files go when the block ends."""
        path = f"{self.root}/_scratch/{uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            folders.delete(self.spark, path)

    def _days_of(self, name: str, batch: DataFrame) -> DataFrame:
        """The table's rows on the days of ``batch``.

        The days come to the driver, one value per calendar day however many rows there
        are, because a literal list prunes the folders to read in every case.
        """
        days = [row["date"] for row in batch.select("date").distinct().collect()]
        return self.table(name).read(days)


def _nulls(df: DataFrame, schema) -> DataFrame:
    """``df`` with the columns of ``schema`` that it lacks as nulls."""
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(lacking) if lacking else df


def _timed(name: str) -> bool:
    return "time" in TABLES[name].names


def _dated(name: str, df: DataFrame) -> DataFrame:
    made = conform(df, TABLES[name])
    return made.withColumn("date", F.to_date("time")) if _timed(name) else made
