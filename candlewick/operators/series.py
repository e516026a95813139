"""Ordered windows per instrument that stay balanced when one instrument dominates.

A window partitioned by instrument puts all rows of one instrument into one task.
:func:`open_series` first counts rows per instrument. When every instrument fits a task
the window stays as it is: one exchange, one sort. An instrument above the limit is cut
along its order column into slices of about ``rows_per_slice`` rows, each slice also
receiving copies of the few neighbouring rows that its frames look at, so frames of a
bounded number of rows are exact inside a slice. Running values over the whole
history are finished by :meth:`Series.running`, which carries slice totals forward.

Slices do not grow with the table. What describes them, some dozens of cells for each slice,
is joined without a hint: Spark broadcasts it when its measured size allows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from candlewick.functions.numbers import micros

ROWS_PER_SLICE = 1_000_000
CELLS_PER_SLICE = 16
GRID_LEVELS = 2

_SLICE, _OWN = "_slice", "_own"


@dataclass(frozen=True)
class Running:
    """A value accumulated over an instrument's whole history.

    ``kind`` is sum, product, max or last (the latest non-null); ``before_row`` leaves the
    current row out.
    """

    kind: str
    term: Column
    before_row: bool = False


@dataclass(frozen=True)
class Series:
    frame: DataFrame
    key: str
    order: str
    sliced: bool

    @property
    def parts(self) -> list[str]:
        return [self.key, _SLICE] if self.sliced else [self.key]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(self.order)

    def rows(self, start: int, end: int) -> WindowSpec:
        return self.window.rowsBetween(start, end)

    def running(self, frame: DataFrame, **wanted: Running) -> DataFrame:
        """Append the running columns named by ``wanted`` to ``frame``."""
        window = {
            name: self.rows(Window.unboundedPreceding, -1 if spec.before_row else 0)
            for name, spec in wanted.items()
        }
        terms = {
            name: F.when(F.col(_OWN), spec.term) if self.sliced else spec.term
            for name, spec in wanted.items()
        }
        local = frame.select(
            "*",
            *[
                _over_rows(spec.kind, terms[name]).over(window[name]).alias(name)
                for name, spec in wanted.items()
            ],
        )
        if not self.sliced:
            return local
        totals = (
            frame.where(F.col(_SLICE) > 0)
            .groupBy(*self.parts)
            .agg(
                *[
                    _over_group(spec.kind, terms[name], F.col(self.order)).alias(f"_{name}")
                    for name, spec in wanted.items()
                ]
            )
        )
        earlier = (
            Window.partitionBy(self.key)
            .orderBy(_SLICE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = totals.select(
            *self.parts,
            *[
                _over_rows(spec.kind, F.col(f"_{name}")).over(earlier).alias(f"_{name}")
                for name, spec in wanted.items()
            ],
        )
        joined = local.join(carried, self.parts, "left")
        return joined.withColumns(
            {
                name: _merge(spec.kind, F.col(f"_{name}"), F.col(name))
                for name, spec in wanted.items()
            }
        ).drop(*[f"_{name}" for name in wanted])

    def close(self, frame: DataFrame) -> DataFrame:
        """Drop the copied neighbour rows and the slice columns."""
        if not self.sliced:
            return frame
        return frame.where(F.col(_OWN)).drop(_SLICE, _OWN)


def _over_rows(kind: str, term: Column) -> Column:
    if kind == "last":
        return F.last(term, ignorenulls=True)
    return {"sum": F.sum, "product": F.product, "max": F.max}[kind](term)


def _over_group(kind: str, term: Column, order: Column) -> Column:
    if kind == "last":
        return F.max_by(term, F.when(term.isNotNull(), order))
    return _over_rows(kind, term)


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    if kind == "max":
        return F.greatest(local, carried)
    both = local + carried if kind == "sum" else local * carried
    return F.coalesce(both, local, carried)


def _position(df: DataFrame, order: str) -> Column:
    if isinstance(df.schema[order].dataType, (T.TimestampNTZType, T.TimestampType)):
        return micros(F.col(order))
    return F.col(order).cast("bigint")


def open_series(
    df: DataFrame,
    key: str = "instrument_id",
    order: str = "time",
    before: int = 0,
    after: int = 0,
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
    lazy: bool = False,
) -> Series:
    """Prepare ``df`` for windows over ``key`` ordered by ``order`` (never null, unique per key).

    ``before`` and ``after`` are the largest numbers of rows that any bounded frame
    reaches back and ahead. ``counted`` may name a frame that is cheaper to count and has
    at least as many rows per key, such as the ticks behind candles. ``lazy`` counts nothing while the
    plan is made: it always holds the slices, which is for views that are made anew after each write.
    """
    limit = max(rows_per_slice or ROWS_PER_SLICE, 2 * (before + after), 1)
    counted = df if counted is None else counted
    if lazy:
        return Series(_cut(df, counted, key, order, before, after, limit), key, order, sliced=True)
    tally = counted.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    peak = tally.agg(F.max("n")).first()[0] or 0
    if peak <= limit:
        return Series(df, key, order, sliced=False)
    return Series(_cut(df, counted, key, order, before, after, limit), key, order, sliced=True)


def _cut(
    df: DataFrame, counted: DataFrame, key: str, order: str, before: int, after: int, unit: int
) -> DataFrame:
    """Add to each row the slice it belongs to and copies for the slices that look at it."""
    path = [key]
    rows, tallied = df.withColumn("_at", _position(df, order)), df.select(
        key, _position(df, order).alias("_at")
    )
    measured = counted.select(key, _position(counted, order).alias("_at"))
    # An even grid over the time range of each instrument above the limit, then over each
    # of its cells that is still above it, for bursts and stray times.
    for level in range(GRID_LEVELS):
        grid = _grid(measured, path, unit)
        cell = f"_cell{level}"
        rows = _place(rows.join(grid, path, "left"), cell, inner=level > 0)
        # Only the rows of hot instruments are ever counted by cell.
        tallied = _place(tallied.join(grid, path, "left" if level else "inner"), cell, inner=level > 0)
        measured, path = tallied, [*path, cell]
    cells = tallied.groupBy(*path).agg(F.count(F.lit(1)).alias("_n"))
    plain = F.array(F.struct(F.lit(0).cast("bigint").alias("slice"), F.lit(True).alias("own")))
    return (
        rows.join(_slices_of(cells, path, before, after, unit), path, "left")
        .withColumn("_target", F.explode(F.coalesce("_targets", plain)))
        .withColumn(_SLICE, F.col("_target.slice"))
        .withColumn(_OWN, F.col("_target.own"))
        .drop("_at", "_targets", "_target", *path[1:])
    )


def _grid(rows: DataFrame, path: list[str], unit: int) -> DataFrame:
    """Origin and cell width for every group of rows above the limit."""
    cells = f"{CELLS_PER_SLICE} * (_n div {unit} + 1)"
    return (
        rows.groupBy(*path)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"), F.max("_at").alias("_high"))
        .where(F.col("_n") > unit)
        .select(*path, "_low", F.expr(f"(_high - _low) div ({cells}) + 1").alias("_width"))
    )


def _place(rows: DataFrame, cell: str, inner: bool) -> DataFrame:
    position = F.expr("(_at - _low) div _width")
    if inner:
        position = F.coalesce(position, F.lit(0))
    return rows.withColumn(cell, position).drop("_low", "_width")


def _slices_of(
    cells: DataFrame, path: list[str], before: int, after: int, unit: int
) -> DataFrame:
    """Group consecutive cells into slices and list the slices that need each cell.

    Cells are cut where the row count passes a multiple of ``unit``; a cut that would
    leave fewer rows than a frame can reach is dropped, so that a frame never needs
    more than the adjoining slice.
    """
    key = path[0]
    along = Window.partitionBy(key).orderBy(*path[1:])
    whole = Window.partitionBy(key)
    piece = Window.partitionBy(key, "_slice")
    sized = (
        cells.withColumn("_end", F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_cut", F.expr(f"_start div {unit}"))
        .withColumn("_rows", F.sum("_n").over(Window.partitionBy(key, "_cut")))
        .withColumn("_previous", F.lag("_cut").over(along))
    )
    opens = F.col("_previous").isNull() | (
        (F.col("_previous") != F.col("_cut")) & (F.col("_rows") >= before + after)
    )
    numbered = (
        sized.withColumn("_slice", F.sum(opens.cast("bigint")).over(along))
        .withColumn("_last", F.max("_slice").over(whole))
        .withColumn("_first_row", F.min("_start").over(piece))
        .withColumn("_end_row", F.max("_end").over(piece))
    )

    def target(slice_: Column, own: bool) -> Column:
        return F.struct(slice_.alias("slice"), F.lit(own).alias("own"))

    here = F.col("_slice")
    ahead = (here < F.col("_last")) & (F.col("_end_row") - F.col("_end") < before)
    behind = (here > 1) & (F.col("_start") - F.col("_first_row") < after)
    listed = F.array(
        target(here, True),
        F.when(ahead, target(here + 1, False)),
        F.when(behind, target(here - 1, False)),
    )
    return numbered.select(*path, F.array_compact(listed).alias("_targets"))
