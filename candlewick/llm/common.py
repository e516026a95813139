"""What several operators share: tables, scratch tables, free column names, text batches."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources import folders

#: White space in words, lines and keys: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = b" \t\n\v\f\r"

TEXTS_PER_BATCH = 1000

#: Stands for a null document id, so that joins and minima need no special case.
NO_ID = -(2**63)

_local_scratch: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application.

    It lies in ``spark.checkpoint.dir``, which all executors share. Only a local master may
    run without that setting; it then gets a temporary folder of its own.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="candlewick-")
        shared = _local_scratch[context.applicationId]
    return f"{shared}/candlewick-{context.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back.

    Cuts the lineage, and lets any executor read the rows again after a loss.
    """
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a scratch table that nothing reads any more; other frames are left alone."""
    path = getattr(df, "_scratch_path", None)
    if path:
        folders.delete(df.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, once their results are written."""
    folders.delete(spark, scratch_root(spark))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands at most TEXTS_PER_BATCH rows at a time to Python.

    Arrow batches are bounded by rows and not by bytes, and ten thousand texts, the default,
    may be more than a worker should hold.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= TEXTS_PER_BATCH:
        conf.set(name, str(TEXTS_PER_BATCH))
    return df


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def id_or_lowest(column: Column | str) -> Column:
    """Document ids with nulls as the lowest id."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID)).cast("long")


def id_back(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NO_ID, column)


def texts(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    return [value or b"" for value in array.cast(pa.binary()).to_pylist()]


def sha256_text(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)
