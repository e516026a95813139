"""Folders of tables, through the file system Spark itself uses."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, hidden names such as those of Spark's markers left out; none when it is absent."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    found = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def create(spark: SparkSession, path: str) -> bool:
    """Make an empty file; false when it exists already. Of several writers one succeeds."""
    system, target = _file_system(spark, path)
    return system.createNewFile(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _file_system(spark, path)
    out = system.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _file_system(spark, path)
    source = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, target = _file_system(spark, path)
    if not system.rename(target, _file_system(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 when it is absent."""
    system, target = _file_system(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"candlewick-{application}-")


def shared(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local master may lack it."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return given or _local_folder(spark.sparkContext.applicationId)
