"""Exports to CSV, JSON lines and training tables. All writes stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.features import FEATURES, assign_split, fit_scaler, fitting_rows, scale
from candlewick.operators.quality import overall


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def to_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, times in ISO form."""
    df.write.mode("overwrite").json(path)


def training_tables(features: DataFrame, path: str, fit_on: str = "all") -> None:
    """Scaled ``matrix`` rows by split, the ``scaler`` and the ordered ``features`` under ``path``.

    Features and scaler are written before they are used, so each is computed once.
    """
    spark = features.sparkSession
    features.write.mode("overwrite").parquet(f"{path}/unscaled")
    stored = spark.read.parquet(f"{path}/unscaled")
    fit_scaler(fitting_rows(stored, fit_on)).write.mode("overwrite").parquet(f"{path}/scaler")
    scaler = spark.read.parquet(f"{path}/scaler")
    scaled = assign_split(scale(stored, scaler))
    scaled.write.mode("overwrite").partitionBy("split").parquet(f"{path}/matrix")
    names = spark.createDataFrame(list(enumerate(FEATURES)), "position int, feature string")
    names.write.mode("overwrite").parquet(f"{path}/features")


def read_split(spark, path: str, split: str) -> DataFrame:
    """The train or the test rows written by :func:`training_tables`."""
    return spark.read.parquet(f"{path}/matrix").where(F.col("split") == split).drop("split")


def validation_report(checks: DataFrame, path: str) -> None:
    """The checks and, as a last kind of row, the overall status."""
    whole = overall(checks).select(
        F.lit("Overall").alias("section"), F.lit("overall status").alias("check"), "status",
        F.lit("failed checks count, warnings do not").alias("detail"),
    )
    to_csv(checks.unionByName(whole), path)
