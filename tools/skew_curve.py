"""Time the indicators when one instrument holds a third of all rows.

usage: python tools/skew_curve.py SHARED_FOLDER [folder] [copies]

Line items become candles of their supplier, every third one of instrument 0; ``copies``
repeats them along the time axis. Prints seconds with the plain window and with slices of several
sizes. The rows are kept in a new folder below SHARED_FOLDER, which is removed at the end.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from candlewick.operators.indicators import indicators  # noqa: E402
from candlewick.plans.mapping import supplier_ticks  # noqa: E402
from candlewick.session import build_session  # noqa: E402
from candlewick.sources import folders  # noqa: E402


def main() -> None:
    if len(sys.argv) < 2:
        sys.exit(__doc__)
    folder = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="32",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    ticks = supplier_ticks(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = ticks.select(
        F.when(F.xxhash64("seq") % 3 == 0, 0).otherwise(F.col("instrument_id")).alias("instrument_id"),
        # A unique time for each row: copies follow each other.
        F.timestamp_micros(F.col("seq") + F.col("copy") * 2**45).cast("timestamp_ntz").alias("time"),
        "close",
        "volume",
    ).dropDuplicates(["instrument_id", "time"])
    scratch = f"{sys.argv[1]}/candlewick-skew-{time.time_ns()}"
    rows.repartition(32).write.parquet(f"{scratch}/skewed")
    stored = spark.read.parquet(f"{scratch}/skewed")
    total, hot = stored.count(), stored.where("instrument_id = 0").count()
    for size in (10**9, 2_000_000, 1_000_000, 500_000, 200_000):
        start = time.perf_counter()
        indicators(stored, rows_per_slice=size).write.format("noop").mode("overwrite").save()
        label = f"slices of {size} rows" if size < hot else "plain window"
        print(f"{total} rows, {hot} of one instrument, {label}: {time.perf_counter() - start:.1f} s", flush=True)
    folders.delete(spark, scratch)
    spark.stop()


if __name__ == "__main__":
    main()
