"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: Settings the operators rely on. The last lets "the newest N of each instrument" drop rows
#: before the shuffle also for an N of more than a thousand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app: str = "candlewick", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session pinned to UTC with adaptive execution on.

    Partition counts, memory and the checkpoint folder belong to the cluster and are
    left as they are; pass them through ``conf`` (dots written as ``__``) for local runs.
    """
    builder = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
