"""Documents to token ids, in stages that each read what the one before has written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import jaccard, lines, mixing, pieces, quality
from candlewick.llm.common import free_name, scratch_root, table
from candlewick.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    kept, measures = free_name(docs, "kept"), free_name(docs, "measures")
    judged = quality.judged(docs, measures=measures, verdict=kept)
    return judged.where(F.col(kept)).select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from the texts."""
    left = lines.drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return jaccard.one_of_each(docs)


#: Parts of the corpus by domain. What is most likely clean stays, once, and the others are thinned out.
TARGETS = {"clean": 0.94, "noisy": 0.05, "toxic": 0.01}


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose drawn number of copies is zero go."""
    mix = free_name(docs, "mix")
    labels = table(spark, sf_dir, "labels")
    mixed = mixing.mixed(docs, labels, TARGETS, cap=1.0, fill="clean", keep="clean", name=mix)
    return mixed.where(F.col(mix)["copies"] > 0).select(*[f"`{c}`" for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it."""
    done = pieces.encoded(docs.select("doc_id", "lang", "source", "text"), piece_model())
    ids, decoded = F.col("pieces.ids"), F.col("pieces.decoded")
    return done.select(
        "doc_id", "lang", "source", ids.alias("ids"), F.size(ids).cast("long").alias("n_tokens"),
        decoded.eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("mixing to target weights", mixing_to_targets),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot encode text into pieces; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{root}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{root}/{k}")
    return docs
