"""The named queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    jaccard, lines, mixing, negatives, passages, personal, pieces, quality, secrets, sharding, topk,
    urls, variants,
)
from candlewick.llm.common import sha256_text, table
from candlewick.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    mix = mixing.mixed(docs, table(spark, folder, "labels"), columns=["doc_id"])
    return mix.select(
        "doc_id", F.col("mix.tokens").alias("n_tokens"),
        *[F.col("mix.p")[k].alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)],
        F.col("mix.rate").alias("rate"), F.col("mix.copies").alias("copies"),
    )


def op2_substring_dedup(spark, folder):
    marked = passages.marked_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("repeats.removed")
    return marked.select(
        "doc_id", F.col("repeats.class_id").alias("class_id"),
        F.col("repeats.n_stretches").alias("n_stretches"),
        F.size(spans).cast("long").alias("n_removed"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed"),
        F.array_join(
            F.transform(
                F.col("repeats.members"),
                lambda s: F.concat_ws(":", s["start"], s["end"], F.coalesce(s["keeper"].cast("string"), F.lit("")), s["keeper_start"]),
            ), ",",
        ).alias("members"),
    )


def op3_secret_scan(spark, folder):
    spans = F.col("secrets")
    scanned = secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        sha256_text(secrets.spans_text(F.filter(spans, secrets.is_base))).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
        (F.size(spans) - F.size(F.filter(spans, secrets.is_base))).cast("long").alias("n_entropy"),
    )


def op4_exact_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.whole_vector("embedding", 64).alias("v"))
    found = topk.top_k(
        vectors, vectors.where(F.col("vec_id") % 20 == 0), 20, id_col="vec_id", vector_col="v"
    )
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_sharding(spark, folder):
    placed = sharding.shard(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op6_url_filter(spark, folder):
    judged = urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


def op7_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = pieces.encoded(docs, piece_model())
    ids = F.col("pieces.ids")
    return done.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        sha256_text(F.array_join(ids.cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_text(F.col("pieces.decoded")).alias("decoded_sha256"),
    )


def op8_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_shared_lines(docs, counts=("n_lines", "n_dropped")).select(
        "doc_id", "n_lines", "n_dropped", sha256_text(F.col("text")).alias("kept_sha256")
    )


def op9_ngram_jaccard(spark, folder):
    return jaccard.near_classes(table(spark, folder, "documents").select("doc_id", "text"))


def op10_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    m = F.col("measures")
    return quality.judged(docs).select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        quality.base_failed(m).alias("base_failed"),
        "kept",
    )


def op11_personal_data(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, spans = personal.find_personal_data(docs), F.col("personal")
    base = F.filter(spans, personal.is_base)

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in personal.BASE_KINDS],
        sha256_text(secrets.spans_text(base)).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


def op12_spelling_variants(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return variants.spelling_variants(variants.word_counts(docs, typo_every=199))


def op13_hard_negatives(spark, folder):
    label, own = F.col("label"), F.col("vec_id")
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.when(own % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        negatives.whole_vector("embedding", 256).alias("v"),
    )
    return negatives.hard_negatives(rows, own % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_substring_dedup,
        op3_secret_scan,
        op4_exact_top_k,
        op5_sharding,
        op6_url_filter,
        op7_sentencepiece,
        op8_line_dedup,
        op9_ngram_jaccard,
        op10_quality_rules,
        op11_personal_data,
        op12_spelling_variants,
        op13_hard_negatives,
    )
}

__all__ = ["ORACLES", "QUERIES", "piece_model"]
