"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import jaccard, lines, mixing, passages, pieces, quality, secrets, sharding, topk, urls
from candlewick.llm.queries import piece_model

LONG = "word " * 40_000 + "end"
ROWS = [
    (1, None, "en", "a", None, "x", 1),
    (2, "", None, "a", 0, "x", 1),
    (None, "one line of text that is long enough", "en", None, 1, "x", 1),
    (3, "one line of text that is long enough", "en", "a", 1, "x", 1),
    (4, "ONE LINE of text that is long enough  ", "en", "a", 1, "x", 1),
    (5, LONG, "de", "b", len(LONG), "x", 1),
    (6, "déjà vu — naïve ▁ text\n\n漢字 😀", "fr", "b", 3, None, None),
    (6, "déjà vu — naïve ▁ text\n\n漢字 😀", "fr", "b", 3, None, None),
    (7, "two", "en", "a", 3, "x", 1),
]
#: Names that the operators use inside themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, key int"
CLASHES = ("measures", "kept", "mix", "__doc", "__m", "__keys", "__bag", "__p", "node", "sig", "path", "label")
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({name: F.lit(name) for name in CLASHES})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (3, 0, 1), (None, 1, 0), (5, None, 1)], LABELS)


ROW_WISE = {
    "secrets": lambda d, lab: secrets.find_secrets(d),
    "lines": lambda d, lab: lines.drop_shared_lines(d, counts=("a", "b")),
    "quality": lambda d, lab: quality.judged(d, measures="made_measures", verdict="made_verdict"),
    "pieces": lambda d, lab: pieces.encoded(d, piece_model()),
    "mixing": lambda d, lab: mixing.mixed(d, lab, name="made_mix"),
    "passages": lambda d, lab: passages.marked_repeats(d),
    "cut": lambda d, lab: passages.without_repeats(d),
    "urls": lambda d, lab: urls.judge_urls(d, url_col="text"),
}


@pytest.mark.parametrize("name", ROW_WISE)
def test_rows_and_columns_are_kept(docs, none, labels, name):
    made = ROW_WISE[name](docs, labels)
    assert made.columns[: len(docs.columns)] == docs.columns
    rows = made.collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6, 6, 7]
    assert {r["__doc"] for r in rows} == {"__doc"}
    assert ROW_WISE[name](none, labels).collect() == []
    assert ROW_WISE[name](none, labels.limit(0)).collect() == []


def test_lines(docs):
    found = {r["doc_id"]: r for r in lines.drop_shared_lines(docs, counts=("a", "b")).collect()}
    # Three documents share the line; the largest id keeps it.
    assert (found[None]["text"], found[None]["b"]) == ("", 1)
    assert (found[3]["text"], found[4]["text"]) == ("", "ONE LINE of text that is long enough  ")
    assert (found[1]["a"], found[1]["b"], found[2]["a"]) == (1, 0, 1)
    assert found[5]["text"] == LONG


def test_quality(docs):
    found = {r["doc_id"]: r for r in quality.judged(docs, measures="mm", verdict="vv").collect()}
    assert tuple(found[1]["mm"]) == (0,) * 7 and not found[1]["vv"]
    assert not found[7]["vv"]
    assert found[5]["mm"]["n_repeat_words"] > 39_000 and not found[5]["vv"]
    assert found[6]["mm"]["n_lines"] == 2


def test_jaccard(docs, none):
    found = jaccard.near_classes(docs).collect()
    classes = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found}
    assert len(found) == 9
    assert classes[1] == classes[2][:1] + (0,) == (1, 0)  # null and empty texts are equal
    # One set, three different texts, and the null id is the smallest.
    assert classes[3] == classes[None] == (None, 1) and classes[4] == (None, 1)
    assert classes[6] == (6, 0) and classes[7] == (7, 0)
    assert jaccard.near_classes(none).collect() == []
    kept = [r["doc_id"] for r in jaccard.one_of_each(docs).collect()]
    assert sorted(x or 0 for x in kept) == [0, 1, 5, 6, 6, 7]


def test_sharding(docs, none):
    rows = sharding.shard(docs).collect()
    assert len(rows) == 9
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {r["text_crc32"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert sharding.shard(none).collect() == []


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [0.5, 0.5]), (40, None), (60, []), (80, [nan, 1.0]), (100, [inf, 0.0]), (120, [None, 1.0]),
        (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0]), (20, [0.5, 0.5]), (None, [0.25, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = table.select("vec_id", topk.whole_vector("embedding", 64).alias("v"))
    found = topk.top_k(v, v.where(F.col("vec_id") % 20 == 0), 3, id_col="vec_id", vector_col="v")
    assert sorted(map(tuple, found.collect())) == [(20, 1, 1, 2048), (20, 2, 2, 2048), (20, 3, None, 512)]
    empty = v.limit(0)
    assert topk.top_k(empty, empty, 3, id_col="vec_id", vector_col="v").collect() == []


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, name, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1)], LABELS)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    made = stage(spark, docs, str(tmp_path))
    if name != corpus_pipeline.STAGES[-1][0]:
        assert made.columns == docs.columns
    made.collect()
    assert stage(spark, none, str(tmp_path)).collect() == []
