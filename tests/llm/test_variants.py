"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from candlewick.llm import variants
from candlewick.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def grouped(counts, factor=5):
    letters = sorted({c for w in counts for c in w})
    near = {w: {v for v in edits(w, letters) if v in counts and v != w} for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= factor * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def as_dict(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("per_range", [2, 7, 20_000])
def test_random_words(spark, monkeypatch, per_range):
    """Runs of equal letters, prefixes of each other, ties, chains of forms; many small ranges."""
    monkeypatch.setattr(variants, "RANGE_WORDS", per_range)
    draw = random.Random(per_range)
    words = {"".join(draw.choices("abcé", [5, 2, 1, 1], k=draw.randint(1, 6))) for _ in range(250)}
    counts = {w: draw.choice([1, 1, 2, 5, 5, 25, 26, 125, 700]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n int")
    assert as_dict(variants.spelling_variants(df)) == grouped(counts)
    assert as_dict(variants.spelling_variants(df, factor=2)) == grouped(counts, 2)


def test_long_chains_and_words(spark):
    long = "ab" * 5000
    counts = {"a" * k: 5**k for k in range(1, 14)} | {long: 1, long + "b": 9, long[:-1]: 2, "z": 1}
    found = as_dict(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found["a"] == ("aa", "a" * 13, 5, 2, 25)  # "aa" and "z"
    assert found["a" * 13] == (None, "a" * 13, 5**13, 1, None)
    assert found[long] == (long + "b", long + "b", 1, 2, 9) and found[long[:-1]][3] == 1
    assert as_dict(variants.spelling_variants(spark.createDataFrame([], "word string, n long"))) == {}


def counted(rows, min_chars=6, min_count=5, every=199):
    out = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_chars and n >= min_count}


def test_counting(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD_WORDS", 3)
    text = "Straße ÀÉÎÕÜ ÀÉÎÕÜÿ naïveté×÷ word 漢字abcdef😀ghijkl x_y abcDEF2ghi É́clair"
    rows = [(1, text), (2, text), (2, text), (None, text), (3, None), (4, ""), (5, "word " * 9 + "y" * 50_000)]
    rows += [(i, f"hundred thousand {text}") for i in range(10, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1))
    for every in (199, 3, 1):
        got = variants.word_counts(df, typo_every=every).collect()
        assert {r["word"]: r["n"] for r in got} == counted(rows, every=every)
    assert variants.word_counts(df.limit(0)).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = grouped(counted(rows))
    assert any(w[0] for w in want.values())
    assert as_dict(QUERIES["op12_spelling_variants"](spark, FOLDER)) == want
