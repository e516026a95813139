"""Hard-negative mining against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import negatives

NAN, INF = float("nan"), float("inf")
LAST = 2**63 - 1


def mined(rows, positives=5, least=80):
    """What the operator must find: (anchor, positive, rank, negative, scores) in plain Python."""
    sound = [
        (LAST if i is None else i, label, v) for i, label, v in rows if label is not None and v is not None
    ]
    anchors = {(i, label, tuple(v)) for i, label, v in sound if i != LAST and i % 100 == 0}
    out = []
    for a, label, v in anchors:
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w in sound if i != a
        )
        same = [(-s, i) for s, i, other in scored if other == label][:positives]
        for p, (ps, pid) in enumerate(same, 1):
            fit = [(-s, i) for s, i, other in scored if other != label and least * ps <= -100 * s <= 100 * ps]
            out += [(a, pid, p, r, i, ps, s) for r, (s, i) in enumerate(fit[:5], 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, v array<long>").withColumn("key", F.lit("x"))
    made = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect()
    return sorted(tuple(LAST if c is None else c for c in r) for r in made)


@pytest.mark.parametrize("span", [3, 200, 2**28])
def test_random_rows(spark, monkeypatch, span):
    """Ties, repeated rows and anchors, short and empty vectors, a hot label, null ids, many blocks."""
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 90)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    draw = random.Random(span)
    rows = []
    for i in range(300):
        v = [draw.randint(-span, span) for _ in range(draw.choice([11, 11, 11, 3, 0]))]
        rows.append((draw.choice([i, i, i * 100, None]), draw.choice([1, 1, 1, 2, 3, None]), draw.choice([v, v, v, None])))
    rows += rows[:40]
    want = mined(rows)
    assert want and found(spark, rows) == want
    assert found(spark, rows, positives=2, least=95) == mined(rows, positives=2, least=95)


def test_rows_without_part(spark):
    raw = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [1.0, 0.4]), (3, 2, [NAN, 1.0]), (4, 2, [INF, 1.0]),
           (5, 2, [None, 1.0]), (6, 2, None), (7, None, [1.0, 0.5]), (8, 2, [])]
    table = spark.createDataFrame(raw, "vec_id long, label int, embedding array<float>")
    rows = table.select("vec_id", "label", negatives.whole_vector("embedding", 256).alias("v"))
    made = negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in made] == [(0, 1, 1, 1, 2, 256 * 256 + 128 * 128, 256 * 256 + 128 * 102)]
    assert negatives.hard_negatives(rows.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert negatives.hard_negatives(rows.where("vec_id > 0"), F.col("vec_id") % 100 == 0).collect() == []


def test_lookups_are_inner_products():
    rng = np.random.default_rng(4)
    for span in (1, 7, 300, 2**20, 2**30):
        v = rng.integers(-span, span, (50, 24))
        a = rng.integers(-span, span, (9, 24))
        planes = negatives.planes_for(int(v.min()), int(v.max()))
        got = negatives.scores(negatives.subset_tables(a, planes), negatives.bit_planes(v, planes))
        assert (got == v @ a.T).all()
