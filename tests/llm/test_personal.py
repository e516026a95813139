"""Personal data against plain Python, and the fitted models against plain versions of them."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import personal
from candlewick.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in value.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text or "") if good(kind, m[0])
    ]


def spans_of(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = personal.find_personal_data(df, **options).orderBy("doc_id").collect()
    return [[tuple(s) for s in r["personal"]] for r in rows]


def test_base_spans(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = QUERIES["op11_personal_data"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and any(r["spans"] for r in rows)
    for r in rows:
        want = base(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in want) for k in PATTERNS]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in PATTERNS] == [s for s in listed.split(",") if s]
        if not re.search(r"[0-9@]", texts[r["doc_id"]] or ""):
            assert r["spans"] == ""


def test_odd_texts(spark):
    """Matches that begin where the one before ends, long runs, code points beyond the BMP."""
    draw = random.Random(5)
    parts = ["a@b.c", "_d@e.f", "1.2.3.4", ".5.6", "999", "4111111111111111", " ", "-", "+1 (743) 555-3824", "+", "(", "😀é漢",
             "@", ".", "x", "4111 1111 1111 1111", "\n", "00", "256.1.1.1", "1.2.3.4.5.6.7.8", "a@b", "..c", "%", "+1+23 4567 89"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(1500)]
    texts += ["1" * 60_000, "1 " * 30_000, "a." * 40_000 + "@", "+" * 50_000, "1." * 40_000, "x" * 99_999 + "@y.z",
              "8.8.8.8 " * 1500, "+1 (743) 555-3824 " * 700, None, ""]
    model = personal.Model(weights=[-9.0] * personal.WEIGHTS)
    for text, got in zip(texts, spans_of(spark, texts, model=model), strict=True):
        assert got == base(text)


def em(patterns):
    """The label model in numpy."""
    prior, sides = np.full(personal.FAMILIES, 0.5), [np.array(personal._YES * 6), np.array(personal._NO * 6)]
    first = [s.copy() for s in sides]
    family = np.array([f for f, _, _ in patterns])
    places = np.array([[3 * j + v for j, v in enumerate(votes)] for _, votes, _ in patterns])
    n = np.array([x for _, _, x in patterns], float)
    for _ in range(personal.ROUNDS):
        yes = prior[family] * sides[0][places].prod(axis=1)
        no = (1 - prior[family]) * sides[1][places].prod(axis=1)
        p = yes / (yes + no)
        for k in range(personal.FAMILIES):
            own = family == k
            prior[k] = ((n * p)[own].sum() + 1) / (n[own].sum() + 2)
        for k, weight in enumerate((n * p, n * (1 - p))):
            hit = np.array([weight[(places == i).any(axis=1)].sum() for i in range(18)])
            sides[k] = (hit + personal.TRUST * first[k]) / (weight.sum() + personal.TRUST)
    return prior, *sides


def made_votes(n=4000, seed=1):
    """Votes of labelers with known reliability on spans with known truth."""
    draw = np.random.default_rng(seed)
    truth = draw.random(n) < 0.4
    right = np.array([0.9, 0.85, 0.8, 0.7, 0.6, 0.75])
    votes = np.where(draw.random((n, 6)) < 0.15, 1, np.where(draw.random((n, 6)) < right, 2 * truth[:, None], 2 - 2 * truth[:, None]))
    return truth, votes


def test_label_model(spark):
    truth, votes = made_votes()
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    patterns = [(0, v.tolist(), int(c)) for v, c in zip(kinds, counts, strict=True)]
    df = spark.createDataFrame(patterns, "family int, votes array<int>, n long")
    found = personal.label_model(df).first()["model"]
    prior, yes, no = em(patterns)
    assert np.allclose(found["prior"], prior) and np.allclose(found["yes"], yes) and np.allclose(found["no"], no)
    assert abs(found["prior"][0] - truth.mean()) < 0.05
    model = personal.Model(found["prior"], found["yes"], found["no"]).sql()
    scored = df.withColumn("r", F.struct("family", "votes")).withColumn("m", F.expr(model))
    p = {tuple(r["votes"]): r["p"] for r in scored.withColumn("p", F.expr(personal.posterior("m", "r"))).collect()}
    wrong = np.mean([(p[tuple(v)] > 0.5) != t for v, t in zip(votes.tolist(), truth, strict=True)])
    majority = np.mean([(sum(v) > 6) != t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert wrong < 0.1 and wrong <= majority


def test_classifier(spark):
    rows = []
    for places, n, yes in ([0, 9, 12], 100, 95.0), ([0, 8, 13], 80, 6.0), ([1, 9, 13], 50, 30.0):
        rows.append((places, n, yes))
    weights = personal.classifier(spark.createDataFrame(rows, "places array<int>, n long, yes double")).first()["weights"]
    want = np.zeros(personal.WEIGHTS)
    for _ in range(personal.STEPS):
        slope = personal.RIDGE * want
        for places, n, yes in rows:
            miss = (n / (1 + math.exp(-want[places].sum())) - yes) / 230
            slope[places] += miss
        want = want - 4 / len(personal.FEATURES) * slope
    assert np.allclose(weights, want)


@pytest.fixture(scope="module")
def corpus():
    """Looser personal data among look-alikes, many of each, as the fit needs them."""
    draw = random.Random(2)

    def digits(n):
        return "".join(draw.choices("0123456789", k=n))

    def card():
        body = str(draw.choice([4, 5])) + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def iban():
        body = digits(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    real, false = [], []
    for _ in range(120):
        real += [f"Call me at ({draw.randint(200, 989)}) {draw.randint(200, 989)}-{digits(4)} today.",
                 f"mail jane{digits(2)} (at) mail{digits(1)} (dot) com for more", f"the account {iban()} is mine",
                 f"card {card()} please", f"phone +49 30 {digits(7)} now", f"address 8.{draw.randint(1, 254)}.4.{draw.randint(1, 254)} here"]
        false += [f"version 3.{draw.randint(256, 999)}.{draw.randint(256, 900)}.0000 of", f'id="{digits(13)}x"', f"build 0.0.{digits(4)}.0000",
                  f"hash {digits(14)}ab", "sku=123-000-0000", "order XX000000000000000000"]
    return real, false


def test_looser_kinds(spark, corpus):
    real, false = corpus
    found = spans_of(spark, real + false)
    hits = sum(bool(s) for s in found[: len(real)])
    alarms = [s for text, s in zip(false, found[len(real) :], strict=True) if [x for x in s if x not in base(text)]]
    assert hits >= 0.98 * len(real) and len(alarms) <= 0.02 * len(false)
    kinds = {s[0] for spans in found[: len(real)] for s in spans}
    assert {"phone_local", "email_spelled", "iban", "card", "phone", "ip"} <= kinds


def test_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "a@b.de", 2), (1, "a@b.de", 2)], "doc_id long, text string, strict int")
    df = df.withColumns({c: F.lit(c) for c in ("__candidates", "__candidates_part0", "c", "start", "family")})
    made = personal.find_personal_data(df)
    assert made.columns == [*df.columns, "personal"]
    rows = made.collect()
    assert sorted(len(r["personal"]) for r in rows) == [0, 1, 1] and {r["__candidates_part0"] for r in rows} == {"__candidates_part0"}
    assert personal.find_personal_data(df.limit(0)).collect() == []
