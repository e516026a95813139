"""The queries on the smallest tables against plain Python, or against their SQL."""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))
FOLDER = "/root/testdata/sf0.001"

import corpus_pipeline  # noqa: E402
from candlewick.llm import mixing, passages, pieces, quality, secrets, sharding, urls  # noqa: E402
from candlewick.llm.common import table  # noqa: E402
from candlewick.llm.jaccard import near_classes, runs_for, survival  # noqa: E402
from candlewick.llm.queries import ORACLES, QUERIES, piece_model  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}


def shingles(text: str) -> frozenset:
    words = text.lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups_of(sets: dict[int, frozenset]) -> tuple[dict[int, int], dict[int, set[int]]]:
    """Smallest id of the group of each document, and its similar other documents."""
    near = defaultdict(set)
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0:
            near[a].add(b)
            near[b].add(a)
    head = {}
    for doc in sorted(sets):
        if doc not in head:
            left = [doc]
            while left:
                x = left.pop()
                if x not in head:
                    head[x] = doc
                    left += near[x]
    return head, near


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    from check_oracles import connect, difference

    theirs = connect(FOLDER).execute(ORACLES[name]).df()
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), theirs) is None


def test_mixing(spark):
    rows = QUERIES["op1_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    p = rows[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and (rows["rate"] >= 0).all()
    expected = ((rows["rate"] * rows["n_tokens"]).to_numpy()[:, None] * p).sum(axis=0)
    wanted = rows["n_tokens"].sum() * np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    assert np.abs(expected - wanted).max() < 0.01 * rows["n_tokens"].sum()
    assert (np.abs(rows["copies"] - rows["rate"]) < 1).all()


def test_rates_meet_targets_as_closed_form_does(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([1, 1, 1], 300)
    tokens = rng.integers(1, 500, 300)
    df = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p, strict=True)], "tokens long, p array<double>")
    rates = mixing.fit_rates(df, {"clean": 0.5, "noisy": 0.3, "toxic": 0.2})
    got = (rates.of(p) * tokens) @ p
    assert np.allclose(got, tokens.sum() * np.array([0.5, 0.3, 0.2]), atol=2e-4 * tokens.sum())


def test_classifier_on_held_out_labels(spark):
    """Trained on the labels of even ids, right on those of odd ones."""
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    mixed = mixing.mixed(docs.select("doc_id", "text"), labels.where("doc_id % 2 = 0"))
    seen = mixed.join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    noisy = np.array([m["p"][1] for m in seen["mix"]])
    assert noisy[seen["quality"] == 0].mean() > 0.5 > 0.1 > noisy[seen["quality"] == 1].mean()


def test_passages(spark, texts):
    rows = QUERIES["op2_substring_dedup"](spark, FOLDER).toPandas().set_index("doc_id")

    def sharing(width):
        found = defaultdict(set)
        for doc, text in texts.items():
            words = text.lower().split()
            for i in range(len(words) - width + 1):
                found[tuple(words[i : i + width])].add(doc)
        return {d for docs in found.values() if len(docs) > 1 for d in docs}

    flagged = set(rows.index[rows["n_stretches"] > 0])
    assert sharing(51) <= flagged
    lines = {d: [shingles(x) for x in t.split("\n") if len(x.split()) >= passages.PARAGRAPH] for d, t in texts.items()}
    similar = {
        d for a, b in itertools.combinations(lines, 2) for x in lines[a] for y in lines[b]
        if 5 * len(x & y) >= 4 * len(x | y) for d in (a, b)
    }
    assert similar <= flagged <= sharing(passages.WINDOW) | similar
    for doc, spans in rows["removed"].items():
        ends = [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]
        assert all(a < b for a, b in ends) and all(x[1] < y[0] for x, y in zip(ends, ends[1:], strict=False))
        assert all(b <= len(texts[doc]) for _, b in ends)


def test_secrets(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op3_secret_scan"](spark, FOLDER).collect()}
    for doc, text in texts.items():
        base = []
        for kind, pattern, least, group in (
            ("assign", secrets.ASSIGN, 6, 2), ("access", secrets.ACCESS, 20, 0), ("hex", secrets.HEX, 24, 0),
        ):
            base += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
        base.sort(key=lambda s: (s[0], secrets.KINDS.index(s[1])))
        joined = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        assert rows[doc]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        counts = Counter(k for _, k, _ in base)
        assert [rows[doc][f"n_{k}"] for k in secrets.BASE_KINDS] == [counts[k] for k in secrets.BASE_KINDS]


def test_entropy_runs_match_windows_counted_afresh():
    import math
    import random

    random.seed(5)
    for _ in range(200):
        value = "".join(random.choice("0123456789abcdefXYZ+/") for _ in range(random.randint(10, 60)))
        marked = defaultdict(set)
        for i in range(len(value) - secrets.WINDOW + 1):
            part = value[i : i + secrets.WINDOW]
            kind = next(((n, b) for n, m, b in secrets.CLASSES if set(part) <= m), None)
            bits = -sum(c / len(part) * math.log2(c / len(part)) for c in Counter(part).values())
            if kind and bits >= kind[1] - 1e-9:
                marked[kind[0]] |= set(range(i, i + secrets.WINDOW))
        runs = defaultdict(set)
        for kind, start, end in secrets.entropy_runs(value):
            runs[kind] |= set(range(start, end))
        assert runs == marked


def test_secret_shapes():
    kinds = lambda text: [k for k, _, _ in secrets.secret_spans(text)]
    assert "entropy_base64" in kinds("x Zk3vQ9rT1uYw8sLm2Np4Xa7B y")
    assert kinds("123e4567-e89b-12d3-a456-426614174000") == []
    assert kinds("http://a/some/long/path/of/plain/words") == []
    assert kinds("tokenK = abcdef123") == [] and kinds("TOKEN: 'abc-123'") == ["assign"]
    assert kinds("to\u212aen = abcdef") == []  # only letters of ASCII fold


def test_sharding(spark, texts):
    rows = QUERIES["op5_sharding"](spark, FOLDER).toPandas()
    assert len(rows) == len(texts) and set(rows["law"]) == {"bytes"} and rows["grown_shard"].isna().all()
    assert all(s == len(texts[d].encode()) + 1 for d, s in zip(rows["doc_id"], rows["size"], strict=True))
    sizes = rows.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 0.05 * sizes.mean()
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_packing_takes_the_highest_dot_product():
    items = np.array([[5, 0, 1], [0, 5, 1], [4, 1, 1], [1, 4, 1]], float)
    placed = sharding.pack(items, 2)
    totals = np.array([items[placed == k].sum(axis=0) for k in range(2)])
    assert np.abs(totals[0] - totals[1]).max() <= 2


def test_pieces(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for r in QUERIES["op7_sentencepiece"](spark, FOLDER).collect():
        ids = model.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_texts():
    import random

    chunks = pieces.ChunkTable(piece_model(), size=40)  # is started anew again and again
    random.seed(2)
    parts = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "漢", "\x00", "\r\n", "12", "😀", "<s>", "<unk>", "<0x0A>", " "]
    values = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(3000)]
    for i in range(0, len(values), 30):
        ids, back = chunks.encode([v.encode() for v in values[i : i + 30]])
        for v, got, text in zip(values[i : i + 30], ids.to_pylist(), back.to_pylist(), strict=True):
            assert got == chunks.model.encode(v) and text == chunks.model.decode(got)


def test_jaccard(spark, texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    head, near = groups_of(sets)
    for r in QUERIES["op9_ngram_jaccard"](spark, FOLDER).collect():
        doc = r["doc_id"]
        others = {texts[d] for d in near[doc]} - {texts[doc]}
        assert (r["class_id"], r["n_links"]) == (head[doc], len(others))


def test_runs_reach_the_recall():
    q = survival(0.8, 12)
    assert 1 - (1 - q) ** runs_for(0.999, 0.8) >= 0.999


def test_the_bit_set_loses_no_id(spark):
    from pyspark.sql import functions as F

    from candlewick.llm.jaccard import with_ids

    docs = spark.range(20_000).select((F.col("id") * 7 - 500).alias("doc"), F.lit("t").alias("text"))
    ids = spark.range(0, 20_000, 13).select((F.col("id") * 7 - 500).alias("doc"))
    assert with_ids(docs, ids).count() == ids.count()
    assert with_ids(docs, ids.limit(0)).count() == 0


def test_large_groups_of_near_copies(spark):
    """A group larger than a block: every pair is still counted once."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(700)] + [(1000 + i, f"alone number {i} of several texts") for i in range(50)]
    found = {r["doc_id"]: r for r in near_classes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((found[i]["class_id"], found[i]["n_links"]) == (0, 699) for i in range(700))
    assert all(found[1000 + i]["n_links"] == 0 for i in range(50))


def test_pipeline(spark):
    """run() against the stages in plain Python; the mixing stage is checked by its decisions."""
    folder = "/root/testdata/sf0.01"
    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    docs = table(spark, folder, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    kept = {r["doc_id"] for r in quality.judged(docs).where("kept").collect()}
    owners = defaultdict(set)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for d in kept:
        for line in texts[d].split("\n"):
            if len(key(line)) >= 20:
                owners[key(line)].add(d)
    left = {
        d: "\n".join(x for x in texts[d].split("\n") if len(owners[key(x)]) < 3 or max(owners[key(x)]) == d)
        for d in kept
    }
    head, _ = groups_of({d: shingles(t) for d, t in left.items()})
    heads = {d for d in left if head[d] == d}
    assert set(final) <= heads
    labels = {r["doc_id"]: r for r in table(spark, folder, "labels").collect()}
    clean = {d for d in heads if d in labels and (labels[d]["quality"], labels[d]["toxic"]) == (1, 0)}
    assert len(clean & set(final)) >= 0.95 * len(clean)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for d, r in final.items():
        assert list(r["ids"]) == model.encode(left[d]) and r["round_trip"]


@pytest.mark.parametrize("per_task", [7, 500_000])
def test_components(spark, monkeypatch, per_task):
    """Chains, rings and stars, contracted in one task or across many."""
    from candlewick.llm import components

    monkeypatch.setattr(components, "TASK_EDGES", per_task)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(205, 203), (203, 204), (204, 205), (7, 7)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys((203, 204, 205), 203)}
    assert len(got) == len(want) and {r["node"]: r["label"] for r in got} == want


def test_word_bags_survive_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 400):
        own = np.unique(rng.integers(0, mixing.BUCKETS, n))
        assert (mixing.unpacked(mixing.packed(own)) == own).all()
    edges = np.array([0, 65534, 131069, 262139])
    assert (mixing.unpacked(mixing.packed(edges)) == edges).all()


def test_edited_paragraphs_are_one_cluster(spark):
    """Copies of a paragraph with one word changed, below lines that no other document has."""
    import random

    draw = random.Random(3)
    base = [f"word{draw.randint(0, 9999)}" for _ in range(70)]
    rows = []
    for i in range(30):
        words = list(base)
        words[draw.randint(0, 69)] = f"edit{i}"
        rows.append((i, " ".join(f"a{i}_{k}" for k in range(60)) + "\n" + " ".join(words)))
    rows += [(100 + i, " ".join(f"c{i}_{k}" for k in range(120))) for i in range(10)]
    found = {
        r["doc_id"]: r["repeats"]
        for r in passages.marked_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert {found[i]["class_id"] for i in range(30)} == {0} and found[0]["removed"] == []
    for i in range(1, 30):
        (span,) = found[i]["removed"]
        assert (span["start"], span["end"]) == (rows[i][1].index("\n") + 1, len(rows[i][1]))
    assert all(found[100 + i]["n_stretches"] == 0 for i in range(10))


def test_host_rules_do_not_read_the_query():
    rules = urls.Filter.of()
    assert rules.judge("http://evil.org?x=.com/") == ("evil.org", "", None, "allow")
    assert rules.judge("http://a.org?.net/es/") == ("a.org", "", None, "allow")
    assert rules.judge("http://a.org/x?sessionid=1") == ("a.org", "/x", None, "block")
    assert rules.judge("http://b.net/es/?q") == ("b.net", "/es/", "net/es/", "block")


def test_kept_domain_and_convergence(spark):
    """Rates against least squares by scipy-free projected steps run to the end; kept ones stay at one."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.5, 0.5, 0.5], 400)
    tokens = rng.integers(1, 200, 400)
    rows = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p, strict=True)], "tokens long, p array<double>")
    rates = mixing.fit_rates(rows, {"clean": 0.9, "noisy": 0.08, "toxic": 0.02}, cap=1.0, keep="clean")
    got = rates.of(p)
    mine = p.argmax(axis=1) == 0
    assert rates.converged and (got[mine] == 1).all() and got[~mine].max() <= 1
    goal = np.array([0.9, 0.08, 0.02]) * tokens.sum()
    weigh = 1 / np.maximum(goal, 0.01 * tokens.sum())

    def error(r):
        return float(weigh @ ((r * tokens) @ p - goal) ** 2)

    best = np.ones(400)
    for _ in range(20000):
        slope = p @ (weigh * ((best * tokens) @ p - goal))
        best = np.where(mine, 1.0, np.clip(best - 1e-3 * slope, 0, 1))
    assert error(got) <= error(best) * 1.01 + 1
