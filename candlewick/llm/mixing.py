"""Mixing to target weights with soft membership.

A classifier learnt from the labelled table gives every document posteriors over domains. Rates
(expected copies, not negative) are then fitted by least squares, so that the expected tokens
of each domain meet the targets: projected gradient descent with momentum over all documents, where a round
sends out the residuals of the domains and gets back their totals. A rate depends on nothing but
the document's posteriors and the residuals so far, so rates are never stored or collected.

Defined cases: a null or empty text has no tokens; its rate follows from its posteriors like any
other. Labels with nulls are left out; labels of one id are merged (any toxic, any low quality).
Without labels every document is of the first domain, and a domain without labels has posteriors
near zero. Repeated rows count as often as they occur and get the same rate. Targets that cannot be
met are approached as least squares allow, in MAX_ROUNDS rounds. Other columns are passed on.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import discard, free_name, id_or_lowest, small_batches, stored, texts

DOMAINS = ("clean", "noisy", "toxic")
TARGETS = {"clean": 0.90, "noisy": 0.08, "toxic": 0.02}
BUCKETS = 1 << 20
#: Word hashes met in fewer labelled documents say nothing; their log-odds are zero.
LEAST = 5
#: Labelled documents that the weights of the features are fitted on at most, by least hash.
SAMPLE = 20_000
SHRINK = 10.0
MAX_ROUNDS = 100
#: The error of a fit has settled when it varies by less than TOLERANCE of itself over so many rounds.
SETTLED_ROUNDS = 10
TOLERANCE = 1e-4
_EDGES = b".,;:!?#*$%&|<>\"'()[]"
_SYMBOLS = b"#*$%&|<>!"


# -- features ----------------------------------------------------------------------


_STEP = 0xFFFF


def packed(own: np.ndarray) -> bytes:
    """Ascending numbers as 16-bit gaps; a gap of _STEP or more takes several, of which only the last is less."""
    whole, rest = np.divmod(np.diff(own, prepend=0), _STEP)
    out = np.full(len(own) + int(whole.sum()), _STEP, np.uint16)
    out[np.cumsum(whole + 1) - 1] = rest
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint16)
    return np.cumsum(gaps, dtype=np.int64)[gaps != _STEP]


def bag(data: bytes) -> tuple[int, bytes, list[float]]:
    """Number of words, hashes of the different words, and measures of form."""
    words = [w.strip(_EDGES) for w in data.lower().split()]
    n = len(words)
    if not n:
        return 0, b"", [0.0] * 5
    codes = np.fromiter(map(xxhash.xxh64_intdigest, set(words)), np.uint64)
    own = np.unique(codes & np.uint64(BUCKETS - 1)).astype(np.int64)
    upper = sum(map(len, words)) and int(
        np.count_nonzero(np.frombuffer(data, np.uint8) - 65 < np.uint8(26))
    )
    symbols = sum(data.count(_SYMBOLS[i : i + 1]) for i in range(len(_SYMBOLS)))
    form = [
        min(symbols / n, 3.0), min(upper / n, 5.0), len(set(words)) / n, min(len(data) / n, 20.0),
        float(np.log1p(n)),
    ]
    return n, packed(own), form


def _bags(text: pa.Array) -> pa.Array:
    rows = [bag(value) for value in texts(text)]
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.float64()))
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tokens", "bag", "form"]
    )


def with_bags(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    make = F.arrow_udf(_bags, "tokens long, bag binary, form array<double>")
    return small_batches(docs).withColumn(name, make(F.col(text_col).cast("string")))


# -- classifier --------------------------------------------------------------------


@dataclass
class Classifier:
    """Log-odds of word hashes for each domain, and softmax weights over features made of them."""

    odds: np.ndarray = field(default_factory=lambda: np.zeros((len(DOMAINS), BUCKETS), np.float32))
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def features(self, bags: list[bytes], forms: list[list[float]]) -> np.ndarray:
        out = np.zeros((len(bags), len(DOMAINS) * 3 + 5))
        for i, (data, form) in enumerate(zip(bags, forms, strict=True)):
            own = self.odds[:, unpacked(data)]
            if own.shape[1]:
                top = -np.sort(-own, axis=1)[:, :2]
                out[i, :6] = top.ravel() if top.shape[1] == 2 else np.repeat(top.ravel(), 2)
                out[i, 6:9] = own.mean(axis=1)
            out[i, 9:] = form
        return out

    def posteriors(self, bags: list[bytes], forms: list[list[float]]) -> np.ndarray:
        if self.weights is None:
            return np.tile(np.eye(len(DOMAINS))[0], (len(bags), 1))
        x = (self.features(bags, forms) - self.mean) / self.scale
        return _softmax(np.c_[x, np.ones(len(x))] @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).otherwise(0)


def _class_counts(batches):
    """Documents of each domain that have each word hash: one partial table per task."""
    counts = np.zeros((len(DOMAINS), BUCKETS), np.int64)
    for batch in batches:
        for data, domain in zip(batch.column("bag").to_pylist(), batch.column("domain").to_pylist(), strict=True):
            counts[domain, unpacked(data)] += 1
    hit = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch(
        [pa.array(hit), *(pa.array(c[hit]) for c in counts)], ["bucket", *(f"c{k}" for k in range(len(DOMAINS)))]
    )


def fit_classifier(bags: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> Classifier:
    """Learn from labelled rows of ``bags`` (id, b): word counts from one half of them, which all
    are counted, and the softmax from at most SAMPLE rows of the other half."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(id_or_lowest(id_col).alias("id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    )
    rows = stored(
        bags.join(known, "id").select(
            "id", "b.bag", "b.form", domain_of(F.col("q"), F.col("t")).cast("int").alias("domain"),
            F.xxhash64("id", F.lit("half")).alias("draw"),
        ),
        "labelled",
    )
    fields = ", ".join(["bucket long", *(f"c{k} long" for k in range(len(DOMAINS)))])
    half = F.col("draw") < 0
    # At most BUCKETS rows come back, whatever the number of documents.
    counts = np.zeros((len(DOMAINS), BUCKETS))
    summed = rows.where(half).select("bag", "domain").mapInArrow(_class_counts, fields)
    names = [f"c{k}" for k in range(len(DOMAINS))]
    found = summed.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    found = found.where(sum((F.col(c) for c in names), F.lit(0)) >= LEAST).toArrow()
    counts[:, found["bucket"].to_numpy()] = [found[c].to_numpy() for c in names]
    sizes = {r["domain"]: r["n"] for r in rows.where(half).groupBy("domain").agg(F.count("*").alias("n")).collect()}
    share = np.array([sizes.get(k, 0) for k in range(len(DOMAINS))], float)
    sample = rows.where(~half).orderBy("draw", "id").limit(SAMPLE).select("bag", "form", "domain").toPandas()
    model = Classifier()
    if not len(sample):
        return model
    share /= max(share.sum(), 1)
    seen = counts.sum(axis=0)
    for k in np.flatnonzero((share > 0) & (share < 1)):
        inside, outside = counts[k] + SHRINK * share[k], seen - counts[k] + SHRINK * (1 - share[k])
        odds = np.log(inside / outside) - np.log(share[k] / (1 - share[k]))
        model.odds[k] = np.where(seen > 0, odds, 0)
    x = model.features(list(sample["bag"]), [list(f) for f in sample["form"]])
    model.mean, model.scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    model.weights = _softmax_fit(
        np.c_[(x - model.mean) / model.scale, np.ones(len(x))], sample["domain"].to_numpy()
    )
    return model


def _softmax_fit(x: np.ndarray, y: np.ndarray, penalty: float = 2.0, rounds: int = 1500) -> np.ndarray:
    """Ridge softmax regression by accelerated gradient descent."""
    ridge = penalty / len(x)
    goal = np.eye(len(DOMAINS))[y]
    step = 1 / (np.linalg.norm(x, 2) ** 2 / (2 * len(x)) + ridge)
    w = before = np.zeros((x.shape[1], len(DOMAINS)))
    for t in range(rounds):
        ahead = w + t / (t + 3) * (w - before)
        slope = x.T @ (_softmax(x @ ahead) - goal) / len(x) + ridge * ahead
        before, w = w, ahead - step * slope
    return w


def with_posteriors(bags: DataFrame, model: Classifier, bag_col: str, name: str) -> DataFrame:
    def predict(data: pa.Array, form: pa.Array) -> pa.Array:
        p = model.posteriors(data.to_pylist(), form.to_pylist())
        ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(DOMAINS))
        return pa.ListArray.from_arrays(ends, pa.array(p.ravel()))

    udf = F.arrow_udf(predict, "array<double>")
    return bags.withColumn(name, udf(F.col(bag_col)["bag"], F.col(bag_col)["form"]))


# -- rates -------------------------------------------------------------------------


@dataclass
class Rates:
    """What fixes the rate of every document: the start, and steps and momentum of all rounds."""

    start: float
    cap: float | None
    steps: list[tuple[np.ndarray, float]] = field(default_factory=list)
    totals: np.ndarray | None = None
    #: A domain whose documents, by their largest posterior, keep at least the rate they start with.
    keep: int | None = None
    converged: bool = False

    def of(self, p: np.ndarray) -> np.ndarray:
        """Rates for rows of posteriors: gradient steps from the start, carried on by the momentum,
        both projected."""
        last = ahead = np.full(len(p), self.start)
        low = 0 if self.keep is None else np.where(p.argmax(axis=1) == self.keep, self.start, 0)
        for step, momentum in self.steps:
            r = np.clip(ahead - p @ step, low, self.cap)
            ahead = np.clip(r + momentum * (r - last), low, self.cap)
            last = r
        return ahead


def _posterior_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(DOMAINS))


def _totals(rows: DataFrame, rates: Rates) -> np.ndarray:
    """Expected tokens of each domain under ``rates``, summed over all rows (tokens, p)."""
    names = [f"e{k}" for k in range(len(DOMAINS))]

    def partial(batches):
        total = np.zeros(len(DOMAINS))
        for batch in batches:
            p = _posterior_matrix(batch.column("p"))
            total += (rates.of(p) * batch.column("tokens").to_numpy()) @ p
        yield pa.record_batch([pa.array([x]) for x in total], names)

    summed = rows.select("tokens", "p").mapInArrow(partial, ", ".join(f"{n} double" for n in names))
    row = summed.agg(*[F.sum(n).alias(n) for n in names]).first()
    return np.array([row[n] or 0.0 for n in names])


def fit_rates(rows: DataFrame, targets: dict[str, float], *, tokens: float | None = None,
              cap: float | None = None, keep: str | None = None) -> Rates:
    """Rates for rows (tokens, p) whose expected domain tokens are ``targets`` times ``tokens``
    (by default all there are).

    Residuals are weighed by the inverse of the target, and documents by their tokens, which
    makes a step the same for short and long texts. Rounds end when no domain misses its target
    by more than TOLERANCE of all tokens, or when totals no longer change. A fit that does neither in
    MAX_ROUNDS rounds gives a warning, unless its error has settled, as where a target cannot be met.
    """
    gram = rows.agg(
        *[
            F.sum(F.col("tokens") * F.col("p")[i] * F.col("p")[j]).alias(f"g{i}{j}")
            for i in range(len(DOMAINS)) for j in range(len(DOMAINS))
        ]
    ).first()
    gram = np.array([x or 0.0 for x in gram]).reshape(len(DOMAINS), -1)
    every = max(float(gram.sum()), 1.0)
    wanted = np.array([targets[d] for d in DOMAINS])
    goal = wanted / wanted.sum() * (every if tokens is None else tokens)
    weigh = 1 / np.maximum(goal, 0.01 * every)
    curve = np.sqrt(weigh)[:, None] * gram * np.sqrt(weigh)[None, :]
    pace = 1 / max(float(np.linalg.eigvalsh(curve)[-1]), 1e-12)
    rates = Rates(start=min(1.0, cap) if cap else 1.0, cap=cap, keep=DOMAINS.index(keep) if keep else None)
    lowest, since, errors = np.inf, 0, []
    for _ in range(MAX_ROUNDS):
        before, rates.totals = rates.totals, _totals(rows, rates)
        miss = rates.totals - goal
        still = before is not None and np.abs(rates.totals - before).max() <= 1e-3 * TOLERANCE * every
        if still or np.abs(miss).max() <= TOLERANCE * every:
            rates.converged = True
            break
        error = float(weigh @ miss**2)
        # Momentum that has led uphill is given up and gathered anew.
        since = since + 1 if error < lowest else 0
        lowest = error
        errors.append(error)
        rates.steps.append((pace * weigh * miss, since / (since + 3)))
    if len(errors) > SETTLED_ROUNDS and np.ptp(errors[-SETTLED_ROUNDS - 1 :]) <= TOLERANCE * errors[-1]:
        rates.converged = True
    if not rates.converged:
        warnings.warn(f"rates still change after {MAX_ROUNDS} rounds; missed by {miss.tolist()} tokens", stacklevel=2)
    return rates


def rate_column(rates: Rates, p: Column) -> Column:
    def rate(column: pa.Array) -> pa.Array:
        return pa.array(rates.of(_posterior_matrix(column)))

    return F.arrow_udf(rate, "double")(p)


def copies(rate: Column, key: Column) -> Column:
    """Whole copies whose mean is the rate: the fraction is drawn by a hash of the key."""
    draw = (F.shiftrightunsigned(F.xxhash64(key, F.lit("copies")), 11) / F.lit(float(2**53)))
    return F.floor(rate + draw).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, *,
          cap: float | None = None, fill: str | None = None, keep: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", name: str = "mix",
          columns: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct: tokens, posteriors p, rate and copies.

    With ``fill`` the total is chosen so that this domain's target is all it has. Documents that are
    most likely of the domain ``keep`` keep at least one copy. ``columns`` names those to pass on, by
    default all; without the text among them every text is read once, else a second time at the end.
    """
    passed = docs.columns if columns is None else columns
    again = text_col in passed
    carried = [] if again else passed
    b, p, key = free_name(docs, "__bag"), free_name(docs, "__p"), free_name(docs, "__id")
    named = docs.withColumn(key, id_or_lowest(id_col))
    bags = stored(with_bags(named, b, text_col).select(key, b, *[f"`{c}`" for c in carried]), "bags")
    model = fit_classifier(bags.select(F.col(key).alias("id"), F.col(b).alias("b")), labels, id_col=id_col)
    found = stored(
        with_posteriors(bags, model, b, p).withColumn(b, F.struct(F.col(b)["tokens"].alias("tokens"))).drop(key),
        "posteriors",
    )
    discard(bags)
    rows = found.select(F.col(b)["tokens"].alias("tokens"), F.col(p).alias("p"))
    targets = targets or TARGETS
    tokens = None
    if fill:
        own = rows.agg(F.sum(F.col("tokens") * F.col("p")[DOMAINS.index(fill)])).first()[0] or 0.0
        tokens = own * sum(targets.values()) / targets[fill]
    rates = fit_rates(rows, targets, tokens=tokens, cap=cap, keep=keep)
    whole = with_posteriors(with_bags(docs, b, text_col), model, b, p) if again else found
    rate = free_name(docs, "__rate")
    return whole.withColumn(rate, rate_column(rates, F.col(p))).select(
        *[f"`{c}`" for c in passed],
        F.struct(
            F.col(b)["tokens"].alias("tokens"), F.col(p).alias("p"), F.col(rate).alias("rate"),
            copies(F.col(rate), F.col(id_col)).alias("copies"),
        ).alias(name),
    )
