"""Personal data by weak supervision, in SQL functions alone.

Patterns find candidates: e-mail and IP addresses, card and phone numbers, each also in looser forms.
Labelers vote on each candidate for, against, or not at all: the strict pattern, a checksum or
structure, gazetteers (top-level domains, card issuers, calling codes, reserved networks), the
characters beside it, the words before it, and the variety of its digits. Expectation-maximisation over
the counted patterns of votes estimates how reliable each labeler is and how likely each pattern is
personal data. On these soft labels a logistic classifier of spans is trained; it decides which
candidates beyond the strict ones become spans. Strict ones always are.

Votes and features take few values, so their counted patterns are a small table whatever the number
of documents (at most 8 * 3**6 rows of votes). EM and training run over it as one SQL aggregate; what
comes to the driver are the fitted numbers. Texts are read twice, to count votes and to decide.

Matches are those of a leftmost search without overlaps. Look-behinds and possessive quantifiers in the
patterns change no match; they keep the search linear and its stack flat on long runs.

Defined cases: a null text is empty and has no spans. Offsets are code points, ends exclusive. Rows
are searched one by one, so repeated rows and ids need no care; each counts in the fit. An empty table
gives an empty result. Spans of the looser kinds that overlap a strict one are left out. Other columns,
whatever their names, are passed on; the new column must have a name of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import discard, free_name, stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (
    *BASE_KINDS, "ip_like", "card_part", "email_spelled", "phone_local", "iban",
)

# Gazetteers of top-level domains and of country codes in account numbers.
DOMAINS = (
    "com", "org", "net", "edu", "gov", "info", "io", "biz", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at",
    "us", "ca", "au", "in", "jp", "cn", "br", "mx", "ru", "pl", "se",
)
COUNTRIES = (
    "AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IT", "LT",
    "LU", "LV", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK",
)
# Card issuers by their first digits, calling codes, reserved networks.
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6)"
CALLING = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^(0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|^192\.168\.|^169\.254\."
#: Words before a span that speak for personal data, and against it.
FOR = (
    r"(?i)\b(e-?mail|mail|contact|write|phone|tel|call|mobile|cell|fax|card|visa|iban|account|ssn|social|host|"
    r"address|addr|ip|from|client)\b\W*\w*\W*$"
)
AGAINST = r"(?i)(\b(version|release|rev|section|chapter|isbn|issn|order|invoice|sku|build|sha\d*|hash|rfc)\b\W*|\bv)$"

CONTEXT = 32
#: Matches whose places are added up in one go, so that many matches in a text stay cheap.
ADDED = 512
ROUNDS, STEPS = 40, 200
#: Weight of the first guess at the labelers' reliability, in candidates.
TRUST = 20.0
RIDGE = 1e-3


# -- SQL text ------------------------------------------------------------------------
# Expressions are written as SQL, which Spark parses at once; made call by call from Python
# they would take longer than a small table.


def _raw(pattern: str) -> str:
    return f"r'{pattern}'"


def _let(name: str, value: str, use: str) -> str:
    """``use`` of ``name``, a value that is worked out once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _listing(values, quote: str = "'") -> str:
    return ", ".join(f"{quote}{v}{quote}" for v in values)


def _doubles(values) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def _vote(for_: str, against: str | None = None) -> str:
    """1 for, -1 against (by default: not for), 0 undecided."""
    no = f"NOT ({for_})" if against is None else against
    return f"CASE WHEN coalesce({for_}, false) THEN 1 WHEN coalesce({no}, true) THEN -1 ELSE 0 END"


# -- candidates ----------------------------------------------------------------------

_DIGITS = "regexp_replace(v, '[^0-9]', '')"
#: Of the end alone, as this pattern begins anew at every character.
_TLD = "lower(regexp_extract(right(v, 64), '([A-Za-z0-9-]+)$', 1))"
#: The check digit of a card number: every second digit from the right doubled, their digits added up.
LUHN = (
    f"aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) -> CASE WHEN i % 2 = 0 THEN int(d) "
    "WHEN int(d) > 4 THEN 2 * int(d) - 9 ELSE 2 * int(d) END), 0, (a, d) -> a + d) % 10 = 0"
)
#: An account number, its first four signs last and letters counting from ten, leaves 1 by 97.
MOD97 = (
    "aggregate(split(concat(substr(replace(v, ' ', ''), 5), substr(replace(v, ' ', ''), 1, 4)), ''), 0, (a, c) -> "
    "CASE WHEN c >= 'A' THEN (a * 100 + ascii(c) - 55) % 97 ELSE (a * 10 + ascii(c) - 48) % 97 END) = 1"
)
OCTETS = r"forall(split(v, r'\.'), part -> coalesce(try_cast(part AS BIGINT) <= 255, false))"


def _long(low: int, high: int) -> str:
    return f"length({_DIGITS}) BETWEEN {low} AND {high}"


def _has(pattern: str) -> str:
    return f"t RLIKE {_raw(pattern)}"


@dataclass(frozen=True)
class Rule:
    """A family of candidates: its pattern, a quick test of the text t, and labelers of the match v.

    ``strict`` tells the matches that are spans whatever the votes. They are of ``kind``, others of ``loose``.
    """

    kind: str
    loose: str
    pattern: str
    guard: str
    form: str
    check: str
    listed: str
    strict: str = "false"


RULES = (
    Rule(
        "email", "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(t, '@')",
        form=_vote(f"NOT v RLIKE {_raw(r'^[.]|[.]@|[.][.]|@-|-[.]|-$')}"),
        check=_vote(f"{_TLD} RLIKE '^[a-z]{{2,24}}$'"),
        listed=_vote(f"{_TLD} IN ({_listing(DOMAINS)})", "false"),
        strict="true",
    ),
    Rule(
        "ip", "ip_like", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", _has(r"[0-9]\.[0-9]++\.[0-9]"),
        form=_vote(OCTETS),
        check=_vote(f"NOT v RLIKE {_raw(r'(^|[.])0[0-9]|^0[.]')}"),
        listed=_vote(f"NOT v RLIKE {_raw(RESERVED)}"),
        strict=OCTETS,
    ),
    Rule(
        "card", "card", r"[0-9](?:[ -]?[0-9])++", _has(r"[0-9](?:[ -]?[0-9]){11}"),
        form=_vote(_long(16, 19)),
        check=_vote(LUHN),
        listed=_vote(f"{_DIGITS} RLIKE {_raw(ISSUERS)}"),
        strict=f"CASE WHEN {_long(16, 19)} THEN {LUHN} ELSE false END",
    ),
    Rule(
        "phone", "phone", r"\+[0-9][ ().0-9-]+[0-9]", "contains(t, '+')",
        form=_vote(_long(8, 15)),
        check=_vote(f"v RLIKE '[ ()-]' AND {_long(10, 13)}", f"NOT {_long(8, 15)}"),
        listed=_vote(f"{_DIGITS} RLIKE {_raw(CALLING)}"),
        strict=_long(8, 15),
    ),
    # Card numbers in a longer run of digits, such as one behind a phone number.
    Rule(
        "card_part", "card_part",
        r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{2} ?[0-9]{6} ?[0-9]{5})(?![0-9])",
        _has(r"[0-9]{4}[ -]?[0-9]{4,6}[ -]?[0-9]{4}"),
        form=_vote(_long(15, 16)),
        check=_vote(LUHN),
        listed=_vote(f"{_DIGITS} RLIKE {_raw(ISSUERS)}"),
    ),
    Rule(
        "email_spelled", "email_spelled",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[{][aA][tT][)\]}] ?| [aA][tT] )[A-Za-z0-9-]{1,63}+"
        r"(?: ?[(\[{][dD][oO][tT][)\]}] ?| [dD][oO][tT] |\.)[A-Za-z0-9-]{2,63}+(?:(?: dot |\.)[A-Za-z0-9-]{2,63}+){0,3}+",
        _has(r"[(\[{][aA][tT][)\]}]| [dD][oO][tT] "),
        form=_vote(f"v RLIKE {_raw(r'(?i)[(\[{]at[)\]}]')}", "false"),
        check=_vote(f"{_TLD} RLIKE '^[a-z]{{2,24}}$'"),
        listed=_vote(f"{_TLD} IN ({_listing(DOMAINS)})"),
    ),
    Rule(
        "phone_local", "phone_local",
        r"(?<![0-9+.-])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
        _has(r"[0-9]{3}[ .-][0-9]{4}"),
        form=_vote(f"v RLIKE {_raw(r'^[(][0-9]{3}[)]|^[0-9]{3}([.-])[0-9]{3}[.-]')}", "false"),
        check=_vote(f"{_DIGITS} RLIKE '^[2-9][0-9]{{2}}[2-9]'"),
        listed="0",
    ),
    Rule(
        "iban", "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        _has(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4} ?[A-Z0-9]{4}"),
        form=_vote("length(replace(v, ' ', '')) BETWEEN 15 AND 34"),
        check=_vote(MOD97),
        listed=_vote(f"left(v, 2) IN ({_listing(COUNTRIES)})"),
    ),
)
FAMILIES = len(RULES)
VOTES = ("form", "check", "listed", "edge", "context", "variety")
_CANDIDATES = "array<struct<start: int, end: int, family: int, strict: boolean, " + ", ".join(
    f"{v}: int" for v in VOTES
) + ", size: int, left: int>>"
#: Beside a span, these make it a part of code or of a longer word.
INSIDE = r"^[\p{L}\p{N}_=/\x5C\x22#&@]"


def _places(pieces: str, values: str) -> str:
    """(start, end) of matches, from what lies between them and from themselves.

    Lengths are added up in blocks of ADDED, as an array that grows by one is copied each time.
    """
    none = "cast(array() AS array<struct<start: int, end: int>>)"
    block = (
        f"aggregate(b, struct(s.at AS at, {none} AS out), (a, p) -> struct(a.at + p.gap + p.size AS at, "
        "array_append(a.out, struct(a.at + p.gap AS start, a.at + p.gap + p.size AS end)) AS out))"
    )
    blocks = f"transform(sequence(0, int((size(parts) - 1) / {ADDED})), k -> slice(parts, k * {ADDED} + 1, {ADDED}))"
    added = (
        f"aggregate({blocks}, struct(0 AS at, cast(array() AS array<array<struct<start: int, end: int>>>) AS out), "
        f"(s, b) -> struct(s.at + aggregate(b, 0, (a, p) -> a + p.gap + p.size) AS at, "
        f"array_append(s.out, {block}.out) AS out)).out"
    )
    parts = f"transform({values}, (v, i) -> struct(length({pieces}[i]) AS gap, length(v) AS size))"
    return f"flatten({_let('parts', parts, added)})"


def _described(family: int, rule: Rule) -> str:
    """A candidate: its place, whether it is strict, the votes, and buckets of its length and left side."""
    own = (
        f"CASE WHEN right(before, 1) RLIKE {_raw(INSIDE)} OR left(after, 1) RLIKE {_raw(INSIDE)} THEN -1 ELSE 1 END"
    )
    near = f"CASE WHEN before RLIKE {_raw(AGAINST)} THEN -1 WHEN before RLIKE {_raw(FOR)} THEN 1 ELSE 0 END"
    variety = _vote("size(array_distinct(split(regexp_replace(v, '[^A-Za-z0-9]', ''), ''))) > 3")
    side = (
        rf"CASE WHEN before = '' THEN 0 WHEN before RLIKE {_raw(r'\s$')} THEN 1 "
        rf"WHEN right(before, 1) RLIKE {_raw(INSIDE)} THEN 2 ELSE 3 END"
    )
    fields = (
        f"struct(places[i].start AS start, places[i].end AS end, {family} AS family, coalesce({rule.strict}, false) AS strict, "
        f"{rule.form} AS form, {rule.check} AS check, {rule.listed} AS listed, {own} AS edge, {near} AS context, "
        f"{variety} AS variety, int(least(length(v) / 8, 3)) AS size, {side} AS left)"
    )
    return _let("before", f"right(pieces[i], {CONTEXT})", _let("after", f"left(pieces[i + 1], {CONTEXT})", fields))


def with_candidates(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with an array of candidates: their place, votes and features."""
    own = free_name(docs, name + "_part")
    text = f"coalesce(cast(`{text_col}` AS string), '')"

    def matches(rule: Rule) -> str:
        # The pattern does not run on texts that the quick test rules out; most need a digit.
        guard = rule.guard if rule.kind.startswith("email") else f"digits AND {rule.guard}"
        found = f"struct(split(t, {_raw(rule.pattern)}, -1) AS pieces, regexp_extract_all(t, {_raw(rule.pattern)}, 0) AS values)"
        return f"CASE WHEN {guard} THEN {found} END"

    def listed(k: int, rule: Rule) -> str:
        found = f"transform(values, (v, i) -> {_described(k, rule)})"
        if rule.kind == "card":
            # Shorter runs of digits are no candidates.
            found = f"filter({found}, c -> c.end - c.start >= 12)"
        bound = _let("pieces", f"m{k}.pieces", _let("values", f"m{k}.values", _let("places", _places("pieces", "values"), found)))
        return f"CASE WHEN size(m{k}.values) > 0 THEN {bound} ELSE cast(array() AS {_CANDIDATES}) END"

    found = f"struct({', '.join(f'{matches(r)} AS m{k}' for k, r in enumerate(RULES))})"
    split = docs.withColumn(own, F.expr(_let("t", text, _let("digits", "t RLIKE '[0-9]'", found))))
    every = f"concat({', '.join(listed(k, r).replace(f'm{k}.', f'`{own}`.m{k}.') for k, r in enumerate(RULES))})"
    return split.select(*[f"`{c}`" for c in docs.columns], F.expr(every).alias(name))


# -- label model ---------------------------------------------------------------------------


def votes_of(c: str) -> str:
    """Votes of candidate ``c`` as 0 against, 1 undecided, 2 for."""
    return f"array({', '.join(f'{c}.{name} + 1' for name in VOTES)})"


# The first guess: a labeler is right seven times in ten, wrong once, and silent otherwise.
_YES, _NO = (0.1, 0.2, 0.7), (0.7, 0.2, 0.1)


def posterior(model: str, row: str) -> str:
    """The probability of personal data behind a row (family, votes)."""

    def likelihood(side: str, start: str) -> str:
        steps = f"sequence(0, {len(VOTES) - 1})"
        return f"aggregate({steps}, {start}, (x, j) -> x * {model}.{side}[j * 3 + {row}.votes[j]])"

    prior = f"{model}.prior[{row}.family]"
    both = f"struct({likelihood('yes', prior)} AS yes, {likelihood('no', f'1 - {prior}')} AS no)"
    return _let("l", both, "l.yes / (l.yes + l.no)")


def label_model(patterns: DataFrame) -> DataFrame:
    """One row: prior by family, and the chances of each vote on personal data (yes) and others (no).

    ``patterns`` has (family, votes, n), each pattern once. Expectation-maximisation for ROUNDS rounds
    from the first guess, which also counts as TRUST candidates and keeps the two sides apart.
    """
    first = (
        f"struct({_doubles([0.5] * FAMILIES)} AS prior, {_doubles(_YES * len(VOTES))} AS yes, "
        f"{_doubles(_NO * len(VOTES))} AS no)"
    )
    scored = (
        "transform(rows, r -> struct(r.family AS family, r.votes AS votes, r.n AS n, "
        f"r.n * {posterior('model', 'r')} AS p))"
    )

    def side(weight: str, guess: tuple) -> str:
        hits = (
            f"transform({_doubles(guess * len(VOTES))}, (g, i) -> (aggregate(s, 0D, (a, r) -> a + "
            f"CASE WHEN r.votes[int(i / 3)] = i % 3 THEN {weight} ELSE 0D END) + {TRUST}D * g) / (every + {TRUST}D))"
        )
        return _let("every", f"aggregate(s, 0D, (a, r) -> a + {weight})", hits)

    def of_family(term: str) -> str:
        return f"aggregate(s, 0D, (a, r) -> a + CASE WHEN r.family = k THEN {term} ELSE 0D END)"

    prior = f"transform(sequence(0, {FAMILIES - 1}), k -> ({of_family('r.p')} + 1) / ({of_family('r.n')} + 2))"
    better = f"struct({prior} AS prior, {side('r.p', _YES)} AS yes, {side('r.n - r.p', _NO)} AS no)"
    fitted = f"aggregate(sequence(1, {ROUNDS}), {first}, (model, round) -> {_let('s', scored, better)})"
    return patterns.agg(
        F.expr("array_sort(collect_list(struct(family, votes, cast(n AS double) AS n)))").alias("rows")
    ).select(F.expr(fitted).alias("model"))


# -- span classifier -------------------------------------------------------------------------

#: Features of the classifier with the number of their values.
FEATURES = {"family": FAMILIES, **dict.fromkeys(VOTES, 3), "size": 4, "left": 4}
WEIGHTS = sum(FEATURES.values())


def features_of(c: str) -> str:
    """The places of the weights of candidate ``c``: one for each feature."""
    places, at = [], 0
    for name, n in FEATURES.items():
        places.append(f"{c}.{name} + {at + (name in VOTES)}")
        at += n
    return f"array({', '.join(places)})"


def chance(weights: str, places: str) -> str:
    return f"1 / (1 + exp(-aggregate({places}, 0D, (z, j) -> z + {weights}[j])))"


def classifier(spans: DataFrame) -> DataFrame:
    """One row with the weights of a ridge logistic regression by gradient descent.

    ``spans`` has (places, n, yes): spans with these features, and how many of them are expected to be
    personal data. A step is as long as the curvature of so many active features allows.
    """
    step = 4 / len(FEATURES)
    missed = f"transform(rows, r -> struct(r.places AS places, r.n * {chance('w', 'r.places')} - r.yes AS miss))"
    slope = "aggregate(m, 0D, (a, r) -> a + CASE WHEN array_contains(r.places, k) THEN r.miss ELSE 0D END) / every"
    moved = f"transform(w, (x, k) -> x - {step!r}D * ({slope} + {RIDGE}D * x))"
    rows = spans.agg(
        F.expr("array_sort(collect_list(struct(places, cast(n AS double) AS n, yes)))").alias("rows"),
        F.expr("coalesce(nullif(cast(sum(n) AS double), 0D), 1D)").alias("every"),
    )
    return rows.select(
        F.expr(
            f"aggregate(sequence(1, {STEPS}), array_repeat(0D, {WEIGHTS}), (w, round) -> {_let('m', missed, moved)})"
        ).alias("weights")
    )


# -- operator ----------------------------------------------------------------------------------


@dataclass
class Model:
    """What was fitted: the label model and the weights of the span classifier."""

    prior: list[float] = field(default_factory=lambda: [0.5] * FAMILIES)
    yes: list[float] = field(default_factory=lambda: list(_YES * len(VOTES)))
    no: list[float] = field(default_factory=lambda: list(_NO * len(VOTES)))
    weights: list[float] = field(default_factory=lambda: [0.0] * WEIGHTS)

    def sql(self) -> str:
        return f"struct({_doubles(self.prior)} AS prior, {_doubles(self.yes)} AS yes, {_doubles(self.no)} AS no)"


def fit(candidates: DataFrame, name: str) -> Model:
    """Reliabilities and classifier from the candidates of all documents (array column ``name``)."""
    spans = candidates.select(F.explode(name).alias("c"))
    counted = stored(
        spans.groupBy(
            F.expr("c.family").alias("family"), F.expr(votes_of("c")).alias("votes"), F.expr(features_of("c")).alias("places")
        ).agg(F.count("*").alias("n")),
        "votes",
    )
    found = label_model(counted.groupBy("family", "votes").agg(F.sum("n").alias("n"))).first()["model"]
    model = Model(found["prior"], found["yes"], found["no"])
    soft = counted.withColumn("r", F.struct("family", "votes")).withColumn(
        "p", F.expr(_let("model", model.sql(), posterior("model", "r")))
    )
    model.weights = classifier(
        soft.groupBy("places").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("yes"))
    ).first()["weights"]
    discard(counted)
    return model


def find_personal_data(docs: DataFrame, *, text_col: str = "text", spans: str = "personal", least: float = 0.5,
                       model: Model | None = None) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end), by kind and start.

    Candidates beyond the strict ones become spans where the classifier gives them a chance of at
    least ``least`` and neither their form nor their check speaks against it. The classifier is fitted on
    these documents unless ``model`` has one.
    """
    own = free_name(docs, "__candidates")
    if model is None:
        model = fit(with_candidates(docs.select(F.col(f"`{text_col}`").alias("text")), own), own)

    def kind_of(attribute: str) -> str:
        return f"array({_listing(getattr(r, attribute) for r in RULES)})[c.family]"

    kind = f"CASE WHEN c.strict THEN {kind_of('kind')} ELSE {kind_of('loose')} END"
    span = _let(
        "kind", kind,
        f"struct(array_position(array({_listing(KINDS)}), kind) AS place, bigint(c.start) AS start, bigint(c.end) AS end, kind AS kind)",
    )
    strict = "filter(found, c -> c.strict)"
    added = (
        f"filter(found, c -> NOT c.strict AND c.form >= 0 AND c.check >= 0 AND {chance('w', features_of('c'))} >= {float(least)!r}D "
        "AND NOT exists(strict, s -> s.start < c.end AND c.start < s.end))"
    )
    kept = _let("strict", strict, f"concat(strict, {_let('w', _doubles(model.weights), added)})")
    decided = (
        f"transform(array_sort(transform({kept}, c -> {span})), s -> struct(s.kind AS kind, s.start AS start, s.end AS end))"
    )
    none = "cast(array() AS array<struct<kind: string, start: bigint, end: bigint>>)"
    made = with_candidates(docs, own, text_col)
    return made.select(
        *[f"`{c}`" for c in docs.columns],
        F.expr(f"CASE WHEN size(`{own}`) > 0 THEN {_let('found', f'`{own}`', decided)} ELSE {none} END").alias(spans),
    )


def is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE_KINDS)
