"""Secret scans: fixed patterns, and sliding windows of high Shannon entropy.

Patterns find assignments, access keys and long hex strings. Every other run of key characters
is a candidate: a window slides over it, counts of its characters are kept up to date in
constant time per step, and windows whose entropy is high for their character class become
spans. Allow-listed shapes and words are suppressed; pattern spans never are.

Defined cases: a null text is empty and has no spans. Offsets are code points, ends exclusive.
Each row is scanned by itself, so repeated rows and ids need no care. Other columns are passed on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import small_batches

# The patterns that every result must contain.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

#: Lower-case parts of the names in ASSIGN; a text without any has no assignment.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Character classes with the least bits per character that make a window suspicious. A window
#: belongs to the first class that has all its characters; the largest entropy of a window is
#: log2(20) = 4.32 bits, or log2(10) for digits.
CLASSES = (
    ("entropy_digits", frozenset("0123456789"), 3.1),
    ("entropy_hex", frozenset("0123456789abcdefABCDEF"), 3.3),
    ("entropy_base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"), 3.7),
)
KINDS = (*BASE_KINDS, *(name for name, _, _ in CLASSES))

#: Candidates of these shapes are no secrets: identifiers, paths, dates and words joined by signs.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"/*([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))*[-_/=+]*"),
    re.compile(r"[A-Z]?[a-z]+([A-Z][a-z]+)*[0-9]?"),
)
ALLOWED_WORDS = ("example", "sample", "placeholder", "xxxx")

Span = tuple[str, int, int]


def pattern_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that do not overlap; too short ones are dropped."""
    spans: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        spans += [
            ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE
        ]
    if any(len(word) >= MIN_ACCESS for word in text.split()):
        spans += [
            (kind, m.start(), m.end())
            for kind, pattern, least in (("access", ACCESS, MIN_ACCESS), ("hex", HEX, MIN_HEX))
            for m in pattern.finditer(text)
            if m.end() - m.start() >= least
        ]
    return spans


def entropy_runs(value: str, window: int = WINDOW) -> list[Span]:
    """Stretches covered by suspicious windows of one class, from incremental counts.

    Of each window the counts of its characters, the sum of c * log2(c) over them and the
    characters outside each class are kept; a step changes two counts.
    """
    n = len(value)
    if n < window:
        return []
    plogp = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    outside = [0] * len(CLASSES)
    total = 0.0
    runs: list[Span] = []
    for i, char in enumerate(value):
        c = counts.get(char, 0)
        total += plogp[c + 1] - plogp[c]
        counts[char] = c + 1
        for k, (_, members, _) in enumerate(CLASSES):
            outside[k] += char not in members
        if i >= window:
            old = value[i - window]
            c = counts[old]
            total += plogp[c - 1] - plogp[c]
            counts[old] = c - 1
            for k, (_, members, _) in enumerate(CLASSES):
                outside[k] -= old not in members
        if i + 1 < window:
            continue
        k = next((k for k, o in enumerate(outside) if not o), None)
        if k is None or math.log2(window) - total / window < CLASSES[k][2] - 1e-9:
            continue
        kind, start, end = CLASSES[k][0], i + 1 - window, i + 1
        if runs and runs[-1][0] == kind and start <= runs[-1][2]:
            runs[-1] = (kind, runs[-1][1], end)
        else:
            runs.append((kind, start, end))
    return runs


def allowed(value: str) -> bool:
    low = value.lower()
    return any(word in low for word in ALLOWED_WORDS) or any(p.fullmatch(value) for p in ALLOWED)


def entropy_spans(text: str) -> list[Span]:
    if not any(len(word) >= WINDOW for word in text.split()):
        return []
    return [
        (kind, m.start() + start, m.start() + end)
        for m in CANDIDATE.finditer(text)
        if not allowed(m[0])
        for kind, start, end in entropy_runs(m[0])
    ]


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(text: str) -> list[Span]:
    return ordered([*pattern_spans(text), *entropy_spans(text)])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _secret_spans(text: pa.Array) -> pa.Array:
    rows = [
        [{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(value or "")]
        for value in text.to_pylist()
    ]
    return pa.array(rows, _SPANS)


def find_secrets(docs: DataFrame, *, text_col: str = "text", spans: str = "secrets") -> DataFrame:
    """``docs`` with an array column of spans (kind, start, end), ordered by start and kind."""
    scan = F.arrow_udf(_secret_spans, "array<struct<kind: string, start: long, end: long>>")
    return small_batches(docs).withColumn(spans, scan(F.col(text_col).cast("string")))


def is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE_KINDS)


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
