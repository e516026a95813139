"""URL filters: glob rules run as one bit-parallel automaton.

All rules are packed side by side into one bit vector as long as needed (a Python integer, that
is, a row of machine words). Bit i says that the first i elements of a rule have been read. A
character moves every rule at once: ``(D << 1) & reads[c] | D & stays[c]``, the Shift-And step
with self-loops for wildcards. Rules are anchored at both ends of the canonical URL: host in
lower case, path and query.

Globs: ``*`` is any run of characters but ``/``, ``**`` any run at all, ``?`` one character
but ``/``, everything else itself.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and
is allowed. Rows are judged one by one. Other columns are passed on.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

# Rules by host and path.
HOST_RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)

#: Globs over the whole canonical URL, for what no host rule decides.
GLOB_RULES = (
    "*casino*/**",
    "**/login**",
    "**/wp-admin/**",
    "**.exe",
    "**.zip",
    "**[?]**sessionid=**",
)

_UPPER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, query with its question mark), without the fragment."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", ""
    rest = rest.partition("#")[0]
    rest, mark, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path, mark + query


def elements(glob: str) -> list[tuple[str, str]]:
    """(kind, character) of each element; kinds: char, one, run (no slash), any."""
    out, i = [], 0
    while i < len(glob):
        if glob.startswith("**", i):
            out.append(("any", ""))
            i += 2
        elif glob[i] == "[" and glob[i + 2 : i + 3] == "]":
            out.append(("char", glob[i + 1]))
            i += 3
        else:
            out.append(({"*": "run", "?": "one"}.get(glob[i], "char"), glob[i]))
            i += 1
    return out


@dataclass(frozen=True)
class Automaton:
    """All globs as masks over one bit vector."""

    start: int
    reads: dict[str, int]
    stays: dict[str, int]
    other_reads: int
    other_stays: int
    ends: tuple[int, ...]

    @classmethod
    def of(cls, globs: list[str]) -> Automaton:
        letters = {c for g in globs for kind, c in elements(g) if kind == "char"} | {"/"}
        reads, stays = dict.fromkeys(letters, 0), dict.fromkeys(letters, 0)
        start = other_reads = other_stays = at = 0
        ends = []
        for glob in globs:
            start |= 1 << at
            for kind, c in elements(glob):
                if kind in ("run", "any"):
                    other_stays |= 1 << at
                    for x in letters:
                        stays[x] |= (kind == "any" or x != "/") << at
                    continue
                at += 1
                if kind == "char":
                    reads[c] |= 1 << at
                else:
                    other_reads |= 1 << at
                    for x in letters:
                        reads[x] |= (x != "/") << at
            ends.append(1 << at)
            at += 1  # no element leads from one rule into the next
        return cls(start, reads, stays, other_reads, other_stays, tuple(ends))

    def matches(self, text: str, state: int | None = None) -> int:
        """The bit vector after the whole text, from the start or ``state``; cut short when no rule is left."""
        reads, stays = self.reads, self.stays
        state = self.start if state is None else state
        for c in text:
            state = (state << 1) & reads.get(c, self.other_reads) | state & stays.get(c, self.other_stays)
            if not state:
                break
        return state


@dataclass(frozen=True)
class Filter:
    """Host rules (the longest decides) before globs (any blocks)."""

    host_rules: tuple[tuple[str, str], ...]
    automaton: Automaton

    @classmethod
    def of(cls, host_rules=HOST_RULES, globs=GLOB_RULES) -> Filter:
        """A host rule is two globs: for the host itself and for its subdomains."""
        packed = [f"{lead}{_literal(rule)}**" for rule, _ in host_rules for lead in ("", "*.")]
        return cls(tuple(host_rules), Automaton.of([*packed, *globs]))

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path, query = split_url(url)
        # Host rules see host and path; the automaton then goes on with the query for the globs.
        state, ends = self.automaton.matches(host + path), self.automaton.ends
        fit = [
            r for i, r in enumerate(self.host_rules) if state & (ends[2 * i] | ends[2 * i + 1])
        ]
        if fit:
            rule, verdict = max(fit, key=lambda r: len(r[0]))
            return host, path, rule, verdict
        state = self.automaton.matches(query, state)
        blocked = any(state & end for end in ends[2 * len(self.host_rules) :])
        return host, path, None, BLOCK if blocked else ALLOW


def _literal(text: str) -> str:
    return "".join(f"[{c}]" if c in "*?[" else c for c in text)


def judge_urls(pages: DataFrame, *, url_col: str = "url", verdict: str = "judged",
               host_rules=HOST_RULES, globs=GLOB_RULES) -> DataFrame:
    """``pages`` with a struct column: host, path, rule and verdict of the URL."""
    rules = Filter.of(host_rules, globs)

    def judge(url: pa.Array) -> pa.Array:
        rows = [rules.judge(value) for value in url.to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.string()) for c in columns], names=["host", "path", "rule", "verdict"]
        )

    udf = F.arrow_udf(judge, "host string, path string, rule string, verdict string")
    return pages.withColumn(verdict, udf(F.col(url_col).cast("string")))
