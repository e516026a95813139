"""What goes of planted passages: every copy but the first, and each from its first word to its last."""

from __future__ import annotations

import numpy as np

from candlewick.llm import passages


def run(name: str, n: int) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


def found(spark, rows) -> dict:
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["repeats"] for r in passages.marked_repeats(docs).collect()}


def covers(marks, text: str, part: str, nth: int = 0) -> bool:
    """Whether a removal holds the nth copy of ``part``."""
    at = -1
    for _ in range(nth + 1):
        at = text.index(part, at + 1)
    return any(s["start"] <= at and at + len(part) <= s["end"] for s in marks["removed"])


def touches(marks, text: str, part: str) -> bool:
    at = text.index(part)
    return any(s["start"] < at + len(part) and at < s["end"] for s in marks["removed"])


def test_further_copies_in_the_keeping_document_go(spark):
    line, inner = run("line", 60), run("inner", 70)
    texts = {
        1: f"{run('a', 9)}\n{line}\n{run('b', 9)}\n{line}\n{run('c', 9)} {inner} {run('d', 9)} {inner} {run('e', 9)}\n{line}",
        2: f"{run('f', 9)}\n{line}\n{run('g', 9)} {inner}",
    }
    marks = found(spark, list(texts.items()))
    assert not touches(marks[1], texts[1], line) and not touches(marks[1], texts[1], inner)
    assert covers(marks[1], texts[1], line, 1) and covers(marks[1], texts[1], line, 2)
    second = texts[1].rindex(inner)
    assert any(second <= s["start"] and s["end"] <= second + len(inner) for s in marks[1]["removed"])
    assert covers(marks[2], texts[2], line)


def test_a_first_stretch_stays_whole_where_copies_overlap_it(spark):
    base = run("p", 7)
    text = " ".join([base] * 30)
    marks = found(spark, [(1, text), (2, text)])
    assert marks[1]["removed"] and all(len(text[: s["start"]].split()) >= passages.WINDOW for s in marks[1]["removed"])


def test_removals_reach_from_the_first_equal_word_to_the_last(spark):
    inner, short, lines = run("inner", 51), run("short", 57), "\n".join(run(f"l{k}_", 11) for k in range(9))
    rows, planted = [(100, lines), (101, lines), (102, lines)], []
    for i in range(12):
        rows.append((i, f"{run(f'x{i}_', 5 + 7 * i)} {inner} {run(f'y{i}_', 40 - 3 * i)} {short}\n{run(f'z{i}_', 8)}"))
        planted += [(i, inner), (i, short)] if i else []
    texts, marks = dict(rows), found(spark, rows)
    assert marks[0]["removed"] == [] and marks[100]["removed"] == []
    for doc, part in planted + [(101, lines), (102, lines)]:
        assert covers(marks[doc], texts[doc], part), (doc, marks[doc])
    gone = {d: sum(s["end"] - s["start"] for s in marks[d]["removed"]) for d in texts}
    assert all(gone[i] == len(inner) + len(short) for i in range(1, 12))


def test_words_shared_with_a_later_document_than_the_windows_first_go(spark):
    """Document 1 has the middle of a passage only, so the ends are first in document 2."""
    words = run("w", 90).split()
    texts = {
        1: " ".join([run("a", 15), *words[8:80], run("b", 15)]),
        2: " ".join([run("c", 15), *words, run("d", 15)]),
        3: " ".join([run("e", 15), *words, run("f", 15)]),
    }
    marks = found(spark, list(texts.items()))
    assert marks[1]["removed"] == [] and covers(marks[3], texts[3], " ".join(words))
    assert covers(marks[2], texts[2], " ".join(words[8:80])) and not covers(marks[2], texts[2], " ".join(words[7:80]))


def test_classes_are_connected_and_members_tell_the_clusters(spark):
    """900 and 901 are near copies, all hold a licence first seen in 5; 5 and 20 share another passage."""
    licence, body, other = run("licence", 60), run("body", 120), run("other", 60)
    texts = {
        5: f"{other} {run('a', 7)}\n{licence}",
        20: f"{run('b', 7)} {other} {run('c', 7)}",
        700: f"{run('d', 7)}\n{licence}",
        900: f"{body} {run('e', 4)}\n{licence}",
        901: f"{run('f', 3)} {body}\n{licence}",
        950: run("g", 80),
        30: f"{run('h', 40)} {run('i', 60)}",
        31: f"{run('i', 60)} {run('j', 60)}",
        40: run("j", 60),
    }
    marks = found(spark, list(texts.items()))
    assert {marks[d]["class_id"] for d in (5, 20, 700, 900, 901)} == {5}
    assert {marks[d]["class_id"] for d in (30, 31, 40)} == {30} and marks[950]["class_id"] == 950
    assert marks[950]["members"] == []

    def has(doc, part, keeper):
        at, there = texts[doc].index(part), texts[keeper].index(part)
        return any(
            m["keeper"] == keeper and m["start"] <= at and at + len(part) <= m["end"]
            and m["keeper_start"] - m["start"] == there - at
            for m in marks[doc]["members"]
        )

    assert has(901, body, 900) and has(900, body, 900) and has(20, other, 5)
    assert all(has(d, licence, 5) for d in (5, 700, 900, 901))
    assert {m["keeper"] for m in marks[700]["members"]} == {5}


def test_different_texts_of_one_id_are_different_documents(spark):
    """Null ids too; what goes is cut from the row it was found in, and classes are not joined by an id."""
    shared, other = run("shared", 60), run("other", 60)
    rows = [
        (1, f"{run('a', 9)} {shared} {run('b', 9)}"),
        (5, "three unique words"),
        (5, f"{run('c', 30)} {shared} {run('d', 3)}"),
        (None, f"{run('e', 7)} {other}"),
        (None, f"{run('f', 70)}"),
        (9, f"{other} {run('g', 40)}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(r["text"] for r in passages.without_repeats(docs).collect())
    assert left == sorted(
        [rows[0][1], rows[1][1], rows[2][1].replace(shared, ""), rows[3][1], rows[4][1], f" {run('g', 40)}"]
    )
    classes = {(r["doc_id"], r["text"]): r["repeats"]["class_id"] for r in passages.marked_repeats(docs).collect()}
    assert [classes[r] for r in rows] == [1, 5, 1, None, None, None]


def test_equal_words_beyond_windows_are_found_in_groups_that_part(spark):
    """Many copies of a core with longer and longer equal surroundings; the first holds the core alone."""
    core, before, behind = run("core", 50), run("u", 4).split(), run("v", 4).split()
    texts = {0: f"{run('x', 40)} {core} {run('y', 40)}"}
    for i in range(1, 5):
        for copy in range(2):
            doc = 2 * i + copy
            texts[doc] = " ".join([run(f"l{doc}_", 20), *before[4 - i :], core, *behind[:i], run(f"r{doc}_", 20)])
    marks = found(spark, list(texts.items()))
    for i in range(1, 5):
        longest = max(i - 1, 0)  # the first copy of this length keeps its outermost words
        whole = " ".join([*before[4 - i :], core, *behind[:i]])
        inner = " ".join([*before[4 - longest :], core, *behind[:longest]]) if longest else core
        assert covers(marks[2 * i], texts[2 * i], inner) and not covers(marks[2 * i], texts[2 * i], whole)
        assert covers(marks[2 * i + 1], texts[2 * i + 1], whole)
        (span,) = marks[2 * i + 1]["removed"]
        assert span["end"] - span["start"] == len(whole)


def test_runs_of_few_words_that_repeat_go_whole(spark):
    """Of equal windows that overlap only the outermost are extended, and no word of a shared run stays."""
    rows, planted = [], []
    for period in (1, 3, 7, 25):
        words = run(f"p{period}_", period).split() * 120
        for copy, (shift, n) in enumerate([(0, 100), (0, 64), (min(2, period - 1), 71), (0, 100)]):
            doc, part = 10 * period + copy, " ".join(words[shift : shift + n])
            rows.append((doc, f"{run(f'x{doc}_', 23)} {part} {run(f'y{doc}_', 23)}"))
            planted += [(doc, part)] if copy else []
    texts, marks = dict(rows), found(spark, rows)
    for doc, part in planted:
        (span,) = marks[doc]["removed"]
        assert (span["start"], span["end"]) == (texts[doc].index(part), texts[doc].index(part) + len(part)), doc


def test_windows_inside_runs():
    at = np.array([0, 3, 10, 13, 16, 40, 80, 90])
    key = np.array([5, 9, 5, 9, 5, 5, 5, 5])
    before, behind = passages._inside_runs(at, key, 1), passages._inside_runs(at, key, -1)
    assert at[before].tolist() == [16, 40] and at[behind].tolist() == [0, 10]
    assert not passages._inside_runs(at[:0], key[:0], 1).any() and not passages._inside_runs(at[:1], key[:1], -1).any()


def test_lines_of_twenty_words_are_paragraphs(spark):
    line = run("line", 24)
    rows = [(i, f"{run(f'a{i}_', 30)}\n{line} tail{i}") for i in range(4)] + [(9, run("b", 60))]
    marks = found(spark, rows)
    assert [marks[i]["n_stretches"] > 0 for i in (0, 1, 2, 3, 9)] == [True] * 4 + [False]
    assert all(covers(marks[i], rows[i][1], line) for i in (1, 2, 3)) and marks[0]["removed"] == []


def test_spans_are_merged_as_one_by_one():
    import random

    import pyarrow as pa

    def joined(spans):
        out = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    draw = random.Random(5)
    fields = ("kind", "start", "end", "keeper", "code", "keeper_start")
    kind = pa.list_(pa.struct([*[(f, pa.int64()) for f in fields], ("cut", pa.int64())]))
    rows = []
    for size in [0, *[draw.randint(0, 12) for _ in range(300)], 0]:
        rows.append([])
        for _ in range(size):
            at, n, keeper = draw.randint(0, 40), draw.randint(1, 9), draw.choice([-(2**63), 1, 2])
            rows[-1].append(dict(
                kind=draw.randint(0, 2), start=at, end=at + n, keeper=keeper, code=draw.choice([-7, 7]),
                keeper_start=at + draw.randint(-1, 1), cut=draw.choice([None, at, at + n - 1]),
            ))
    made = passages._merged(pa.array(rows, kind)).to_pylist()
    for row, got in zip(rows, made, strict=True):
        alike = {}
        for s in row:
            alike.setdefault((s["keeper"], s["code"], s["keeper_start"] - s["start"]), []).append((s["start"], s["end"]))
        members = sorted((a, b, k, a + shift) for (k, _, shift), parts in alike.items() for a, b in joined(parts))
        assert got["n_stretches"] == sum(s["kind"] > 0 for s in row)
        assert [[x["start"], x["end"]] for x in got["removed"]] == joined((s["cut"], s["end"]) for s in row if s["cut"] is not None)
        assert [tuple(m.values()) for m in got["members"]] == members
    assert passages._merged(pa.array([], kind)).to_pylist() == []
    assert passages._merged(pa.array([[]], kind)).to_pylist() == [{"n_stretches": 0, "removed": [], "members": []}]


def test_windows_of_one_document_do_not_reach_the_join(spark):
    """Half of the keys are in two documents, some others twice in one."""
    rows = [(doc, 7, key * 2**33 + key, key, 0, 9) for key in range(2000) for doc in ([key, key + 1] if key % 2 else [key])]
    rows += [(key, 7, key * 2**33 + key, key, 20, 29) for key in range(0, 2000, 4)]
    windows = spark.createDataFrame(rows, "doc long, code long, one long, two long, start int, end int")
    left = {tuple(r) for r in passages._likely(windows).collect()}
    assert left <= set(rows) and {r for r in rows if r[3] % 2} <= left
    assert len(left) < 2000 + 200


def test_texts_looked_at_together_give_what_each_gives_alone():
    """Anchors by the plain definition; nulls of words, short, repeated and non-ASCII texts side by side."""
    texts = [b"", run("a", 90).encode(), b"\n\n x", run("b", 31).encode(), run("b", 32).encode(), b" ".join([b"la", b"la", b"lu"] * 60),
             f"{'é ü ' * 40}\n{'日本 語 ' * 30}\n".encode(), b"a b c", f"{run('c', 25)}\n{run('c', 25)}".encode()]
    words = passages.Words(texts)
    at = passages.anchors(words)
    one, two = passages.window_keys(words.codes, at)
    of, start, end, first, second = passages._paragraph_sets(words)[0]
    for k, text in enumerate(texts):
        alone = passages.Words([text])
        n, by_definition = len(alone.codes), set()
        for i in range(n - passages.NEIGHBOURS - passages.WORDS + 2 if n >= passages.WINDOW else 0):
            by_definition.add(i + int(alone.shingles[i : i + passages.NEIGHBOURS].argmin()))
        expected = sorted(i for i in by_definition if i + passages.WINDOW <= n)
        own = words.text[at] == k
        assert (at[own] - words.first[k]).tolist() == expected == passages.anchors(alone).tolist()
        keys = passages.window_keys(alone.codes, np.array(expected, np.int64))
        assert all((mine[own] == its).all() for mine, its in zip((one, two), keys, strict=True))
        decoded, mine = text.decode(), words.text == k
        spans = zip(words.start[mine].tolist(), words.end[mine].tolist(), strict=True)
        assert [decoded[a:b] for a, b in spans] == decoded.split()
        sets = passages._paragraph_sets(alone)[0]
        for column, its in zip((start, end, first, second), sets[1:], strict=True):
            assert column[of == k].tolist() == its.tolist()
