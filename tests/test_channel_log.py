"""Lines appended to logs arrive once, whatever the cut into batches and slices, also after a restart."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from candlewick.schemas import TICK_ENVELOPE
from candlewick.streaming import channel_log, live


def taken(spark, folder, tmp_path, **options):
    """The lines that one run of the stream adds to its output."""
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    before = spark.read.parquet(out).count() if (tmp_path / "out").exists() else 0
    query = live.start(
        channel_log.log_lines(spark, str(folder), **options),
        lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"),
        cp, available_now=True,
    )
    assert query.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    return sorted((r["file"], r["position"], r["line"]) for r in rows), len(rows) - before


def append(path, data: bytes):
    with path.open("ab") as out:
        out.write(data)


def expected(folder):
    out = []
    for path in folder.iterdir():
        data, at = path.read_bytes(), 0
        for line in data[: data.rfind(b"\n") + 1].split(b"\n")[:-1]:
            out.append((path.name, at, line.decode("utf-8", "replace").removesuffix("\r")))
            at += len(line) + 1
    return sorted(out)


def test_appended_lines_arrive_once_also_after_restarts(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    append(folder / "a.log", b"one\ntwo\nhalf")
    append(folder / "b.log", b"")
    assert taken(spark, folder, tmp_path)[1] == 2
    append(folder / "a.log", b" done\r\n\nfour\n")
    append(folder / "b.log", "first é\n".encode() + b"\xff broken\nunfinished")
    got, new = taken(spark, folder, tmp_path)
    assert new == 5 and got == expected(folder)
    assert taken(spark, folder, tmp_path) == (got, 0)
    append(folder / "c.log", b"x\n")
    assert taken(spark, folder, tmp_path) == (expected(folder), 1)


def test_a_log_that_shrinks_is_an_error_and_one_that_is_gone_is_not(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    append(folder / "a.log", b"one\ntwo\n")
    append(folder / "b.log", b"three\n")
    first, _ = taken(spark, folder, tmp_path)
    (folder / "b.log").unlink()
    append(folder / "a.log", b"four\n")
    assert taken(spark, folder, tmp_path)[1] == 1
    (folder / "a.log").write_bytes(b"one\n")
    with pytest.raises(StreamingQueryException, match="shorter"):
        taken(spark, folder, tmp_path)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_slices_of_any_size_give_every_line_once(tmp_path, monkeypatch, size):
    monkeypatch.setattr(channel_log, "BLOCK", 16)
    monkeypatch.setattr(channel_log, "TAIL", 5)
    draw = random.Random(size)
    for name in ("a", "b"):
        lines = [b"z" * draw.choice([0, 0, 1, 3, 20, 90]) for _ in range(60)]
        append(tmp_path / name, b"\n".join(lines) + draw.choice([b"", b"\n"]) + b"open end" * 5)
    append(tmp_path / "_hidden", b"no\n")
    log = channel_log._Log({"path": str(tmp_path)})
    end = log.ends()
    mid = {"a": expected(tmp_path)[20][1]}  # a line of file a starts there
    want = [row for row in expected(tmp_path) if row[0] in end]
    got = []
    for start, upto in (({}, mid), (mid, end)):
        for part in channel_log._slices(start, upto, size):
            for batch in log.read(part):
                got += [tuple(row.values()) for row in batch.to_pylist()]
    assert sorted(got) == want and "_hidden" not in end


def test_batch_reads_and_envelopes(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    assert channel_log.log_lines(spark, str(folder), streaming=False).count() == 0
    ticks = [{"seq": i, "channel": "A.JSON", "data": f"d{i}", "timestamp": f"2024-03-01T09:15:{i:02d}.25"} for i in range(20)]
    good = "".join(json.dumps(t) + "\n" for t in ticks)
    append(folder / "a.log", (good + "junk\n\n  \n[1]\n" + json.dumps({"seq": 5}) + "\n").encode())
    lines = channel_log.log_lines(spark, f"file://{folder}", streaming=False, slice_bytes=100)
    assert lines.rdd.getNumPartitions() > 10
    got = channel_log.envelopes(lines)
    want = spark.read.schema(TICK_ENVELOPE).json(spark.sparkContext.parallelize(good.splitlines()))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in TICK_ENVELOPE]
    assert sorted(got.collect()) == sorted(want.collect())
    assert sorted(r["line"] for r in channel_log.unreadable_lines(lines).collect()) == ["[1]", "junk", '{"seq": 5}']
    assert got.agg(F.max("timestamp")).first()[0].microsecond == 250000
