"""Groups of equal texts stay in one shard."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from candlewick.llm import sharding


def test_groups_that_fit_lie_in_one_shard(spark):
    sizes = [300, 120, 60, 40, 20, 20]  # of 2400 rows; a shard has room for 300
    rows = [(f"group {g} " + "w " * 20, n) for g, n in enumerate(sizes)]
    texts = [t for t, n in rows for _ in range(n)]
    texts += [f"own {i} " + "v " * 20 for i in range(2400 - len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    where, load = defaultdict(set), defaultdict(int)
    for r in sharding.shard(docs).collect():
        where[texts[r["doc_id"]]].add(r["shard"])
        load[r["shard"]] += r["size"]
    assert all(len(where[t]) == 1 for t, _ in rows[1:])
    assert len(where[rows[0][0]]) <= 2  # as heavy as a shard is large
    assert max(load.values()) - min(load.values()) <= 0.05 * sum(load.values()) / 8


def test_a_group_without_room_is_cut_into_the_fewest_pieces():
    # 30 % of all in pieces of 1 %, a group of 10 %, and single items.
    items = np.ones((100, 3))
    groups = np.array([0] * 30 + [1] * 10 + list(range(2, 62)))
    placed = sharding.pack(items, 8, groups)
    assert len(set(placed[:30])) == 3 and len(set(placed[30:40])) == 1
    assert np.bincount(placed).max() <= 13
    alone = sharding.pack(np.ones((80, 3)), 8, np.zeros(80))
    assert (np.bincount(alone) == 10).all()
    assert len(sharding.pack(np.zeros((0, 3)), 8, np.array([], str))) == 0


def test_null_ids_are_spread(spark):
    """A hot text whose rows have no id is cut like one whose rows have ids of their own."""
    from candlewick.llm import sharding

    others = [(i, f"text number {i} " * 6) for i in range(2400)]

    def sizes(ids):
        rows = [(i, "the same text " * 14) for i in ids] + others
        placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(placed) == 4000
        return sorted(sum(r["size"] for r in placed if r["shard"] == k) for k in range(8))

    found = sizes([None] * 1600)
    assert found == sizes(range(10_000, 11_600)) and found[-1] < 1.2 * found[0]
