"""Every named query against its reference SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))
FOLDER = "/root/testdata/sf0.001"

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from candlewick.plans.queries import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    from check_oracles import connect

    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) & set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, engine, name):
    from check_oracles import difference

    assert difference(queries()[name](spark, FOLDER).toPandas(), engine.execute(oracle_sql()[name]).df()) is None
