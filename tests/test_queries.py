"""Every registered query against its checking SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLES:  # fitted models, loops and searches: that every column is computed, and sane
        rows = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
        assert rows
        for column, least, most in (("score", None, None), ("p", 0, 1), ("auc", 0, 1), ("rmse", 0, None), ("prediction", None, None), ("rank", 0, None)):
            values = [r[column] for r in rows if isinstance(r.get(column), (int, float))]
            assert all(math.isfinite(v) and (least is None or v >= least) and (most is None or v <= most) for v in values), column
        return
    ok, note = check(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
