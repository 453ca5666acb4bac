"""Every registered query against its SQL oracle."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import batch, live, primitives
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_analytics_query_has_an_oracle():
    assert {*batch.QUERIES, *live.QUERIES, *primitives.QUERIES} <= set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    assert differences(queries()[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry_point_works_without_the_optional_part():
    code = (
        "import sys; sys.modules['stormgauge.llm'] = None; import __spark_entry__ as e; "
        "assert e.queries() and set(e.oracle_sql()) <= set(e.queries()); "
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_entry(spark):
    assert entry(spark).count() > 0
