"""Every named query against its SQL, on the smallest tables."""

import oracle
import pytest

import __spark_entry__
from tidevault.plans import registry

SF_DIR = "/root/testdata/sf0.001"
# Those of the subpackage llm have tests of their own.
QUERIES = {k: q for k, q in __spark_entry__.queries().items() if k in registry.QUERIES}
ORACLES = {k: q for k, q in __spark_entry__.oracle_sql().items() if k in registry.ORACLES}
# Sizes depend on the file format, so no SQL can tell them.
NO_SQL = {"chunk_sizes_readable", "compaction_sizes"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) == set(ORACLES) | NO_SQL
    assert not set(ORACLES) & NO_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_sizes_fall_and_are_readable(spark):
    sizes = QUERIES["compaction_sizes"](spark, SF_DIR).collect()
    assert sizes and all(r.rows_before == r.rows_after and r.files_after == 1 for r in sizes)
    shown = QUERIES["chunk_sizes_readable"](spark, SF_DIR).collect()
    assert all(r["size"] == f"{r['bytes']} bytes" for r in shown if r["bytes"] < 10240)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
