"""The driver contract, checked like the driver does, at the smallest scale."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck
from conftest import SF_SMALL

NO_ORACLE: set = set()
#: The library's own queries; the pipeline operators have tests of their own.
OWN = {k for k, f in E.queries().items() if not f.__module__.startswith(("saltkv.llm", "corpus_pipeline"))}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "row_key" in df.columns and "opinin" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert OWN - set(E.oracle_sql()) == NO_ORACLE
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(OWN - NO_ORACLE))
def test_query_matches_oracle(spark, con, name):
    s, d = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert s == d


def test_list_tables_rows(spark):
    rows = [r.qualified_name for r in E.queries()["list_tables"](spark, SF_SMALL).collect()]
    assert rows == ["keyspace:check", "keyspace:opinion"]
