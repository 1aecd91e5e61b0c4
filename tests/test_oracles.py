"""Every registered query against its DuckDB oracle (the driver's correctness gate).

SQL-view queries run at sf0.01; queries that stage files run at sf0.001 to
keep the suite short (the driver runs them at sf0.01).
"""

import pytest

import __spark_entry__ as entry
from compare import compare
from conftest import SF_ORACLE, SF_SMALL
from stagecraft import catalog, catalog_files, catalog_live

FILE_QUERIES = set(catalog_files.QUERIES) | set(catalog_live.QUERIES)
NAMES = sorted(catalog.QUERIES)  # the optional training-data queries have tests of their own


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, duck_oracle, name):
    sf, con = (SF_SMALL, duck_small) if name in FILE_QUERIES else (SF_ORACLE, duck_oracle)
    df = entry.queries()[name](spark, sf)
    problems, _ = compare(df, con, entry.oracle_sql()[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
