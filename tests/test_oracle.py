"""Every registered query equals its DuckDB oracle (names, Arrow types, values) on sf0.001."""

import pytest

from keyloop.plans import catalog
from oracle_harness import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert name in catalog.ORACLE, "every query of the catalog has an oracle"
    assert res["ok"], res


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() >= 0 and "ticket_id" in df.columns
