"""Every query of the catalogue against its SQL; those without SQL run."""

import os

import pytest

from marlspark import catalog

from .oracle import same

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    if name in catalog.ORACLES:
        same(catalog.QUERIES[name], catalog.ORACLES[name], spark, SF_DIR)
    else:
        assert catalog.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_works_with_or_without_optional_parts(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 50
    assert set(entry.oracle_sql()) <= set(entry.queries())
