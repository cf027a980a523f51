"""Every named query against its check query, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, name, SMALL)
    assert verdict.startswith(("same", "rows only")), verdict


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.limit(1).count() == 1 and "montant_moyen_client_30j" in df.columns
