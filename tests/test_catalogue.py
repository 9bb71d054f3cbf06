import pytest

from parchment.plans import catalogue

from .oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    assert_same(got, connect(SF).execute(catalogue.oracle_sql()[name]).df())
