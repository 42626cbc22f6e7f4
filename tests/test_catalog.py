import pytest

from oracle import assert_same
from traceloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    if name in catalog.ORACLES:
        assert_same(df, catalog.ORACLES[name], SF)
    else:
        assert df.count() >= 0
