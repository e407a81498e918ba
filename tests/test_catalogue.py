"""Every query with SQL gives the rows of that SQL."""

import pytest

from rollcall.plans.catalogue import ORACLE_SQL, QUERIES
from tests.compare import duck, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in ORACLE_SQL:
        want = duck(FOLDER).sql(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
