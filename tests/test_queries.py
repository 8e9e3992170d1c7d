import os

import pytest

from tessera import plans
from tests.oracle import connect, same

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, con, name):
    df = plans.queries()[name](spark, FOLDER)
    if name in plans.oracle_sql():
        same(df, con, plans.oracle_sql()[name])
    else:
        assert df.count() >= 0


def test_every_sql_has_a_query():
    assert set(plans.oracle_sql()) <= set(plans.queries())
