import os

import pytest

from checks.compare import differences, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = os.environ.get("SHELFMARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert differences(spark, con, name, SF) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
