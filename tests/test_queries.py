"""Every query of the library: equal to its oracle, or at least rows of a stable schema."""

import os

import pytest

from foliospark.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, same

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1
