import os

import pytest

from foliospark.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, same


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name])
