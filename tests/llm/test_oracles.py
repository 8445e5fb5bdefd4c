from __future__ import annotations

import pytest

from snapmart.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import duck, duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_check, name):
    assert spark_rows(QUERIES[name](spark, sf_check)) == duck_rows(duck(sf_check), ORACLE_SQL[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
