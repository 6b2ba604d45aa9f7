"""The registered queries of the training-data operators next to their SQL."""

import pytest

from tests.llm.helpers import TESTDATA, needs_tables
from tillroll.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import connect, difference

pytestmark = needs_tables


def test_one_query_per_operator():
    numbers = [name.split("_")[0] for name in QUERIES if name != "pipeline"]
    assert numbers == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, TESTDATA), connect(TESTDATA), ORACLE_SQL[name]) is None
