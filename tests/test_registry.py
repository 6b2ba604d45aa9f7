"""Every registered query next to its SQL in DuckDB, on whole tables of the smallest size."""

import os
import sys

import pytest

import __spark_entry__ as registry
from tests.helpers import TESTDATA
from tillroll.rules import CATEGORIES, KEYWORD_RULES
from tools.compare import connect, difference

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(registry._statement_queries()) == set(registry._statement_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry._statement_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, TESTDATA)
    assert difference(df, duck, registry.oracle_sql()[name]) is None


def test_registry_without_the_training_data_operators(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("tillroll.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tillroll.llm.queries", None)
    assert set(registry.queries()) == set(registry._statement_queries())
    assert set(registry.oracle_sql()) == set(registry._statement_sql())


def test_queries_prove_the_defaults(spark):
    kinds = registry.queries()["recurring_defaults"](spark, TESTDATA).select("recurrence_type").distinct()
    assert {r[0] for r in kinds.collect()} == {"MONTHLY", "OCCASIONAL", "IRREGULAR"}
    labels = registry.queries()["default_rules"](spark, TESTDATA).select("category").distinct()
    missing = set(CATEGORIES) - {r[0] for r in labels.collect()}
    assert missing <= {label for label in CATEGORIES if label not in dict(KEYWORD_RULES).values()}


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[:3] == ["statement_month", "category", "total_spend"]
    assert df.count() > 0
