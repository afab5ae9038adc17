"""Every query of the registry against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import same
from registry.oracles import ORACLES
from registry.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert name in ORACLES
    assert same(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) is None


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_the_question_by_account_has_rows(spark, sf_dir):
    assert QUERIES["q3_segment_changes"](spark, sf_dir).count() > 0


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 25
