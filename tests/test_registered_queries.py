import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import TESTDATA
from comparison import connect, differences

FOLDER = f"{TESTDATA}/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


#: Beyond SQL: each has tests of its own against a plain version in tests/llm.
WITHOUT_SQL = {
    "op1_suffix", "op2_wavelet", "op3_ngram_join", "op4_line_dedup", "op5_neighbours", "op6_toxicity",
    "op7_decontaminate", "op8_packing", "op9_quality", "op12_language", "pipeline",
}


def test_every_query_has_sql():
    assert set(queries()) - WITHOUT_SQL == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
