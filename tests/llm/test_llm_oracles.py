"""Corpus queries against their SQL, and what the driver finds."""

import __spark_entry__
import pytest
from comparison import DATA, duck, duck_rows, spark_rows

from freshet.llm.queries import ORACLES, QUERIES

SF_DIR = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(duck(SF_DIR), ORACLES[name])


def test_entry_has_all_operators_and_the_pipeline():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
