"""Every catalogue query against its SQL."""

import pytest
from comparison import DATA, duck, duck_rows, spark_rows

from freshet.plans.catalogue import QUERIES
from freshet.plans.oracles import ORACLES

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(con, ORACLES[name])


@pytest.mark.parametrize("name", ["stream_incremental", "stream_replay", "stream_capped"])
def test_streams_of_a_folder_of_files(spark, tmp_path, name):
    """The documents as a larger table has them, a folder of several files, some updated after the first run."""
    documents = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert spark_rows(QUERIES[name](spark, str(tmp_path))) == duck_rows(duck(f"{DATA}/sf0.01"), ORACLES[name])
