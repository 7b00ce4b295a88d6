import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package and the tests' own functions too.
paths = [ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH")]
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, paths))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from freshet.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "freshet-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "3",
            "spark.default.parallelism": "3",
            # Compiling takes longer than running on test data.
            "spark.sql.codegen.wholeStage": "false",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
