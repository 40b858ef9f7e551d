import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.sources.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def shipped(request):
    """Functions of a test module reach the workers by value."""
    cloudpickle.register_pickle_by_value(request.module)
    yield
    cloudpickle.unregister_pickle_by_value(request.module)


@pytest.fixture
def column(spark):
    """Evaluate a column expression over the values of ``t``."""

    def run(expression, values, kind="string"):
        rows = [(i, value) for i, value in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, t {kind}")
        return [r.v for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]

    return run


@pytest.fixture(scope="session")
def plan(spark):
    """The physical plan of a frame as text, before adaptive changes."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
