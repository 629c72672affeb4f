import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from logtide.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "line string")

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(name="plan_of")
def plan_fixture():
    return plan_of


@pytest.fixture
def executed_plans(spark):
    """The final plans of all executions that a function starts, from Spark's own status store.

    Executions are told by their ids: the store drops old ones, so numbers in its list move.
    """

    def run(function):
        store = spark._jsparkSession.sharedState().statusStore()
        bus = spark.sparkContext._jsc.sc().listenerBus()

        def kept():
            bus.waitUntilEmpty(20_000)
            found = store.executionsList()
            return [found.apply(i) for i in range(found.size())]

        last = max((e.executionId() for e in kept()), default=-1)
        function()
        return [e.physicalPlanDescription() for e in kept() if e.executionId() > last]

    return run
