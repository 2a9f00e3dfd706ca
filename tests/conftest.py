import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata/sf0.001"
#: Small tables spend their time compiling; RATELOOM_TEST_CODEGEN=1 runs the tests on generated code instead.
INTERPRETED = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rateloom.session import build_session

    s = build_session("local[4]", 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", **({} if os.environ.get("RATELOOM_TEST_CODEGEN") else INTERPRETED)})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of plain tuples."""

    def get(df, *columns):
        cols = columns or df.columns
        return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)

    return get
