import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from caseloom.session import build_session

    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    """The rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
