import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(HERE), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from weftline.session import build

    s = build("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
