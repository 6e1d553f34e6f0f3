import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from frameloom.session import get_spark

    folder = tmp_path_factory.mktemp("shared")
    s = get_spark("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{folder}", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
