import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from entryclime.session import clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[*]").appName("entryclime-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC"))
    folder = tmp_path_factory.mktemp("spark")
    builder = builder.config("spark.sql.warehouse.dir", str(folder / "warehouse"))
    s = builder.getOrCreate()
    # tests only: give the session a checkpoint folder when the environment names none
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(folder / "checkpoints"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_scratch(s)
    s.stop()


def rows(df, *cols):
    """Collect a small test frame as a list of tuples (in the given column order)."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
