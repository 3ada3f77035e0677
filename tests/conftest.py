import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="tissuemill-tests-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints").config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
