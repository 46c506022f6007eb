import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from macrotide.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = SparkSession.builder.master("local[8]").appName("tests")
    session = configure(builder, {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "4g",
    }).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
