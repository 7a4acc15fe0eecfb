import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
