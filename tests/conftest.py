import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
