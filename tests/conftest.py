import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

REPO = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = os.pathsep.join([REPO, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"
