import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")

from pyspark.sql import SparkSession  # noqa: E402

DATA = Path(os.environ.get("FACTLOOM_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from factloom.session import ship

    ship(session)
    return session


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables here")
    return str(DATA)


@pytest.fixture(scope="session")
def load(spark, data):
    return lambda name: spark.read.parquet(f"{data}/{name}.parquet")


@pytest.fixture(scope="session")
def empty(load):
    return lambda name: load(name).limit(0)
