import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from veristream.session import build_session

    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": f"{root}/warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of an expression over one text."""
    from pyspark.sql import functions as F

    def value(expression, text):
        df = spark.createDataFrame([(text,)], "text string")
        return df.select(expression(F.col("text")).alias("out")).first()["out"]

    return value
