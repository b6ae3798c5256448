import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pressframe.sources.pages import configure

    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages"))).getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def pages_of(spark):
    """``pages(page_id, url, html)`` from a list of HTML texts, numbered from 0."""
    def make(*htmls, url="https://h.example.com/news/"):
        return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return make
