import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.schemas import SOURCE_COLUMNS, SOURCE_SCHEMA  # noqa: E402

DEFAULT_ROW = {
    "order_item_id": "1001",
    "order_id": "5001",
    "product_id": "200",
    "quantity": "2",
    "customer_id": "300",
    "order_date": "2022-06-15",
    "total_amount": "1000.00",
    "name": "Ahmed Hassan",
    "city": "Cairo",
    "email": "ahmed@example.com",
    "signup_date": "2021-01-01",
    "product_name": "Laptop",
    "category": "Electronics",
    "price": "600.00",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def source(spark):
    """Source rows as text: ``source(dict(city='x'), {...})``; no argument gives the default row."""

    def make(*overrides):
        rows = [tuple({**DEFAULT_ROW, **o}[c] for c in SOURCE_COLUMNS) for o in (overrides or ({},))]
        return spark.createDataFrame(rows, SOURCE_SCHEMA)

    return make
