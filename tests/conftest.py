"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallyhouse.session import build_session  # noqa: E402
from tallyhouse.sources.retail import Retail  # noqa: E402
from tests.fixture_rows import CUSTOMERS, ORDERS  # noqa: E402

# Errors from inside an adaptive stage reach Python as the plain Java error.
SPARK_ERRORS = (PySparkException, Py4JJavaError)
TEST_FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[8]", "tests")


@pytest.fixture(scope="session")
def retail(spark):
    return Retail(spark, TEST_FOLDER)


@pytest.fixture(scope="session")
def customers(spark):
    raw = spark.createDataFrame(CUSTOMERS, "customer_id int, purchases string, loyalty_tier string")
    return raw.select(
        "customer_id", F.col("purchases").cast("decimal(10,2)").alias("total_purchases"), "loyalty_tier"
    )


@pytest.fixture(scope="session")
def orders(spark):
    raw = spark.createDataFrame(
        ORDERS, "order_id int, customer_id int, day string, amount string, order_status string"
    )
    return raw.select(
        "order_id", "customer_id", F.col("day").cast("date").alias("order_date"),
        F.col("amount").cast("decimal(10,2)").alias("total_amount"), "order_status",
    )


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """The physical plan as text, before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
