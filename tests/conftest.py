import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import build_session
    s = build_session("local[4]", 8, app_name="shelfcast-tests",
                      extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


LINE_SCHEMA = ("invoice_id string, stock_code string, description string, qty int, "
               "invoice_timestamp timestamp, unit_price double, customer_id string, country string, "
               "row_order bigint")


@pytest.fixture(scope="session")
def clean_small(spark):
    from shelfcast.plans.catalog import clean
    return clean(spark, SF_SMALL).persist()
