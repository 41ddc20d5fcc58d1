from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from facturo.schema import RAW_SCHEMA  # noqa: E402
from facturo.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", app_name="facturo-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def make_raw(spark):
    """Invoice lines from tuples in the declared 8-column order."""

    def build(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


def line(invoice="1", stock="P1", desc="red plate", qty=1, date="2010-01-05 10:00:00", price=1.0, cust=1.0, country="X"):
    return (invoice, stock, desc, qty, date, price, cust, country)
