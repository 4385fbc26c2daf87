from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))

from marketloom.operators import cleaning  # noqa: E402
from marketloom.session import build_session  # noqa: E402

SAMPLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_dir():
    if not SAMPLES.exists():
        pytest.skip("sample tables are not here")
    return str(SAMPLES)


SCHEMA = (
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, InvoiceDate TIMESTAMP_NTZ, "
    "UnitPrice DECIMAL(18,2), CustomerID STRING, Country STRING"
)


@pytest.fixture(scope="session")
def make_lines(spark):
    """Invoice lines with derived columns from short tuples.

    A tuple is (invoice, product, quantity, price, customer, date), with an optional description and
    country behind it.
    """

    def build(*rows):
        full = []
        for row in rows:
            invoice, code, quantity, price, customer, when = row[:6]
            name = row[6] if len(row) > 6 else f"item {code}"
            country = row[7] if len(row) > 7 else "France"
            if isinstance(when, str):
                when = dt.datetime.fromisoformat(when)
            full.append((invoice, code, name, quantity, when, Decimal(str(price)), customer, country))
        return cleaning.add_line_columns(spark.createDataFrame(full, SCHEMA))

    return build
