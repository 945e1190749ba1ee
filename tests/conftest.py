from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallymart.params import Params  # noqa: E402
from tallymart.session import local_session  # noqa: E402
from tallymart.sources.schema import ORDER_SCHEMA  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tallymart-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def params():
    return Params(completed_status="F", as_of=dt.date(2002, 1, 1))


@pytest.fixture(scope="session")
def make_orders(spark):
    """Build typed orders from partial rows; absent cells get plain defaults."""
    from decimal import Decimal

    base = {
        "order_date": dt.datetime(2025, 1, 6, 10),
        "category": "A",
        "product": "p",
        "region": "R",
        "city": "c",
        "channel": "web",
        "customer_id": "C1",
        "customer_type": "new",
        "unit_price": Decimal("10.00"),
        "quantity": 1,
        "total_amount": Decimal("10.00"),
        "discount_rate": Decimal("0.0000"),
        "final_amount": Decimal("10.00"),
        "payment_method": "card",
        "order_status": "F",
    }
    money = {"unit_price", "total_amount", "discount_rate", "final_amount"}

    def build(*rows: dict, schema=ORDER_SCHEMA):
        filled = []
        for i, row in enumerate(rows):
            cells = {"order_id": f"O{i}", **base, **row}
            if schema is ORDER_SCHEMA:
                for name in money:
                    if cells[name] is not None:
                        cells[name] = Decimal(str(cells[name]))
            filled.append(tuple(cells[f.name] for f in schema))
        return spark.createDataFrame(filled, schema)

    return build
