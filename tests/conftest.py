import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart import schemas  # noqa: E402
from tallymart.session import build_session  # noqa: E402
from tallymart.sources.tables import Warehouse  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    prefix = f"t{abs(hash(str(tmp_path)))}_"
    return Warehouse(spark, str(tmp_path / "store"), prefix)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions over one row and return their values."""
    return lambda *columns: tuple(spark.range(1).select(*columns).first())


ORDER = dict(
    order_id="o1", customer_id="c1", product_id="p1", country="X", segment="vip", category="Books",
    brand="B", status="completed", is_weekend=False, order_date=date(2024, 1, 2), quantity=1,
    unit_price_eur=10.0, total_eur=10.0, total_cost_eur=4.0, margin_eur=6.0,
)
LOG = dict(
    timestamp=datetime(2024, 1, 1, 10, 0, 0), user_id="u1", model="phi3", prompt="hi", response="yo",
    prompt_tokens=100, output_tokens=200, total_tokens=300, latency_ms=1000, cost_usd=0.5,
    consumed_at=datetime(2024, 1, 1, 10, 0, 1),
)


def _rows(template, schema):
    def build(spark, *changes):
        data = [tuple({**template, **change}[name] for name in schema.names) for change in changes]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture(scope="session")
def orders(spark):
    return lambda *changes: _rows(ORDER, schemas.raw_form(schemas.ORDERS))(spark, *changes)


@pytest.fixture(scope="session")
def logs(spark):
    return lambda *changes: _rows(LOG, schemas.CONSUMED_LOG)(spark, *changes)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
