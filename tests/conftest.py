from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from basketwork import schemas  # noqa: E402
from basketwork.operators import star  # noqa: E402
from basketwork.operators.warehouse import Warehouse  # noqa: E402
from basketwork.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 6, 30)
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark_sql_shuffle_partitions="2", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false", spark_driver_memory="4g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


DEFAULTS = {
    "customers": {"email": "a@b.io", "phone": "1234567890", "registration_date": dt.date(2024, 1, 1), "age": 40},
    "products": {"name": "thing", "category": "toys", "price": 10.0, "currency": "EUR", "availability": True},
    "marketing_campaigns": {"name": "spring", "channel": "mail", "status": "ACTIVE"},
    "sales_transactions": {
        "customer_id": "c", "product_id": "p", "quantity": 1, "unit_price": 10.0, "amount": 10.0,
        "discount_amount": 0.0, "tax_amount": 0.0, "transaction_date": dt.datetime(2024, 6, 1), "status": "completed",
        "payment_method": "cash",
    },
}


@pytest.fixture(scope="session")
def feed(spark):
    """`feed(name, {...}, {...})`: a staging frame of rows given as dicts over defaults."""

    def make(name: str, *rows: dict):
        schema = schemas.FEEDS[name]
        values = [{**DEFAULTS[name], **row} for row in rows]
        return spark.createDataFrame([tuple(v.get(f.name) for f in schema.fields) for v in values], schema)

    return make


@pytest.fixture(scope="session")
def warehouse(feed):
    """`warehouse(customers=[...], products=[...], campaigns=[...], sales=[...])` from feed rows."""

    def make(customers=(), products=(), campaigns=(), sales=(), as_of=AS_OF) -> Warehouse:
        c = star.dim_customers(feed("customers", *customers))
        p = star.dim_products(feed("products", *products))
        m = star.dim_campaigns(feed("marketing_campaigns", *campaigns), as_of)
        numbered = [{"transaction_id": f"t{i}", **row} for i, row in enumerate(sales)]
        c, p, m = c.cache(), p.cache(), m.cache()
        return Warehouse(c, p, m, star.fact_sales(feed("sales_transactions", *numbered), c, p).cache())

    return make


def rows_by(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
