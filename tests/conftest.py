from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from balcao.session import local_session

    os.environ.setdefault("BALCAO_DRIVER_MEMORY", "6g")
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(warehouse)}
    )
    yield session
    session.stop()


@pytest.fixture
def make_sales(spark):
    """Builds (orders, details, customers, products) from compact rows.

    `orders` maps an order to (customer, day); `items` lists
    (order, product, price, quantity, discount).
    """
    from balcao.operators import silver

    def build(orders: dict, items: list[tuple], categories: dict | None = None):
        header = [
            (o, c, date.fromisoformat(d), Decimal("1.00")) for o, (c, d) in orders.items()
        ]
        lines = [(o, p, Decimal(str(u)), q, Decimal(str(d))) for o, p, u, q, d in items]
        clients = sorted({c for c, _ in orders.values()})
        goods = sorted({i[1] for i in items} | set(categories or {}))
        raw_orders = spark.createDataFrame(header, "order_id long, customer_id string, order_date date, freight decimal(10,2)")
        raw_details = spark.createDataFrame(
            lines, "order_id long, product_id long, unit_price decimal(10,2), quantity int, discount decimal(4,2)"
        )
        raw_customers = spark.createDataFrame([(c, f"Empresa {c}") for c in clients], "customer_id string, company_name string")
        raw_products = spark.createDataFrame(
            [(p, f"produto {p}", (categories or {}).get(p, 1), Decimal("10.00")) for p in goods],
            "product_id long, product_name string, category_id int, unit_price decimal(10,2)",
        )
        return (
            silver.orders(raw_orders),
            silver.order_details(raw_details),
            silver.customers(raw_customers),
            silver.products(raw_products),
        )

    return build
