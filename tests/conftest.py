from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemill.session import build_session, scratch_dir  # noqa: E402
from tidemill.sources.store import Store  # noqa: E402

# The sample rows.
CUSTOMERS_CSV = """customer_id,first_name,last_name,email,created_at
1,Alice,Smith,alice@example.com,2024-01-15
2,Bob,Jones,bob@example.com,2024-02-20
3,Charlie,Brown,charlie@example.com,2024-03-10
4,Diana,Prince,diana@example.com,2024-04-05
5,Eve,Wilson,eve@example.com,2024-05-12
"""
ORDERS_CSV = """order_id,customer_id,order_date,amount,status
1001,1,2024-06-01,150.00,completed
1002,2,2024-06-02,89.99,completed
1003,1,2024-06-05,220.50,completed
1004,3,2024-06-10,45.00,pending
1005,4,2024-06-15,310.00,completed
1006,2,2024-06-20,67.50,cancelled
1007,5,2024-06-25,199.99,completed
1008,1,2024-07-01,85.00,completed
1009,3,2024-07-05,125.00,pending
1010,4,2024-07-10,430.00,completed
"""
PRODUCTS_CSV = """product_id,name,category,price,created_at
1,Widget A,electronics,29.99,2024-01-10
2,Widget B,electronics,49.99,2024-02-15
3,Gadget C,accessories,12.50,2024-03-20
4,Gadget D,accessories,8.99,2024-04-01
5,Thingamajig,other,199.99,2024-05-05
"""


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return Store(spark, scratch_dir(spark, "test"))


@pytest.fixture
def seeds(tmp_path):
    """Folder with the sample CSV files."""
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV)
    (tmp_path / "orders.csv").write_text(ORDERS_CSV)
    (tmp_path / "products.csv").write_text(PRODUCTS_CSV)
    return str(tmp_path)


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    got = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(got, key=repr)


def plan(df) -> str:
    """Physical plan as text, exchanges not yet re-planned."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
