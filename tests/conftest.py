import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.schemas import RAW  # noqa: E402

ROWS = {
    "customers": [
        ("c1", "u1", "1234", "sao paulo", "sp"),
        ("c2", "u2", "56789", "RIO DE JANEIRO", "rj"),
        ("c3", "u3", "100", "  brasilia  ", "df"),
    ],
    "geolocation": [
        ("1234", -23.5, -46.6, "sao paulo", "sp"),
        ("1234", -23.6, -46.7, "sao paulo", "sp"),
        ("5678", -22.9, -43.2, "rio de janeiro", "rj"),
        ("5678", -22.8, -43.1, "rio de janeiro", "rj"),
        ("5678", -22.7, -43.3, "rio de janeiro", "rj"),
    ],
    "orders": [
        ("o1", "c1", "delivered", "2018-01-15 10:00:00", "2018-01-15 11:00:00", "2018-01-16 08:00:00", "2018-01-20 10:00:00", "2018-01-25 00:00:00"),
        ("o2", "c2", "shipped", "2018-02-20 14:30:00", "2018-02-20 15:00:00", None, None, "2018-03-10 00:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", "2018-01-18 00:00:00", 100.0, 10.0),
        ("o1", 2, "p2", "s2", "2018-01-18 00:00:00", 200.0, 20.0),
        ("o2", 1, "p1", "s1", "2018-02-25 00:00:00", 150.0, 15.0),
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 3, 250.0),
        ("o1", 2, "voucher", 1, 50.0),
        ("o2", 1, "boleto", 1, 150.0),
    ],
    "order_reviews": [
        ("r1", "o1", 3, None, "fine", "2018-02-01", "2018-02-02 10:00:00"),
        ("r2", "o1", 5, "top", None, "2018-02-10", "2018-02-11 10:00:00"),
        ("r3", "o2", 4, None, None, "2018-03-05", "2018-03-06 10:00:00"),
    ],
    "products": [
        ("p1", "informatica", 50.0, 500.0, 3.0, 1000.0, 30.0, 10.0, 20.0),
        ("p2", None, None, 300.0, None, 500.0, None, 5.0, None),
        ("p3", "beleza_saude", 30.0, None, 2.0, None, 20.0, None, 15.0),
    ],
    "sellers": [("s1", "1234", "sao paulo", "sp"), ("s2", "5678", "rio de janeiro", "rj")],
    "category_translation": [("informatica", "computers"), ("beleza_saude", "health_beauty")],
}


@pytest.fixture(scope="session")
def spark():
    from tallyhouse.session import local_session

    session = local_session("4", "tests", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Raw dataset from rows: make('orders', [(...), ...])."""
    return lambda name, rows: spark.createDataFrame(rows, RAW[name])


@pytest.fixture(scope="session")
def raw(make):
    return {name: make(name, rows) for name, rows in ROWS.items()}


@pytest.fixture(scope="session")
def clean(raw):
    from tallyhouse.operators.cleaning import clean_all

    return clean_all(raw)


@pytest.fixture(scope="session")
def built(clean):
    from tallyhouse.operators.modelling import build_star

    return build_star(clean)


@pytest.fixture(scope="session")
def published(spark, built, tmp_path_factory):
    from tallyhouse.sinks.snapshot import publish, read_star

    root = str(tmp_path_factory.mktemp("warehouse"))
    publish(spark, built, root)
    return {"root": root, "star": read_star(spark, root)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
