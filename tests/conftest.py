from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.operators.tables import RetailTables  # noqa: E402
from tallyloom.session import build_session  # noqa: E402
from tallyloom.sources.schemas import RAW_DDL  # noqa: E402

SAMPLE_FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tallyloom-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_folder():
    return SAMPLE_FOLDER


def _order(order, customer, status, bought):
    return (order, customer, status, bought, None, None, None, None)


# Small raw tables with one row for each rule that is easy to get wrong.
RAW_ROWS = {
    "categories": [
        ("bed_bath", "bed_bath x"),
        (" TOYS ", " Toys "),
        (None, "nothing"),
    ],
    "customers": [
        ("c1", "anna", "01000", " sao paulo ", "sp"),
        ("c2", "anna", "01000", "sao paulo", " sp "),
        ("c3", "bert", "02000", "rio", "rj"),
        ("c4", "cleo", "03000", "rio", "rj"),
        ("c5", "dora", "04000", "rio", "rj"),
        ("c6", None, "05000", "rio", "rj"),
    ],
    "sellers": [("s1", "01000", " campinas ", " sp"), (None, "x", "y", "z")],
    "products": [
        ("p1", " BED_BATH ", 1, 1, 1, 100, 1, 1, 1),
        ("p2", "toys", 1, 1, 1, None, 1, 1, 1),
        ("p3", None, 1, 1, 1, 300, 1, 1, 1),
        ("p4", "pc_gamer", 1, 1, 1, 400, 1, 1, 1),
    ],
    "orders": [
        _order("o1", "c1", " DELIVERED ", "2018-01-01 10:00:00"),
        _order("o2", "c2", "shipped", "2018-01-01 23:30:00"),
        _order("o3", "c3", "delivered", "2018-01-30 00:00:00"),
        _order("o4", "c4", "canceled", "2018-01-31 00:00:00"),
        _order("o5", "c5", None, "2018-02-01 00:00:00"),
        _order("o6", "c5", "delivered", "n/a"),
        _order("o7", "c5", "delivered", "2018-01-31 12:00:00"),
        _order(None, "c5", "delivered", "2018-01-31 12:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", "2018-01-05 00:00:00", "10.00", "1.50"),
        ("o1", 2, "p1", "s1", "2018-01-05 00:00:00", "10.00", "1.50"),
        ("o1", 2, "p2", "s1", "2018-01-05 00:00:00", "99.00", "1.50"),
        ("o2", 1, "p2", "s1", "n/a", "20.00", "0.00"),
        ("o3", 1, "p4", "s1", None, "30.00", "0.01"),
        ("o4", 1, "p3", "s1", None, "40.00", "0.00"),
        ("o5", 1, "p3", "s1", None, "50.00", "0.00"),
        ("o6", 1, "p3", "s1", None, "60.00", "0.00"),
        ("o7", 1, "p3", "s1", None, "70.00", "0.00"),
        ("lost", 1, "p1", "s9", None, "80.00", "0.00"),
        ("o7", 2, "p3", "s1", None, "-1.00", "0.00"),
    ],
    "order_payments": [
        ("o1", 2, " VOUCHER ", 1, "11.50"),
        ("o1", 1, "credit_card", 3, "11.50"),
        ("o2", 1, "boleto", 1, "20.00"),
        ("o3", 1, "boleto", 1, "-5.00"),
        ("lost", 1, "boleto", 1, "80.00"),
    ],
    "order_reviews": [
        ("r1", "o1", 5, None, "line one\nline \"two\"", "2018-01-10 00:00:00", None),
        ("r2", "o1", 4, None, None, "2018-01-11 00:00:00", None),
        ("r3", "o2", 0, None, None, "2018-01-11 00:00:00", None),
        ("r4", "o2", 6, None, None, "2018-01-11 00:00:00", None),
        ("r5", "o3", 3, None, None, "bad", None),
    ],
}


def raw_frame(spark, table, rows):
    """Rows of a raw table; money is given as text."""
    from decimal import Decimal

    from tallyloom.sources.schemas import raw_schema

    money = [i for i, f in enumerate(raw_schema(table)) if "decimal" in f.dataType.simpleString()]
    typed = [
        tuple(Decimal(v) if i in money and v is not None else v for i, v in enumerate(row))
        for row in rows
    ]
    return spark.createDataFrame(typed, RAW_DDL[table])


@pytest.fixture(scope="session")
def raw(spark):
    return {table: raw_frame(spark, table, rows) for table, rows in RAW_ROWS.items()}


@pytest.fixture(scope="session")
def tables(raw):
    return RetailTables.from_raw(raw)


def as_dicts(df):
    return [row.asDict() for row in df.collect()]


def by_key(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
