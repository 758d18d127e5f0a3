from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.schemas import ORDERS, PRODUCT_CHANGES
from orderloom.session import get_spark

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="orderloom-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """A time on 2024-01-01, from ``HH:MM:SS[.mmm]``."""
    return datetime.fromisoformat(f"2024-01-01 {text}")


@pytest.fixture
def make(spark):
    """Build small orders and changes; times as ``HH:MM:SS`` text or None."""

    class Make:
        @staticmethod
        def orders(*rows):
            return spark.createDataFrame(
                [(o, p, 1, at(t) if t else None) for o, p, t in rows], ORDERS.schema
            )

        @staticmethod
        def changes(*rows):
            return spark.createDataFrame(
                [(p, name, 1, at(t) if t else None, op, seq) for p, name, t, op, seq in rows],
                PRODUCT_CHANGES.schema,
            )

    return Make


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
