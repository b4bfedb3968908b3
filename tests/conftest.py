import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskframe.schema import TRANSACTION_SCHEMA  # noqa: E402
from riskframe.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "riskframe-tests")
    yield session
    session.stop()


# The worked example of FIXTURES.md, section 2.
SEVEN = [
    # transaction, customer, category, amount, value, day, pricing, fraud
    ("T1", "C1", "airtime", 100.0, 100, 1, 1, 0),
    ("T2", "C2", "data", 50.0, 50, 2, 2, 0),
    ("T3", "C1", "airtime", 150.0, 150, 3, 1, 1),
    ("T4", "C3", "financial_services", 200.0, 200, 4, 3, 0),
    ("T5", "C2", "data", -10.0, 10, 5, 2, 0),
    ("T6", "C4", "utility_bill", 500.0, 500, 6, 4, 1),
    ("T7", "C1", "airtime", 75.0, 75, 7, 1, 0),
]


@pytest.fixture(scope="session")
def seven(spark):
    rows = []
    for i, (t, c, category, amount, value, day, pricing, fraud) in enumerate(SEVEN):
        n = c[1]
        rows.append(
            (
                t, f"B{i + 1}", f"A{n}", f"S{n}", c, "UGX", 256, f"P{n}", f"PR{n}", category,
                f"CH{n}", amount, float(value), datetime(2023, 1, day), pricing, fraud,
            )
        )
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


@pytest.fixture(scope="session")
def capped(seven):
    from riskframe.operators.winsorize import winsorize_iqr

    return winsorize_iqr(seven)
