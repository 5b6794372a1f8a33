import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tabloom.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="session")
def regression(spark):
    """102 rows: numbers with gaps, two categories, a date, a target; two rows repeated."""
    rng = np.random.default_rng(42)
    n = 100
    frame = pd.DataFrame({
        "id": range(1, n + 1), "num1": rng.normal(0, 1, n), "num2": rng.uniform(0, 10, n),
        "cat1": rng.choice(["A", "B", "C"], n), "cat2": rng.choice(["X", "Y"], n),
        "day": pd.date_range("2023-01-01", periods=n), "target": rng.normal(100, 20, n),
    })
    frame.loc[[3, 17, 40, 41, 90], "num1"] = None
    frame.loc[[5, 50, 77], "cat1"] = None
    frame = pd.concat([frame, frame.head(2)], ignore_index=True)
    schema = "id bigint, num1 double, num2 double, cat1 string, cat2 string, day timestamp, target double"
    rows = [
        tuple(None if pd.isna(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r)
        for r in frame.itertuples(index=False, name=None)
    ]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def binary(spark):
    rng = np.random.default_rng(7)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (x1 + 0.5 * x2 + rng.normal(0, 0.3, n) > 0).astype(int)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id bigint, x1 double, x2 double, y int")
