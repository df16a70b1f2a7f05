import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from cardwarden.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir("file:" + str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def two_rows(spark):
    """Same card and home, two merchants, one positive."""
    rows = [
        ("2019-01-01 00:00:00", "1", "M1", "food_dining", 1000.0, 30.2672, -97.7431, 30.30, -97.70, "a" * 32, 0),
        ("2019-01-01 01:00:00", "1", "M2", "shopping_net", 10.0, 30.2672, -97.7431, 30.31, -97.69, "b" * 32, 1),
    ]
    return spark.createDataFrame(
        rows,
        "trans_date_trans_time string, cc_num string, merchant string, category string, amt double, "
        "lat double, long double, merch_lat double, merch_long double, trans_num string, is_fraud int",
    )
