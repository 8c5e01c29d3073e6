import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from equitrace.session import local_session  # noqa: E402
from equitrace.sources.workspace import drop_staged  # noqa: E402
from tools.check_queries import TABLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def inputs(spark):
    from equitrace.catalog.inputs import Inputs

    return Inputs(spark, SF_DIR)


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
