import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadloom.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402
from leadloom.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def leads(spark):
    """Builds raw leads from dictionaries; columns left out are null."""

    def build(*rows):
        return spark.createDataFrame([tuple(row.get(c) for c in RAW_COLUMNS) for row in rows], RAW_SCHEMA)

    return build
