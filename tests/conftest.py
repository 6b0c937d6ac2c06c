import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="tableflow-tests",
                      **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "2000"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def person(spark):
    # Keys 1 to 4, whose salts by 2 are 1, 0, 1, 0
    return spark.createDataFrame(
        [(1, "Oskar", 51, "m", "baker"), (2, "Lin", 27, "f", "pilot"),
         (3, "Noor", 33, "f", "judge"), (4, "Teo", 64, "m", "farmer")],
        "key int, name string, age int, gender string, occupation string",
    )
