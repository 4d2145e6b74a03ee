import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from docrank.session import checkpoint_dir, local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="docrank-tests")
    checkpoint_dir(s)  # sets a local folder only because none is configured here
    yield s


@pytest.fixture(scope="session")
def golden(spark):
    rows = [("d1", "moon rocket fuel"), ("d2", "The moon moon orbit"), ("d3", "law court law"),
            ("d4", "rocket engine"), ("d5", "")]
    return spark.createDataFrame(rows, "doc_id string, text string")
