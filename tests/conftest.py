import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankloom import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.createDataFrame([("file1.txt", "Hadoop is yellow Hadoop"),
                                  ("file2.txt", "yellow Hadoop is an elephant")], "doc string, text string")
