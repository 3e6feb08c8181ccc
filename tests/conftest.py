import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from curato.policy import Policy  # noqa: E402

AS_OF = dt.date(2006, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("curato-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curato-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def policy_a():
    return Policy(as_of=AS_OF)


@pytest.fixture
def policy_b():
    return Policy(variant="B", as_of=AS_OF)


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="curato-test-")
