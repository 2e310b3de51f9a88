import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retort.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app="retort-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR


def one(spark, expr, schema="x string", value=None):
    """Evaluate a Column function on a one-row frame."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("out")).first().out
