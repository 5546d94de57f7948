import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from carestay.session import DEFAULT_CONF
    b = SparkSession.builder.master("local[4]").appName("carestay-tests").config("spark.sql.shuffle.partitions", "4")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carestay-test-ckpt-"))
    yield s
    s.stop()


def stay_rows(spark, rows, cols=None):
    """Small bronze-like frame from dicts (missing columns are null)."""
    from carestay.schema import STAY_SCHEMA
    names = [f.name for f in STAY_SCHEMA.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, STAY_SCHEMA)
