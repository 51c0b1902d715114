import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerline.session import DEFAULT_CONF, checkpoint_root
    builder = (SparkSession.builder.master("local[*]").appName("ledgerline-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.sparkContext.getConf().get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    checkpoint_root(session)
    yield session
    session.stop()
