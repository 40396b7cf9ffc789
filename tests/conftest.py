import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from propensity.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("propensity-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="propensity-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def prepared01(spark):
    """Prepared fixture at sf0.01, written once and read back."""
    from propensity.plans.registry import prepared
    path = tempfile.mkdtemp(prefix="propensity-prep-") + "/p"
    prepared(spark, SF01).write.parquet(path)
    return spark.read.parquet(path)
