import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    b = (SparkSession.builder.master("local[4]").appName("tessera-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # the environment's spark.checkpoint.dir is used when set; only in local
    # mode and only when it is unset does the library pick its own folder
    from tessera.session import ensure_checkpoint_dir, release_scratch
    ensure_checkpoint_dir(s)
    yield s
    release_scratch(s)


@pytest.fixture
def scratch(spark):
    from tessera.session import scratch_path
    return lambda label="t": scratch_path(spark, label)
