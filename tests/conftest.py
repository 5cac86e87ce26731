import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("cellhealth-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellhealth-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="cellhealth-test-")


@pytest.fixture(scope="session")
def small_trained(spark):
    """(models of three shallow rounds at sf0.01, their configuration), fitted once for all tests."""
    from cellhealth.operators.models import TreeParams
    from cellhealth.plans import catalog, training

    cfg = training.TrainingConfig(params=TreeParams(max_iter=3, max_depth=2, max_bins=8))
    st = catalog.Stages(spark, SF_MID)
    return training.fit_all(st.final, cfg, frame=st.features), cfg
