import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("leadlift-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from leadlift.sources.staging import drop_staged

    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def prepared(spark, medium):
    """Labelled, split customers at the middle size, shared by the model tests."""
    from leadlift.plans.flows import prepare
    from leadlift.sources.customers import load_customers

    return prepare(load_customers(spark, medium))


@pytest.fixture(scope="session")
def trees(prepared):
    from leadlift.operators.models import fit_trees
    from leadlift.settings import FEATURES

    return fit_trees(prepared, FEATURES, {"maxIter": 6, "maxDepth": 3, "subsamplingRate": 1.0})
