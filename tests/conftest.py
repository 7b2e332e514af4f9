import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="finwater-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("finwater-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.codegen.aggregate.sortAggregate.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="finwater-test-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
