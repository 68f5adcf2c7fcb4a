from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    d = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(d).exists():
        pytest.skip(f"{d} is not there")
    return d
