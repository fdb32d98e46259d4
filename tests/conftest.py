import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="ordo-tests-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("ordo-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", tempfile.mkdtemp(prefix="ordo-tests-log-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "value string")
    return make


@pytest.fixture
def text_file(tmp_path):
    """Write raw bytes or lines to a file and return its path."""
    counter = {"n": 0}

    def make(content, name=None):
        counter["n"] += 1
        p = tmp_path / (name or f"input{counter['n']}.txt")
        data = content if isinstance(content, bytes) else "".join(x + "\n" for x in content).encode("utf-8")
        p.write_bytes(data)
        return str(p)
    return make
