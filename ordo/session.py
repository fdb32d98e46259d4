"""Session helpers: a local session for tests/bench and the shared folder for
checkpoints and intermediate tables.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system every executor can reach). A folder of our own is only set where that
setting is absent, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordo") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # small local inputs: split files across cores instead of 4 MB minimum
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (or an already configured
    SparkContext checkpoint folder). Where neither exists a local session gets a
    temporary folder; on a cluster, whose machines would each write to their own
    disk, it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.removeprefix("file:")  # the context appends a uuid sub-folder
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ordo-checkpoint-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).removeprefix("file:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for one written intermediate. The
    folder is this application's own; the file system deletes it when the driver ends."""
    folder = shared_dir(spark)
    sc = spark.sparkContext
    own = sc._jvm.org.apache.hadoop.fs.Path(folder)
    own.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(own)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex[:12]}")


def derived_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session on the same context with the caller's runtime settings and
    ``settings``: a job can have its own without changing its neighbours'."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own
