"""Reading the given tables and cutting lineage with written tables."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

import ordo
from ordo.session import scratch_path

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start
    from files that survive a lost executor. Shuffle files of the job go when it
    ends instead of when the driver next collects garbage; a query that runs in
    the same session meanwhile would at worst lose its own a little earlier."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables written by ``materialize`` that nothing will read again."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def ship(df: DataFrame) -> DataFrame:
    """Send this package to the executors, once per application, so that Python
    workers need no installed copy; returns ``df``. Spark copies the archive."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(ordo.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="ordo-code-"), "ordo_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "ordo")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)
    return df
