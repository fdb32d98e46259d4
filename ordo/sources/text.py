"""Text line sources and sinks.

* ``read_lines``: splittable parallel scan of text files, one row per line.
  Line ends LF, CR and CRLF are all recognised (no ``lineSep`` is set on
  read on purpose); a leading UTF-8 BOM is dropped by the source.
* ``read_runs``: the same scan over run files, keeping which run (file) each
  line came from.
* ``write_lines``: one part file per partition, committed atomically by the
  output commit protocol (a failed task leaves no partial file).
* ``read_in_file_order``: read sorted output back with an explicit order
  column, because a scan does not return files in name order. The order is
  (part number, file name, split start, row within split), all taken on the
  scan itself, so it holds however files are split and packed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: Spark names output files ``part-NNNNN-...``; the number is the
# partition index (5 digits, more when there are 100,000 or more).
PART_NUMBER = r"part-(\d+)"


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def input_bytes(spark: SparkSession, paths: str | Iterable[str]) -> int:
    """Total bytes under the input paths (globs allowed), from file-system
    metadata only: no data is read. Used to size the sort's partitions."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in _paths(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for st in fs.globStatus(path) or []:
            total += fs.getContentSummary(st.getPath()).getLength()
    return int(total)


def read_lines(spark: SparkSession, paths: str | Iterable[str], replace_invalid: bool = False) -> DataFrame:
    """``value string``, one row per line of every file.

    ``replace_invalid`` turns bytes that are not UTF-8 into U+FFFD; otherwise
    such bytes pass through unchanged."""
    return spark.read.text(_paths(paths)).select(_valid("value", replace_invalid))


def _valid(value: str, replace_invalid: bool):
    return F.make_valid_utf8(value).alias(value) if replace_invalid else F.col(value)


def read_runs(spark: SparkSession, paths: str | Iterable[str], replace_invalid: bool = False) -> DataFrame:
    """``run string, value string``; ``run`` is the full path of the run
    file, so runs of the same name in several folders stay apart."""
    return spark.read.text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("run"), _valid("value", replace_invalid)
    )


MANIFEST = "_manifest"   # beside the runs; readers pass over names with a leading underscore
MANIFEST_SCHEMA = "run_id string, n bigint, est_bytes bigint"


def write_runs(runs: DataFrame, path: str) -> None:
    """S3: ``run, line`` (runs one after the other in each partition) as one file
    per run, ``run=K/part-N...``."""
    runs.select("run", F.col("line").alias("value")).write.mode("overwrite").partitionBy("run").text(path)


def write_manifest(spark: SparkSession, path: str, entries: list[tuple[int, int, int, int]]) -> DataFrame:
    """Keep ``(split, run, rows, estimate)`` of every run beside the runs; what is
    kept, as ``read_manifest`` gives it."""
    rows = [(f"run={run}/part-{split:05d}", n, b) for split, run, n, b in entries]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, n, est_bytes`` of every run, as its writing task recorded them."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}")


def run_files(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``run, run_id, bytes`` of every run file with content, by Spark's own
    listing (no content is read, and files without a byte are not in it)."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_paths(paths))
    run_id = F.regexp_extract("_metadata.file_path", r"(run=\d+/part-\d+)[^/]*$", 1)
    return listing.select(F.col("_metadata.file_path").alias("run"), run_id.alias("run_id"), F.col("length").alias("bytes"))


def write_lines(df: DataFrame, path: str, column: str = "line", mode: str = "overwrite",
                line_sep: str | None = None, compression: str | None = None) -> None:
    """Write one column as text, one part file per partition."""
    w = df.select(F.col(column).alias("value")).write.mode(mode)
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    if compression is not None:
        w = w.option("compression", compression)
    w.text(path)


def file_index(file_name: str = "file_name"):
    """Part number of a Spark output file name (null for other names). Meant
    for small per-file or per-split tables, not for every row."""
    return F.regexp_extract(file_name, PART_NUMBER, 1).try_cast("bigint")


def file_order(file_name: str = "file_name") -> list:
    """Sort expressions putting files in output order: part number, then name."""
    return [F.coalesce(file_index(file_name), F.lit(-1)), F.col(file_name)]


def path_order(file_path: str = "file_path") -> list:
    """The same for full paths; files of one name in several folders follow by path."""
    name = F.element_at(F.split(F.col(file_path), "/"), -1)
    index = F.regexp_extract(name, PART_NUMBER, 1).try_cast("bigint")
    return [F.coalesce(index, F.lit(-1)), name, F.col(file_path)]


def with_scan_order(df: DataFrame) -> DataFrame:
    """Add the columns that give a text scan its file order: ``file_path``,
    ``block_start`` (split offset) and ``row_in_split``.

    ``row_in_split`` is ``monotonically_increasing_id()`` taken directly on the
    scan: increasing within a split, and the same on every re-execution
    because a scan plans the same splits for the same files. Files are put in
    order by ``path_order`` on the (small) per-split table."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_in_split"),
    )


def read_in_file_order(spark: SparkSession, paths: str | Iterable[str], replace_invalid: bool = False) -> DataFrame:
    """``value`` plus the order columns ``file_path, block_start, row_in_split``."""
    scan = with_scan_order(spark.read.text(_paths(paths)))
    return scan.withColumn("value", F.make_valid_utf8("value")) if replace_invalid else scan


def head_of_output(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first ``n`` lines of a written result, in file order: ``value``.

    One ``TakeOrdered`` over (file, split, row); nothing is sorted as a whole."""
    return read_in_file_order(spark, path).orderBy(
        *path_order(), "block_start", "row_in_split").limit(n).select("value")
