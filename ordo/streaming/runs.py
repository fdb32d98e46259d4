"""Phase 1 as a Structured Streaming job: text files arriving in a folder are
parsed and written as sorted runs, micro-batch by micro-batch; malformed
lines go to a rejects folder with their reason. ``plans.sort_file.merge_files``
over the runs folder then gives the total order.

Parsing is narrow, so it runs on the streaming DataFrame itself; sorting a
micro-batch is a batch operation, so it happens in ``foreachBatch``. Each
batch writes to its own ``batch=N`` folder with overwrite, so a batch replayed
after a failure replaces its own output: the run folder stays exactly-once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordo.operators.parse import parse_with_reason
from ordo.operators.sort import sort_within
from ordo.session import scratch_path


def _write_batch(runs_dir: str, rejects_dir: str | None, order: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # Two sinks read the batch: keep it for the second one instead of
        # reading and parsing the files again. persist keeps the lineage, so
        # a lost block is recomputed from the (unchanged) input files.
        if rejects_dir is not None:
            batch = batch.persist()
        try:
            valid = batch.where(F.col("reason").isNull()).select("line")
            sort_within(valid, order).write.mode("overwrite").text(os.path.join(runs_dir, f"batch={batch_id}"))
            if rejects_dir is not None:
                (batch.where(F.col("reason").isNotNull()).select("line", "reason")
                 .write.mode("overwrite").parquet(os.path.join(rejects_dir, f"batch={batch_id}")))
        finally:
            if rejects_dir is not None:
                batch.unpersist()
    return write


def stream_sorted_runs(spark: SparkSession, input_dir: str, runs_dir: str,
                       rejects_dir: str | None = None, checkpoint: str | None = None,
                       order: str = "ordinal", max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    parsed = parse_with_reason(reader.load(input_dir), "value")
    writer = parsed.writeStream.foreachBatch(_write_batch(runs_dir, rejects_dir, order)).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-runs")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
