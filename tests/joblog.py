"""What the jobs inside a ``with`` block read, from Spark's event log."""

import glob
import json
import os
from contextlib import contextmanager


class JobLog:
    def __init__(self, spark):
        self._bus = spark.sparkContext._jsc.sc().listenerBus()
        self._folder = spark.sparkContext.getConf().get("spark.eventLog.dir").removeprefix("file:")
        self.records = 0
        self._before = self._total()

    def _total(self):
        """Input records of all stages so far."""
        self._bus.waitUntilEmpty()
        total = 0
        for path in glob.glob(os.path.join(self._folder, "**"), recursive=True):
            if os.path.isfile(path):
                for line in open(path, errors="replace"):
                    if '"SparkListenerStageCompleted"' in line:
                        info = json.loads(line)["Stage Info"]
                        total += sum(int(a["Value"]) for a in info["Accumulables"] if a["Name"] == "internal.metrics.input.recordsRead")
        return total

    def close(self):
        self.records = self._total() - self._before


@contextmanager
def job_log(spark):
    log = JobLog(spark)
    yield log
    log.close()
