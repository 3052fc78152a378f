"""A table of the progress of streaming queries: rows, rates and durations of every batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query STRING, run STRING, batch_id BIGINT, started STRING, rows BIGINT, "
    "rows_in_per_second DOUBLE, rows_done_per_second DOUBLE, batch_millis BIGINT, write_millis BIGINT"
)


class ProgressTable(StreamingQueryListener):
    """Writes a small file per finished batch into a folder, which :meth:`read` gives as a table.

    Progress is told by Spark after a batch and does not take part in it: a batch that failed
    after its rows were counted is told again under the same number, with the same rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}

    def _ended(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._ended(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        row = {
            "query": p.name, "run": str(p.runId), "batch_id": p.batchId, "started": p.timestamp, "rows": p.numInputRows,
            "rows_in_per_second": p.inputRowsPerSecond, "rows_done_per_second": p.processedRowsPerSecond,
            "batch_millis": p.durationMs.get("triggerExecution"), "write_millis": p.durationMs.get("addBatch"),
        }
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId}.json")
        store = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = store.create(hadoop, True)
        stream.write(bytearray(json.dumps(row).encode()))
        stream.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60.0) -> bool:
        """Wait until all progress of an ended run is written; events come after the query's end."""
        return self._ended(run).wait(seconds)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(self.path)
