"""Progress of streaming queries, one small file per micro-batch, and queries that end themselves."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from flowvec.sources import files

SCHEMA = "query string, batch_id long, rows long, rows_per_second double, finished string"


class BatchLog(StreamingQueryListener):
    """Appends the progress of every micro-batch to a folder; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.last: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # What a query says it stored; otherwise what it read, which leaves out rows the files ruled out.
        rows = p.observedMetrics["stored"]["n"] if "stored" in p.observedMetrics else p.numInputRows
        line = {"query": str(p.id), "batch_id": p.batchId, "rows": rows, "rows_per_second": p.processedRowsPerSecond, "finished": p.timestamp}
        try:
            files.write_text(self.spark, f"{self.path}/{p.runId}-{p.batchId:010d}.json", json.dumps(line))
        except FileExistsError:
            # A trigger without new data reports its last batch once more.
            pass
        self.last[str(p.id)] = p.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def settle(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Wait until the last batch of an ended query is in the folder: listeners run behind."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last is not None and self.last.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError("the last batch was not reported")
            time.sleep(0.05)


def read_progress(spark: SparkSession, path: str, expected_rows: int | None = None) -> DataFrame:
    """One row per batch with the rows so far, and their percentage where the total is known.

    A batch that ran again counts once, as it ran last.
    """
    lines = spark.read.schema(SCHEMA).json(path)
    last = F.max_by(F.struct("rows", "rows_per_second"), "finished")
    batches = lines.groupBy("query", "batch_id").agg(last.alias("_b")).select("query", "batch_id", "_b.*")
    # As many rows as the query ran batches.
    so_far = F.sum("rows").over(Window.partitionBy("query").orderBy("batch_id"))
    percent = F.lit(None).cast("double") if expected_rows is None else F.round(100 * F.col("rows_so_far") / expected_rows, 2)
    return batches.withColumn("rows_so_far", so_far).withColumn("percent", percent)


class StopWhenFull(StreamingQueryListener):
    """Stops a query once its observed rows reach a bound, or a batch stores less than it was offered."""

    def __init__(self, spark: SparkSession, rows: int):
        self.spark, self.rows, self.stored = spark, rows, 0
        self.query: StreamingQuery | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query is None or event.progress.id != self.query.id:
            return
        seen = event.progress.observedMetrics
        stored = int(seen["stored"]["n"]) if "stored" in seen else 0
        offered = int(seen["offered"]["n"]) if "offered" in seen else 0
        self.stored += stored
        if self.stored >= self.rows or stored < offered:
            # Stopping waits for the batch, so it must not hold up the thread that reports it.
            threading.Thread(target=self.query.stop, daemon=True).start()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.query is not None and event.id == self.query.id:
            threading.Thread(target=self.spark.streams.removeListener, args=(self,), daemon=True).start()
