"""Continuous capture ingest over landed files, with embedding and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowvec import schemas
from flowvec.operators.embedding import hashed_text
from flowvec.sources.flows import normalize_capture
from flowvec.streaming.keyed import KeyedTable
from flowvec.streaming.progress import StopWhenFull


def read_capture_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Capture records of the parquet files that land in a folder."""
    return (
        spark.readStream.schema(schemas.CAPTURE)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def _trigger(every: str | None) -> dict:
    """All that has landed, or a batch ``every`` so often until the query is stopped."""
    return {"processingTime": every} if every else {"availableNow": True}


def ingest(stream: DataFrame, target: str, state: str, every: str | None = None) -> StreamingQuery:
    """Normalise capture records and append them; exactly once through the file sink."""
    return (
        normalize_capture(stream)
        .observe("stored", F.count(F.lit(1)).alias("n"))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def ingest_bounded(
    stream: DataFrame, target: str, state: str, packets: int, every: str | None = None
) -> StreamingQuery:
    """As :func:`ingest`, but the query stores ``packets`` records and then ends itself.

    The running count is the state of a streaming limit: no batch counts what
    earlier ones have stored, and a restarted query goes on from there.
    """
    spark = stream.sparkSession
    offered = normalize_capture(stream).observe("offered", F.count(F.lit(1)).alias("n"))
    kept = offered.limit(packets).observe("stored", F.count(F.lit(1)).alias("n"))
    full = StopWhenFull(spark, packets)
    spark.streams.addListener(full)
    full.query = (
        kept.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )
    return full.query


def embed_upsert(
    stream: DataFrame,
    table: KeyedTable,
    state: str,
    text: str,
    dim: int,
    every: str | None = None,
) -> StreamingQuery:
    """Normalise and embed capture records and upsert them; the last batch wins per key.

    A batch costs its own rows, and every so often the ranges of keys it shares
    with the batches before it; the current rows are those of ``table.read()``.
    """
    embedded = hashed_text(normalize_capture(stream), text, dim)
    return (
        embedded.writeStream.foreachBatch(table.append)
        .option("checkpointLocation", state)
        .trigger(**_trigger(every))
        .start()
    )


def progress(query: StreamingQuery) -> DataFrame:
    """Rows and rows per second of the last micro-batches Spark remembers; :class:`~flowvec.streaming.progress.BatchLog` keeps all."""
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    rows = [
        (p["batchId"], p["numInputRows"], float(p["processedRowsPerSecond"] or 0.0))
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id long, rows long, rows_per_second double")
