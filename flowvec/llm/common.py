"""What the corpus operators share: text, row keys, written tables, Arrow batches.

``[\\x20\\x09-\\x0D]`` are the blanks of every operator here.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvec.session import new_work_path

BLANKS = r"[\x20\x09-\x0D]+"
# Characters of text that a task holds at once; longer inputs go in several pieces.
CHUNK_CHARS = 12_000_000
# Rows of an Arrow batch: whole texts are wide.
BATCH_ROWS = 1000


def wide_rows(spark: SparkSession) -> None:
    """Send whole texts to Python in small batches; the results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@contextmanager
def no_collector() -> Iterator[None]:
    """Many small objects without cycles: the collector would only walk over them again and again."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back, which cuts the lineage."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, *more: Column | str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, text`` and ``more``, one row per row of ``docs``.

    ``key`` is unique and rises with ``doc_id``.  Where ids are unique and not
    null it is the id itself.  Otherwise rows are numbered in the order of id
    (null last) and text in a written table, so that rows with a repeated or
    missing id stay rows of their own.
    """
    doc_id = F.col(id_col).cast("long").alias("doc_id")
    rows = docs.select(doc_id, text_of(text_col).alias("text"), *more)
    ids = docs.select(doc_id)
    odd = ids.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return rows.select(F.col("doc_id").alias("key"), "*")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return write_table(ranged.select(F.monotonically_increasing_id().alias("key"), "*"), "keyed")


def give_back() -> None:
    """Free memory goes back to the system: Spark keeps Python processes, and what they hold counts beside the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def per_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """An ``applyInArrow`` function that gives back what it used for a group."""

    @wraps(work)
    def run(table: pa.Table) -> pa.Table:
        try:
            return work(table)
        finally:
            give_back()

    return run


def in_chunks(
    work: Callable[[pa.Table], Iterator[pa.RecordBatch] | pa.Table], text: str = "text", chars: int = CHUNK_CHARS
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that hands ``work`` the rows of a task in pieces.

    A piece ends once it holds ``chars`` bytes of text, so memory follows the
    piece (and the longest single row), not the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            start = 0
            lengths = pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                size += int(lengths[i])
                if size >= chars:
                    held.append(batch.slice(start, i + 1 - start))
                    yield from work(pa.Table.from_batches(held)).to_batches()
                    held, size, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()
            held = []
        # The next task in this process starts with what it needs itself.
        give_back()

    return run
