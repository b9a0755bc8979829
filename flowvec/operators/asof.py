"""As-of joins: the last sample of a series at or before a time, whatever the length of a series.

Times are cut into buckets of bounded size.  The last sample inside a bucket comes
from a window over series and bucket, the one before it from one row per series
and bucket, so no task gets a whole series.  Rows pass the samples with all they
hold, so that nothing is joined back to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvec.operators.positions import ROWS_PER_BUCKET, order_buckets
from flowvec.session import checkpoint


def _bucketed(df: DataFrame, time: str, rows_per_bucket: int) -> DataFrame:
    found = order_buckets(df, time, rows_per_bucket=rows_per_bucket)
    return found if "_bucket" in found.columns else found.withColumn("_bucket", F.lit(0))


def _carried(bucketed: DataFrame, by: str, value: Column, last: Column) -> DataFrame:
    """Per series and bucket ``last`` over all earlier buckets of ``value``."""
    # One row per series and bucket.
    earlier = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return bucketed.groupBy(by, "_bucket").agg(value.alias("_end")).select(by, "_bucket", last.over(earlier).alias("_carried"))


def as_of(
    left: DataFrame, right: DataFrame, by: str, at: str, ts: str, columns: list[str],
    before: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add to each row of ``left`` the ``columns`` of the last row of ``right`` of its series with ``ts <= at``.

    With ``before`` only rows with ``ts < at`` count.  Of rows of one series and
    time the one with the greatest columns is taken.  Null where there is none,
    or where series or time are null.
    """
    kinds = {c: right.schema[c].dataType for c in columns}
    value = F.struct(*columns)
    marks = right.where(F.col(by).isNotNull() & F.col(ts).isNotNull()).groupBy(by, F.col(ts).alias("_t")).agg(F.max(value).alias("_v"))
    rows = left.select(F.struct(*left.columns).alias("_row"), by, F.col(at).alias("_t"))
    found = _passed(rows, marks.withColumnRenamed("_t", ts), by, ts, rows_per_bucket)
    last = "_before" if before else "_until"
    return found.select("_row.*", *[F.col(f"{last}.{c}").cast(kinds[c]).alias(c) for c in columns])


def running_sums(df: DataFrame, by: str, ts: str, columns: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``by, ts`` and the sums of ``columns`` over all rows of the series up to that time, that time included."""
    totals = df.where(F.col(by).isNotNull() & F.col(ts).isNotNull()).groupBy(by, ts).agg(*[F.sum(c).alias(c) for c in columns])
    bucketed = _bucketed(totals, ts, rows_per_bucket)
    inside = Window.partitionBy(by, "_bucket").orderBy(ts)
    earlier = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = bucketed.groupBy(by, "_bucket").agg(*[F.sum(c).alias(c) for c in columns])
    carried = carried.select(by, "_bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in columns])
    summed = bucketed.withColumns({c: F.sum(c).over(inside) for c in columns}).join(carried, [by, "_bucket"])
    return summed.select(by, ts, *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in columns])


def span_resources(
    spans: DataFrame, samples: DataFrame, by: str, start: str, end: str, ts: str, cpu: str, memory: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``samples, cpu_mean, memory_delta`` of the time from ``start`` to ``end``, both included.

    ``cpu_mean`` is 0 where no sample falls into the time; ``memory_delta`` is the
    last memory at the end less that at the start, 0 where one of them is unknown.
    """
    sums = running_sums(samples.select(by, ts, F.col(cpu).alias("_cpu"), F.lit(1).cast("long").alias("_n")), by, ts, ["_cpu", "_n"], rows_per_bucket)
    held = samples.where(F.col(by).isNotNull() & F.col(ts).isNotNull()).groupBy(by, ts).agg(F.max(F.struct(F.col(memory).alias("_m"))).alias("_held"))
    # A row for each series and time of a sample, written: it is read at the start and at the end of the spans.
    marks = checkpoint(sums.join(held, [by, ts]).select(by, ts, F.struct("_cpu", "_n", "_held._m").alias("_v")))
    found = _passed(spans.select(F.struct(*spans.columns).alias("_row"), by, F.col(start).alias("_t")), marks, by, ts, rows_per_bucket)
    found = found.select("_row", by, F.col(f"_row.{end}").alias("_t"), F.col("_before._cpu").alias("_cpu0"), F.col("_before._n").alias("_n0"), F.col("_until._m").alias("_m0"))
    found = _passed(found.select(F.struct("_row", "_cpu0", "_n0", "_m0").alias("_row"), by, "_t"), marks, by, ts, rows_per_bucket)
    found = found.select("_row._row.*", *[f"_row.{c}" for c in ("_cpu0", "_n0", "_m0")], *[f"_until.{c}" for c in ("_cpu", "_n", "_m")])
    number = F.coalesce("_n", F.lit(0)) - F.coalesce("_n0", F.lit(0))
    spent = F.coalesce("_cpu", F.lit(0.0)) - F.coalesce("_cpu0", F.lit(0.0))
    return found.select(
        *spans.columns,
        number.alias("samples"),
        F.when(number > 0, spent / number).otherwise(0.0).alias("cpu_mean"),
        F.coalesce(F.col("_m") - F.col("_m0"), F.lit(0)).alias("memory_delta"),
    )


def _passed(rows: DataFrame, marks: DataFrame, by: str, ts: str, rows_per_bucket: int) -> DataFrame:
    """``rows`` (``_row``, the series, ``_t``) with the last of ``marks`` before ``_t`` and until it, as ``_before`` and ``_until``.

    A row goes past the marks once, with all it holds, and is joined to nothing.
    ``marks`` have series, time and a value ``_v`` once.
    """
    kind = marks.schema["_v"].dataType
    nothing = F.lit(None).cast(kind)
    usable = F.col(by).isNotNull() & F.col("_t").isNotNull()
    asked = rows.where(usable)
    # A time that very many rows share is looked up once; there are few of these.
    hot = checkpoint(asked.groupBy(by, "_t").count().where(F.col("count") > rows_per_bucket).select(by, "_t"))
    busy = hot.limit(1).count() > 0
    cold = asked.join(F.broadcast(hot), [by, "_t"], "left_anti") if busy else asked
    placed = cold.select(by, "_t", "_row")
    if busy:
        placed = placed.unionByName(hot.select(by, "_t", F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")))
    both = placed.select(by, "_t", "_row", nothing.alias("_v"), F.lit(0).alias("_side")).unionByName(
        marks.select(by, F.col(ts).alias("_t"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), "_v", F.lit(1).alias("_side"))
    )
    bucketed = _bucketed(both, "_t", rows_per_bucket)
    carried = _carried(bucketed, by, F.max_by("_v", F.when(F.col("_side") == 1, F.col("_t"))), F.last("_end", ignorenulls=True))
    inside = Window.partitionBy(by, "_bucket")
    last = F.last("_v", ignorenulls=True)
    found = (
        bucketed.withColumn("_inside", last.over(inside.orderBy("_t", "_side")))
        .withColumn("_with", last.over(inside.orderBy("_t")))
        .where("_side = 0")
        .join(carried, [by, "_bucket"])
        .select("_row", by, "_t", F.coalesce("_inside", "_carried").alias("_before"), F.coalesce("_with", "_carried").alias("_until"))
    )
    if busy:
        met = F.broadcast(found.where("_row is null").drop("_row"))
        found = found.where("_row is not null").unionByName(asked.join(met, [by, "_t"]).select(*found.columns))
    return found.unionByName(rows.where(~usable).select("_row", by, "_t", nothing.alias("_before"), nothing.alias("_until")))


def cpu_share(spans: DataFrame, seconds: str) -> DataFrame:
    """``operations, seconds, cpu_share`` of a run: the mean load of its operations, weighted by their time."""
    total = F.sum(seconds)
    load = F.sum(F.col("cpu_mean") * F.col(seconds))
    return spans.agg(F.count(F.lit(1)).alias("operations"), total.alias("seconds"), F.when(total > 0, load / total).otherwise(0.0).alias("cpu_share"))
