"""Summaries of measurement tables: operations, workers, resource samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.session import lookup_join


def rate(n: Column, seconds: Column) -> Column:
    """``n / seconds``, or 0 where no time was measured."""
    return F.when(seconds > 0, n / seconds).otherwise(F.lit(0.0))


def per_operation(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def throughput(df: DataFrame, by: str, seconds: str) -> DataFrame:
    """Operations, time, operations per second and seconds per operation."""
    total, n = F.col("total_seconds"), F.col("operations")
    sums = df.groupBy(by).agg(F.count(F.lit(1)).alias("operations"), F.sum(seconds).alias("total_seconds"))
    return sums.withColumns(
        {"ops_per_second": rate(n, total), "seconds_per_op": per_operation(total, n)}
    )


def merge_workers(df: DataFrame, by: str, start: str, end: str, sums: list[str]) -> DataFrame:
    """Wall time from the first start to the last end, and sums over the workers."""
    return df.groupBy(by).agg(
        (F.max(end) - F.min(start)).alias("wall_seconds"), *[F.sum(c).alias(c) for c in sums]
    )


def resource_summary(df: DataFrame, by: str, ts: str, value: str) -> DataFrame:
    """First, last, change, peak, mean and least of a sample series."""
    summary = df.groupBy(by).agg(
        F.min_by(value, ts).alias("initial"),
        F.max_by(value, ts).alias("final"),
        F.max(value).alias("peak"),
        F.avg(value).alias("average"),
        F.min(value).alias("minimum"),
    )
    return summary.withColumn("delta", F.col("final") - F.col("initial"))


def time_offset(df: DataFrame, by: str, ts: str, name: str = "offset") -> DataFrame:
    """Time since the first sample of each series."""
    starts = df.groupBy(by).agg(F.min(ts).alias("_start"))
    return lookup_join(df, starts, [by]).withColumn(name, F.col(ts) - F.col("_start")).drop("_start")


def pivot_times(df: DataFrame, rows: str, columns: str, names: list[str], value: str) -> DataFrame:
    """One row per operation, one column per model."""
    return df.groupBy(rows).pivot(columns, names).agg(F.avg(value))


def average_by(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(name))


def query_summary(df: DataFrame, by: str, duration: str, peak: str, delta: str) -> DataFrame:
    """Mean duration, its inverse as throughput, top peak and mean change of valid rows."""
    valid = F.col(duration) > 0
    summary = df.groupBy(by).agg(
        F.avg(F.when(valid, F.col(duration))).alias("avg_duration"),
        F.max(peak).alias("max_peak"),
        F.avg(F.when(valid, F.col(delta))).alias("avg_delta"),
    )
    return summary.withColumn(
        "throughput", F.coalesce(F.try_divide(F.lit(1.0), F.col("avg_duration")), F.lit(0.0))
    )


def operation_series(df: DataFrame, operation: str, value: Column, ts: str) -> DataFrame:
    """Rows of one operation in time order."""
    return df.where(F.col(operation) == value).orderBy(ts)


def total_latency(df: DataFrame, by: list[str], planning: str, execution: str) -> DataFrame:
    """Planning plus execution time per index and operation."""
    return df.groupBy(*by).agg(
        F.sum(F.col(planning)).alias("planning"),
        F.sum(F.col(execution)).alias("execution"),
        F.sum(F.col(planning) + F.col(execution)).alias("total"),
    )
