"""Exact row positions without a window over the whole table.

Rows are put in ordered buckets of bounded size; a row's position is its
number inside the bucket plus the rows of all earlier buckets.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvec.session import checkpoint

ROWS_PER_BUCKET = 500_000
# Also a small table is cut into buckets, so that no window ever takes all rows of one.
MIN_BUCKETS, MAX_BUCKETS = 8, 50_000


def _bucket_count(rows: int, rows_per_bucket: int) -> int:
    return max(MIN_BUCKETS, min(MAX_BUCKETS, math.ceil(rows / rows_per_bucket)))


def order_buckets(
    df: DataFrame, key: str, name: str = "_bucket", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add a bucket number that rises with the numeric ``key``.

    Limits come from approximate quantiles: they steer bucket sizes only, the
    order of the buckets is exact.  Rows of one key only get no number.
    """
    number = F.col(key).cast("double")
    # One job counts the rows and cuts a small table; only a larger one is cut finer.
    few = [i / MIN_BUCKETS for i in range(1, MIN_BUCKETS)]
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.percentile_approx(number, few, 100).alias("cuts")).first()
    buckets, cuts = _bucket_count(seen["rows"], rows_per_bucket), seen["cuts"] or []
    if buckets > MIN_BUCKETS:
        error = max(0.25 / buckets, 2e-5)
        numeric = df.select(number.alias(key))
        cuts = numeric.approxQuantile(key, [i / buckets for i in range(1, buckets)], error)
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) < 3:
        return df
    keyed = df.withColumn("_key", F.col(key).cast("double"))
    bucketizer = Bucketizer(splits=splits, inputCol="_key", outputCol=name, handleInvalid="keep")
    return bucketizer.transform(keyed).withColumn(name, F.col(name).cast("int")).drop("_key")


def hash_buckets(
    df: DataFrame, digest: str, name: str = "_bucket", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Like :func:`order_buckets` for a column of hexadecimal digests."""
    buckets = _bucket_count(df.count(), rows_per_bucket)
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.withColumn(name, F.floor(head * buckets / F.lit(float(1 << 32))).cast("int"))


def number_rows(
    bucketed: DataFrame,
    order: list[Column | str],
    name: str = "pos",
    within: tuple[str, ...] = (),
    bucket: str = "_bucket",
) -> DataFrame:
    """Positions from 1, per ``within`` group, over already bucketed rows."""
    if bucket not in bucketed.columns:
        # One key has no order to cut; it is unique, so this is one row.
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        return bucketed.withColumn(name, place.cast("long"))
    groups = [*within, bucket]
    # One row per bucket (at most MAX_BUCKETS for a whole table) is small.
    earlier = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return (
        bucketed.join(offsets, groups)
        .withColumn(name, (F.col("_offset") + inside).cast("long"))
        .drop("_offset", bucket)
    )


def with_position(
    df: DataFrame, key: str, name: str = "pos", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Number the rows 1..n by a unique numeric ``key``."""
    bucketed = order_buckets(df, key, rows_per_bucket=rows_per_bucket)
    return number_rows(bucketed, [F.col(key)], name)


def with_hash_position(
    df: DataFrame,
    key: str,
    name: str = "pos",
    seed: str = "",
    within: tuple[str, ...] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Number the rows in a shuffled order that depends on ``key`` and ``seed`` only."""
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    bucketed = hash_buckets(
        df.withColumn("_digest", digest), "_digest", rows_per_bucket=rows_per_bucket
    )
    return number_rows(bucketed, [F.col("_digest"), F.col(key)], name, within).drop("_digest")


def number_values(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct non-null values of any sortable type with their rank from 0.

    The sorted values are checkpointed so that partition numbers stay fixed
    while the rows before each partition are counted.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    numbered = checkpoint(values.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    numbered = numbered.withColumn("_part", part).withColumn(
        "_index", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select("_part", "_offset")
    )
    # One row per sort partition.
    return numbered.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_offset") + F.col("_index")).cast("long").alias(name)
    )


def in_batches(df: DataFrame, key: str, size: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``key`` order, numbered from 0."""
    placed = with_position(df, key, "_pos")
    return placed.withColumn(name, F.floor((F.col("_pos") - 1) / size).cast("long")).drop("_pos")


def in_parts(df: DataFrame, key: str, parts: int, name: str = "part") -> DataFrame:
    """Near-equal consecutive parts from 1; the first ``n mod parts`` get one row more."""
    rows = df.count()
    base, extra = divmod(rows, parts)
    longer = extra * (base + 1)
    placed = with_position(df, key, "_pos")
    first = F.floor((F.col("_pos") - 1) / (base + 1)) + 1
    rest = F.floor((F.col("_pos") - 1 - longer) / max(base, 1)) + 1 + extra
    part = F.when(F.col("_pos") <= longer, first).otherwise(rest)
    return placed.withColumn(name, part.cast("int")).drop("_pos")


def shuffle_in_parts(
    df: DataFrame,
    key: str,
    value: str,
    part: str,
    name: str = "shuffled",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Give each row the ``value`` of another row of its part, by a fixed permutation."""
    bucketed = order_buckets(df, key, rows_per_bucket=rows_per_bucket)
    places = number_rows(bucketed, [F.col(key)], "_slot", (part,))
    donors = with_hash_position(
        df.select(key, value, part), key, "_slot", within=(part,), rows_per_bucket=rows_per_bucket
    )
    donors = donors.select(part, "_slot", F.col(value).alias(name))
    return places.join(donors, [part, "_slot"]).drop("_slot")
