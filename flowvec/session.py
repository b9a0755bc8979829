"""Session helpers: shared work folders, checkpoints and size-checked joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Row bound below which a side of a join may be broadcast.  Callers with wide
# rows pass a lower one.
BROADCAST_ROWS = 200_000
# Number of most frequent join keys that are salted, and copies per such key.
HOT_KEYS = 256
HOT_COPIES = 32


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it uses a folder in its
    warehouse, ``spark.sql.warehouse.dir``.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/flowvec/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """The most frequent values of ``on``, at most ``HOT_KEYS`` rows."""
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), *on)
        .limit(HOT_KEYS)
        .select(*on)
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join a large left side, whatever the frequency of its keys.

    A small ``right`` is broadcast after its size is checked.  Otherwise the
    most frequent keys of ``left`` are spread over ``HOT_COPIES`` salts and the
    matching ``right`` rows copied to each, so no task gets a whole hot key.
    Rows with a null key pass a left join by.
    """
    if fits(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    if how == "left":
        # A null key matches nothing; left in the join all its rows would meet in one task.
        absent = F.lit(False)
        for name in on:
            absent = absent | F.col(name).isNull()
        added = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c not in on]
        rest = [c for c in left.columns if c not in on]
        matched = _salted_join(left.where(~absent), right, on, how)
        return matched.unionByName(left.where(absent).select(*on, *rest, *added))
    return _salted_join(left, right, on, how)


def _salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    hot = F.broadcast(hot_keys(left, on).withColumn("_hot", F.lit(True)))
    # The salt hashes the row itself, so a task that runs again places it alike.
    row_salt = F.pmod(F.xxhash64(*left.columns), F.lit(HOT_COPIES)).cast("int")
    spread = F.when(F.col("_hot"), row_salt).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_COPIES - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_left = left.join(hot, on, "left").withColumn("_salt", spread).drop("_hot")
    salted_right = (
        right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def one_row(df: DataFrame, *aggregates: Column):
    """Evaluate global aggregates; the result is a single row of scalars."""
    return df.agg(*aggregates).first()


def run_together(action: Callable, inputs: Iterable, at_once: int = 4) -> list:
    """Run independent Spark actions side by side so that short jobs overlap."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(action, inputs))
