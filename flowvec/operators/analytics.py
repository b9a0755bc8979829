"""Traffic questions: counts, top talkers, port recurrence, hit statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowvec.operators.positions import number_values, with_position
from flowvec.session import checkpoint, lookup_join, one_row

# Positions per bucket of the recurrence and gap operators.
SPAN = 1_000_000
# Frequency limits of the port strata.
LOW_BELOW, HIGH_FROM = 10, 50


def top_values(df: DataFrame, column: str, k: int, count: str = "n") -> DataFrame:
    """Most frequent values; the value itself breaks ties."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), column).limit(k)


def value_sets(df: DataFrame, by: list[str], column: str, k: int, name: str) -> DataFrame:
    """Sorted distinct values per group, for the first ``k`` groups in key order."""
    firsts = df.select(*by).distinct().orderBy(*by).limit(k)
    pairs = df.join(F.broadcast(firsts), by, "left_semi").select(*by, column).distinct()
    return pairs.groupBy(*by).agg(F.array_sort(F.collect_set(column)).alias(name))


def text_protocol_share(df: DataFrame, text_col: str, k: int) -> DataFrame:
    """Third word of all texts, counted; shorter texts are left out."""
    third = F.get(F.split(text_col, r"\s+"), F.lit(2))
    return top_values(df.select(third.alias("protocol")).where("protocol is not null"), "protocol", k)


def label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Code table of a category: its sorted distinct values numbered from 0."""
    return number_values(df, column, name)


def encode_labels(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    return lookup_join(df, label_codes(df, column, name), [column])


def standardize(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Subtract the mean and divide by the population deviation; constants give 0."""
    stats = one_row(
        df,
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )
    scaled = {}
    for c in columns:
        mean, deviation = stats[f"m_{c}"], stats[f"s_{c}"]
        centered = F.col(c) - F.lit(mean)
        scaled[c + suffix] = centered / F.lit(deviation) if deviation else centered * 0.0
    return df.withColumns(scaled)


def keep_first(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """Drop rows with a null in ``by`` and keep the lowest key of each combination."""
    rest = [c for c in df.columns if c not in by]
    kept = df.dropna(subset=by).groupBy(*by).agg(F.min_by(F.struct(*rest), key).alias("_row"))
    return kept.select(*by, "_row.*").select(*df.columns)


def distinct_values(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct union of several columns."""
    stacked = df.select(F.explode(F.array(*columns)).alias(name))
    return stacked.where(F.col(name).isNotNull()).distinct()


def _placed(df: DataFrame, port: str, order: str) -> DataFrame:
    """Port values with their row position from 0 and the bucket of the position."""
    placed = with_position(df.select(order, port), order, "_p").withColumn("p", F.col("_p") - 1)
    bucket = F.floor(F.col("p") / SPAN).alias("b")
    return placed.where(F.col(port).isNotNull()).select(F.col(port).alias("port"), "p", bucket)


def port_recurrence(df: DataFrame, port: str, order: str) -> DataFrame:
    """Gaps between consecutive rows of each port that occurs more than once, the most frequent first.

    Gaps are taken inside position buckets and then between the buckets of a
    port, so even a port that holds most rows is never gathered in one task.
    """
    placed = _placed(df, port, order)
    gap = F.col("p") - F.lag("p").over(Window.partitionBy("port", "b").orderBy("p"))
    exact = "decimal(38,0)"
    buckets = (
        placed.withColumn("gap", gap)
        .groupBy("port", "b")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("p").alias("first"),
            F.max("p").alias("last"),
            F.min("gap").alias("low"),
            F.max("gap").alias("high"),
            F.sum(F.col("gap").cast(exact) * F.col("gap")).alias("squares"),
        )
    )
    joint = F.col("first") - F.lag("last").over(Window.partitionBy("port").orderBy("b"))
    nothing = F.lit(0).cast(exact)
    ports = (
        buckets.withColumn("joint", joint)
        .groupBy("port")
        .agg(
            F.sum("n").alias("frequency"),
            F.least(F.min("low"), F.min("joint")).alias("min_distance"),
            F.greatest(F.max("high"), F.max("joint")).alias("max_distance"),
            F.min("first").alias("first_position"),
            F.max("last").alias("last_position"),
            F.sum(
                F.coalesce("squares", nothing).cast(exact)
                + F.coalesce(F.col("joint").cast(exact) * F.col("joint"), nothing).cast(exact)
            ).cast(exact).alias("squares"),
        )
        .where(F.col("frequency") > 1)
    )
    gaps = F.col("frequency") - 1
    total = F.col("last_position") - F.col("first_position")
    spread = gaps * F.col("squares") - total.cast(exact) * total
    return ports.orderBy(F.desc("frequency"), "port").select(
        "port",
        "frequency",
        (total / gaps).alias("avg_distance"),
        "min_distance",
        "max_distance",
        (F.sqrt(spread.cast("double")) / gaps).alias("std_distance"),
        "first_position",
        "last_position",
    )


def frequency_strata(recurrence: DataFrame) -> DataFrame:
    """One probe port for each frequency stratum: the most frequent of it."""
    stratum = (
        F.when(F.col("frequency") < LOW_BELOW, "low")
        .when(F.col("frequency") < HIGH_FROM, "mid")
        .otherwise("high")
    )
    first = F.min_by(F.struct("port", "frequency"), F.struct(-F.col("frequency"), F.col("port")))
    return recurrence.groupBy(stratum.alias("stratum")).agg(first.alias("f")).select("stratum", "f.*")


def hit_port_stats(hits: DataFrame, recurrence: DataFrame) -> DataFrame:
    """Recurrence of each hit's port; ``found`` is false for a port without one."""
    stats = recurrence.select("port", "frequency", "avg_distance", F.lit(True).alias("found"))
    joined = lookup_join(hits, stats, ["port"])
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def consecutive_hit_gaps(hits: DataFrame, df: DataFrame, port: str, order: str) -> DataFrame:
    """Least row distance between any rows of each hit's port and the previous hit's.

    ``hits`` has ``rank, port`` of one result list.  The rows of both ports are
    swept in position order: only neighbours of different sides can be
    nearest.  Buckets hand their outermost positions to the next ones.
    """
    # The hit before is the one whose place is one less, so no window takes the whole list.
    numbered = checkpoint(with_position(hits.select("rank", "port"), "rank", "_n"))
    before = numbered.select((F.col("_n") + 1).alias("_n"), F.col("port").alias("prev_port"))
    pairs = lookup_join(numbered, before, ["_n"], "inner").select("rank", "port", "prev_port").where("prev_port is not null")
    sides = pairs.select(
        "rank",
        F.explode(
            F.array(
                F.struct(F.col("port").alias("port"), F.lit("c").alias("side")),
                F.struct(F.col("prev_port").alias("port"), F.lit("p").alias("side")),
            )
        ).alias("s"),
    ).select("rank", "s.*")
    rows = lookup_join(_placed(df, port, order), sides, ["port"], "inner").select("rank", "side", "p", "b")
    mine = Window.partitionBy("rank", "b").orderBy("p", "side")
    before = mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c_pos, p_pos = F.when(F.col("side") == "c", F.col("p")), F.when(F.col("side") == "p", F.col("p"))
    other = F.when(F.col("side") == "c", F.max(p_pos).over(before)).otherwise(
        F.max(c_pos).over(before)
    )
    buckets = (
        rows.withColumn("gap", F.col("p") - other)
        .groupBy("rank", "b")
        .agg(
            F.min("gap").alias("gap"),
            F.min(c_pos).alias("c_first"),
            F.max(c_pos).alias("c_last"),
            F.min(p_pos).alias("p_first"),
            F.max(p_pos).alias("p_last"),
        )
    )
    earlier = Window.partitionBy("rank").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    across = F.least(
        F.col("c_first") - F.max("p_last").over(earlier),
        F.col("p_first") - F.max("c_last").over(earlier),
    )
    least = (
        buckets.withColumn("gap", F.least("gap", across))
        .groupBy("rank")
        .agg(F.min("gap").alias("min_row_gap"))
    )
    return pairs.join(least, "rank")


def distance_by_rank(hits: DataFrame, k: int) -> DataFrame:
    """Mean score per rank over the queries that have all ``k`` hits."""
    # A query has at most k hits, so its window is small and the search runs once.
    found = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    return hits.withColumn("_n", found).where(F.col("_n") == k).groupBy("rank").agg(F.avg("score").alias("avg_distance"))


def weighted_parts(parts: DataFrame, value: str, weight: str, by: list[str]) -> DataFrame:
    """Combine per-part means into the overall mean."""
    mean = F.sum(F.col(value) * F.col(weight)) / F.sum(weight)
    return parts.groupBy(*by).agg(mean.alias(value))


def score_summary(hits: DataFrame) -> DataFrame:
    return hits.agg(
        F.avg("score").alias("avg_distance"),
        F.min("score").alias("min_distance"),
        F.max("score").alias("max_distance"),
    )


def query_similarity(hits: DataFrame) -> DataFrame:
    """Mean of 1 - distance and hit count per query."""
    return hits.groupBy("query_id").agg(
        F.avg(1 - F.col("score")).alias("similarity"), F.count(F.lit(1)).alias("hits")
    )
