"""Exact nearest-neighbour search: one query, many queries, filtered, farthest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvec.functions import vectors as V
from flowvec.operators.pairwise import best_pairs, compare_blocks, keep_best, to_vectors, with_dim
from flowvec.session import lookup_join

HIT_SCHEMA = "query_id long, id long, score double"
# Hits up to which a report names them to the payload scan; more are joined.
LITERAL_HITS = 1_000


def knn(
    df: DataFrame,
    query: Sequence[float],
    k: int,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    where: Column | None = None,
    farthest: bool = False,
) -> DataFrame:
    """The ``k`` best rows for one query vector: ``id, score, rank``.

    ``where`` restricts the rows before they are ranked.  Only the id and the
    score go through the sort; payload is joined back afterwards.
    """
    rows = df if where is None else df.where(where)
    if metric not in V.METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {sorted(V.METRICS)}")
    value = V.score(metric, F.col(vec_col), V.literal(query))
    best = (
        rows.select(F.col(id_col).alias("id"), value.alias("score"))
        .orderBy(V.best_first(metric, F.col("score"), farthest), "id")
        .limit(k)
        # Undefined scores sort last; testing them here computes each score once.
        .where(F.col("score").isNotNull())
    )
    # At most k rows reach this window.
    order = Window.orderBy(V.best_first(metric, F.col("score"), farthest), "id")
    return best.withColumn("rank", F.row_number().over(order))


def rank_hits(hits: DataFrame, k: int, metric: str, farthest: bool = False) -> DataFrame:
    """Keep the ``k`` best hits of each query and number them."""
    order = Window.partitionBy("query_id").orderBy(
        V.best_first(metric, F.col("score"), farthest), "id"
    )
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def as_queries(df: DataFrame, id_col: str, vec_col: str, *extra: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).alias("q"), *extra)


def as_rows(df: DataFrame, id_col: str, vec_col: str, *extra: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), *extra)


def top_kernel(k: int, metric: str, ascending: bool, dim: int):
    """A kernel that keeps the ``k`` best rows of a block for every query of another."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        # Tested here, as a filter on a computed vector would compute it twice.
        left, right = with_dim(left, "q", dim), with_dim(right, "v", dim)
        if not left.num_rows or not right.num_rows:
            return best_hits([], [], [], k, ascending)
        q, r, value = best_pairs(
            metric, to_vectors(left["q"]), to_vectors(right["v"]), k, ascending, V.TIE_DECIMALS
        )
        query_ids, ids = left["query_id"].to_numpy(), right["id"].to_numpy()
        return best_hits(query_ids[q], ids[r], value, k, ascending)

    return kernel


def best_hits(query_ids, ids, values, k: int, ascending: bool) -> pa.Table:
    if len(ids):
        best = keep_best(query_ids, ids, values, k, ascending)
        query_ids, ids, values = query_ids[best], ids[best], values[best]
    return pa.table(
        {
            "query_id": pa.array(query_ids, pa.int64()),
            "id": pa.array(ids, pa.int64()),
            "score": pa.array(values, pa.float64()),
        }
    )


def knn_join(
    queries: DataFrame,
    rows: DataFrame,
    k: int,
    metric: str = "cosine",
    dim: int | None = None,
    on: tuple[str, ...] = (),
    farthest: bool = False,
    **blocks,
) -> DataFrame:
    """Exact top-``k`` rows for every query: ``query_id, id, score, rank``.

    ``queries`` has ``query_id, q`` and ``rows`` has ``id, v`` plus the integer
    ``on`` columns that must agree.  A row that meets a query under several
    ``on`` values counts once.
    """
    if metric not in V.METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {sorted(V.METRICS)}")
    if dim is None:
        first = queries.select(F.size("q").alias("dim")).first()
        if first is None:
            empty = rows.select(F.lit(0).cast("long").alias("query_id"), "id").limit(0)
            return rank_hits(empty.withColumn("score", F.lit(0.0)), k, metric)
        dim = first["dim"]
    ascending = V.METRICS[metric] != farthest

    def shrink(hits: pa.Table) -> pa.Table:
        return best_hits(
            hits["query_id"].to_numpy(), hits["id"].to_numpy(), hits["score"].to_numpy(), k, ascending
        )

    hits = compare_blocks(
        queries,
        rows,
        top_kernel(k, metric, ascending, dim),
        HIT_SCHEMA,
        on=on,
        dim=dim,
        # Under several ``on`` values one row may occur twice before the rank.
        combine=None if on else shrink,
        **blocks,
    )
    if on:
        hits = hits.dropDuplicates(["query_id", "id"])
    return rank_hits(hits, k, metric, farthest)


def metrics_join(queries: DataFrame, rows: DataFrame, k: int, metrics: Sequence[str], dim: int) -> DataFrame:
    """Top-``k`` of every query under each metric from one scan of ``rows``: ``query_id, metric, id, score, rank``.

    A task keeps ``k`` hits per query and metric; only these are shuffled.
    """
    for metric in metrics:
        if metric not in V.METRICS:
            raise ValueError(f"unknown metric {metric!r}; choose from {sorted(V.METRICS)}")
    kernels = [top_kernel(k, metric, V.METRICS[metric], dim) for metric in metrics]

    def numbered(hits: pa.Table, number: int) -> pa.Table:
        return hits.append_column("number", pa.array(np.full(hits.num_rows, number, np.int32)))

    def every(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.concat_tables([numbered(kernel(left, right), i) for i, kernel in enumerate(kernels)])

    def shrink(hits: pa.Table) -> pa.Table:
        kept = []
        for i, metric in enumerate(metrics):
            mine = hits.filter(pc.equal(hits["number"], i))
            columns = [mine[c].to_numpy() for c in ("query_id", "id", "score")]
            kept.append(numbered(best_hits(*columns, k, V.METRICS[metric]), i))
        return pa.concat_tables(kept)

    hits = compare_blocks(queries, rows, every, HIT_SCHEMA + ", number int", dim=dim, combine=shrink)
    names = F.array(*[F.lit(m) for m in metrics])
    falls = F.array(*[F.lit(not V.METRICS[m]) for m in metrics])
    cost = F.when(F.get(falls, F.col("number")), -F.col("score")).otherwise(F.col("score"))
    order = Window.partitionBy("query_id", "number").orderBy(cost, "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.get(names, F.col("number")).alias("metric"), "id", "score", "rank")


def compare_metrics(
    df: DataFrame, query: Sequence[float], k: int, metrics: Sequence[str], id_col: str = "id", vec_col: str = "embedding"
) -> DataFrame:
    """The same query ranked under several metrics, with a ``metric`` column, from one scan."""
    asked = df.sparkSession.createDataFrame([(0, [float(x) for x in query])], "query_id long, q array<double>")
    return metrics_join(asked, as_rows(df, id_col, vec_col), k, metrics, len(query)).drop("query_id")


def first_vector(df: DataFrame, id_col: str, vec_col: str) -> list[float]:
    """The vector of the smallest id, a common probe."""
    row = df.select(F.min_by(vec_col, id_col).alias("v")).first()
    return [float(x) for x in row["v"]]


def report(hits: DataFrame, payload: DataFrame, id_col: str, text_col: str, decimals: int = 4):
    """Ranked hits with their text; a hit without payload says ``Entry <id>``."""
    spark = payload.sparkSession
    found = hits.limit(LITERAL_HITS + 1).collect()
    texts = payload.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if len(found) <= LITERAL_HITS:
        # A few hits reach the payload scan as a filter.
        local = spark.createDataFrame(found, hits.schema)
        joined = local.join(texts.where(F.col("id").isin([hit["id"] for hit in found])), "id", "left")
    else:
        joined = lookup_join(hits, texts, ["id"])
    return joined.select(
        "rank",
        "id",
        F.round("score", decimals).alias("score"),
        F.coalesce("text", F.concat(F.lit("Entry "), F.col("id").cast("string"))).alias("text"),
    )
