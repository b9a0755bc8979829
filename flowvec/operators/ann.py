"""Approximate search: inverted lists, product codes and hash buckets.

All indexes are plain DataFrames with one more column (list number, code bytes,
hash buckets), so they can be written, partitioned and joined like any table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from flowvec.functions import vectors as V
from flowvec.operators import balls
from flowvec.operators import knn as K
from flowvec.operators.pairwise import BLOCK_ROWS, GRID_CELLS, best_pairs, compare_blocks, shared_groups, to_matrix, to_vectors
from flowvec.session import run_together

# Fixed value: lists that a search of product codes probes unless the caller says otherwise.
MAX_PROBES = 10
# Lists of an index at most, and rows that train one centre: centres are bounded, whatever the table.
MAX_LISTS = 16_384
TRAIN_ROWS = 256
# Rows of a task in a training, where there are enough of them.
POINTS = 25_000
# Sub-vectors and bits per code of the product-quantised index.
PQ_PARTS, PQ_BITS = 8, 8
# Pairs of a query and a code that are scored at once.
CODE_CELLS = 1_000_000


def list_count(rows: int) -> int:
    return min(MAX_LISTS, max(1, math.isqrt(rows)))


def training_rows(rows: DataFrame, count: int, lists: int, id_col: str = "id") -> DataFrame:
    """About ``TRAIN_ROWS`` rows per list, chosen by a hash of the id; all of them where there are no more."""
    wanted = TRAIN_ROWS * lists
    if count <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(count)) < wanted)


def probe_count(lists: int) -> int:
    return min(MAX_PROBES, lists)


def training_points(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, features`` for a training that passes the rows many times.

    Vectors that are mostly zeros are held and multiplied as sparse ones, and
    many rows, which may lie in one partition, are dealt out.
    """
    dense = df.select(F.col(id_col).alias("id"), array_to_vector(V.doubles(F.col(vec_col))).alias("_dense"))
    # The assembler takes the smaller form of a vector.
    points = VectorAssembler(inputCols=["_dense"], outputCol="features").transform(dense).drop("_dense")
    parts = df.count() // POINTS
    return points if parts < 2 else points.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), "id")


def train_centroids(
    df: DataFrame, k: int, id_col: str, vec_col: str, seed: int = 42, max_iter: int = 20
) -> np.ndarray:
    """K-means centroids of all rows, ``k`` at most (fewer where fewer vectors differ)."""
    points = training_points(df, id_col, vec_col).select("features").cache()
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode="random").fit(points)
        return np.array(model.clusterCenters())
    finally:
        points.unpersist()


def assign_lists(
    df: DataFrame, centroids: np.ndarray, vec_col: str, name: str = "list_id", nearest: int = 1
) -> DataFrame:
    """Add the nearest centroid number, or with ``nearest`` > 1 one row per near centroid."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)
    names = [*df.columns, name]
    schema = StructType([*df.schema.fields, StructField(name, IntegerType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (shared.value**2).sum(axis=1)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = to_matrix(batch.column(batch.schema.get_field_index(vec_col)))
            distance = squares - 2 * vectors @ shared.value.T
            near = distance.argmin(axis=1)[:, None] if nearest == 1 else np.argsort(distance, axis=1, kind="stable")[:, :nearest]
            rows = np.repeat(np.arange(batch.num_rows), near.shape[1])
            taken = batch.take(pa.array(rows))
            lists = pa.array(near.ravel().astype(np.int32))
            yield pa.RecordBatch.from_arrays([*taken.columns, lists], names=names)

    return df.mapInArrow(assign, schema)


@dataclass
class InvertedLists:
    """Rows in blocks of their lists (``id, v, block, list_id``), the table of the blocks, the list centroids.

    The bounds of the blocks are distances of ``space``.
    """

    rows: DataFrame
    table: DataFrame
    centroids: np.ndarray
    space: str = "plain"
    stored: bool = False

    @property
    def lists(self) -> int:
        return len(self.centroids)

    def write(self, path: str) -> None:
        """One folder per list, so a search reads only the lists it probes."""
        spark = self.rows.sparkSession
        self.rows.write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/rows")
        self.table.withColumn("space", F.lit(self.space)).write.mode("overwrite").parquet(f"{path}/blocks")
        centers = [(i, [float(x) for x in c]) for i, c in enumerate(self.centroids)]
        table = spark.createDataFrame(centers, "list_id int, centroid array<double>")
        table.write.mode("overwrite").parquet(f"{path}/centroids")

    def blocks(self, space: str) -> balls.Blocks:
        """The blocks with bounds of ``space``; those of another space are cut anew."""
        if space == self.space:
            return balls.Blocks(self.rows, self.table, self.centroids, space, self.stored)
        return balls.place(self.rows.select("id", "v"), self.centroids, space)

    def search(self, queries: DataFrame, k: int, metric: str = "l2", nprobe: int | None = None) -> DataFrame:
        """Top-``k`` of each query.

        By default a query reads lists until no unread one can hold a better hit,
        so the hits are the exact ones.  With ``nprobe`` it reads that many
        nearest lists, and more only until they hold ``k`` rows.
        """
        if nprobe is None:
            return self.bounded(queries, k, metric).hits
        if nprobe >= self.lists:
            return self._all_lists(queries, k, metric)
        probes = self._probes(queries, k, nprobe)
        rows = self.rows
        if self.stored:
            # At most one number per list; as literals they prune the folders.
            probed = [r[0] for r in probes.select("list_id").distinct().collect()]
            rows = rows.where(F.col("list_id").isin(probed))
        return K.knn_join(probes, rows.select("id", "v", "list_id"), k, metric, dim=self.centroids.shape[1], on=("list_id",))

    def _all_lists(self, queries: DataFrame, k: int, metric: str) -> DataFrame:
        """Top-``k`` of each query where it reads every list: no row for each query and list, the lists pass by the queries."""
        if metric not in V.METRICS:
            raise ValueError(f"unknown metric {metric!r}; choose from {sorted(V.METRICS)}")
        ascending, dim = V.METRICS[metric], self.centroids.shape[1]
        best = K.top_kernel(k, metric, ascending, dim)

        def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
            number = right["list_id"].to_numpy()
            order = np.argsort(number, kind="stable")
            heads = np.flatnonzero(np.diff(number[order], prepend=-1))
            lists = [right.take(pa.array(rows)) for rows in np.split(order, heads[1:])]
            # Some queries at a time: each has hits in every list before the best are taken.
            found = []
            for i in range(0, max(1, left.num_rows), BLOCK_ROWS):
                part = left.slice(i, BLOCK_ROWS)
                found.append(shrink(pa.concat_tables([best(part, rows) for rows in lists])))
            return pa.concat_tables(found)

        def shrink(hits: pa.Table) -> pa.Table:
            """The best of what a query meets, a row once."""
            query_ids, ids, value = (hits[c].to_numpy() for c in ("query_id", "id", "score"))
            order = np.lexsort((value if ascending else -value, ids, query_ids))
            query_ids, ids, value = query_ids[order], ids[order], value[order]
            once = np.r_[True, (np.diff(query_ids) != 0) | (np.diff(ids) != 0)][: len(ids)]
            return K.best_hits(query_ids[once], ids[once], value[once], k, ascending)

        parts = max(1, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        # A list lies in few batches.
        rows = self.rows.select("id", "v", "list_id").repartitionByRange(parts, "list_id", "id").sortWithinPartitions("list_id")
        hits = compare_blocks(queries.select("query_id", "q"), rows, kernel, K.HIT_SCHEMA, dim=dim, combine=shrink)
        return K.rank_hits(hits.dropDuplicates(["query_id", "id"]), k, metric)

    def bounded(self, queries: DataFrame, k: int, metric: str = "l2") -> balls.Found:
        """Exact hits by the bounds of the blocks, and how many pairs had to be compared."""
        space = balls.space_of(metric)
        asked = queries.select(F.col("query_id").alias("id"), F.col("q").alias("v"))
        return balls.ball_join(balls.place(asked, self.centroids, space), self.blocks(space), k, metric)

    def _probes(self, queries: DataFrame, k: int, nprobe: int) -> DataFrame:
        """One row per query and list it reads."""
        held = {r["list_id"]: r["n"] for r in self.table.groupBy("list_id").agg(F.sum("n").alias("n")).collect()}
        sizes = np.array([held.get(i, 0) for i in range(self.lists)])
        shared = queries.sparkSession.sparkContext.broadcast((np.asarray(self.centroids), sizes))
        names = [*queries.columns, "list_id"]
        schema = StructType([*queries.schema.fields, StructField("list_id", IntegerType())])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, sizes = shared.value
            squares = (centroids**2).sum(axis=1)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                distance = squares - 2 * to_matrix(batch.column(batch.schema.get_field_index("q"))) @ centroids.T
                order = np.argsort(distance, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                row, place = np.nonzero((np.arange(len(sizes)) < nprobe) | (before < k))
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[row, place].astype(np.int32))], names=names)

        return queries.mapInArrow(probe, schema)


def read_ivf(spark: SparkSession, path: str) -> InvertedLists:
    """An index written by :meth:`InvertedLists.write`."""
    centers = spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()
    rows, table = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/blocks")
    space = table.select("space").first()["space"]
    return InvertedLists(rows, table.drop("space"), np.array([c["centroid"] for c in centers]), space, stored=True)


def build_ivf(
    df: DataFrame,
    id_col: str = "id",
    vec_col: str = "embedding",
    nlist: int | None = None,
    seed: int = 42,
    space: str = "plain",
) -> InvertedLists:
    """Lists around centres that a bounded share of the rows has trained; every row is indexed."""
    rows = K.as_rows(df, id_col, vec_col).where(F.col("v").isNotNull())
    count = rows.count()
    nlist = list_count(count) if nlist is None else nlist
    centroids = train_centroids(training_rows(rows, count, nlist), nlist, "id", "v", seed)
    blocks = balls.place(rows, centroids, space)
    return InvertedLists(blocks.rows, blocks.table, blocks.centres, space)


@dataclass
class ProductCodes:
    """Rows with one code byte per sub-vector, and the code words of each sub-vector."""

    rows: DataFrame
    words: list[np.ndarray]
    centroids: np.ndarray

    def search(self, queries: DataFrame, k: int, nprobe: int | None = None) -> DataFrame:
        """Top-``k`` by squared L2 to the decoded vectors, from per-query lookup tables."""
        lists = len(self.centroids)
        nprobe = probe_count(lists) if nprobe is None else min(nprobe, lists)
        probes = assign_lists(queries, self.centroids, "q", nearest=nprobe)
        shared = queries.sparkSession.sparkContext.broadcast(self.words)

        def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
            codes = to_matrix(right["code"]).astype(int)
            vectors = to_matrix(left["q"])
            query_ids, ids = left["query_id"].to_numpy(), right["id"].to_numpy()
            found = [K.best_hits([], [], [], k, True)]
            step = max(1, CODE_CELLS // max(1, len(codes)))
            for i in range(0, len(vectors), step):
                part = vectors[i : i + step]
                value = np.zeros((len(part), len(codes)))
                start = 0
                for column, words in enumerate(shared.value):
                    piece = part[:, start : start + words.shape[1]]
                    start += words.shape[1]
                    lookup = ((piece[:, None, :] - words[None, :, :]) ** 2).sum(axis=2)
                    value += lookup[:, codes[:, column]]
                near = np.ones(value.shape, bool)
                if k < len(codes):
                    # What rounds like the k-th best stays in: ids decide.
                    near = value <= np.partition(value, k - 1, axis=1)[:, k - 1 : k] + 2e-9
                q, r = np.nonzero(near)
                found.append(K.best_hits(query_ids[i + q], ids[r], np.round(value[q, r], V.TIE_DECIMALS), k, True))
            return pa.concat_tables(found)

        hits = compare_blocks(
            probes,
            self.rows,
            kernel,
            K.HIT_SCHEMA,
            on=("list_id",),
            dim=self.centroids.shape[1],
        )
        return K.rank_hits(hits, k, "l2_sq")


def build_ivfpq(
    df: DataFrame,
    id_col: str = "id",
    vec_col: str = "embedding",
    nlist: int | None = None,
    parts: int = PQ_PARTS,
    bits: int = PQ_BITS,
    seed: int = 42,
) -> ProductCodes:
    index = build_ivf(df, id_col, vec_col, nlist, seed)
    dim = index.centroids.shape[1]
    if dim % parts:
        raise ValueError(f"{dim} dimensions do not split into {parts} sub-vectors")
    width = dim // parts
    size = 1 << bits

    def train(part: int) -> np.ndarray:
        pieces = index.rows.select("id", F.slice("v", part * width + 1, width).alias("s"))
        return train_centroids(pieces, size, "id", "s", seed + part, max_iter=10)

    words = run_together(train, range(parts))
    shared = df.sparkSession.sparkContext.broadcast(words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            vectors = to_matrix(table["v"])
            codes = np.empty((len(vectors), parts), dtype=np.int16)
            for part, centers in enumerate(shared.value):
                piece = vectors[:, part * width : (part + 1) * width]
                distance = (centers**2).sum(axis=1) - 2 * piece @ centers.T
                codes[:, part] = distance.argmin(axis=1)
            offsets = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
            code = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["list_id"], code], names=["id", "list_id", "code"]
            )

    coded = index.rows.mapInArrow(encode, "id long, list_id int, code array<short>")
    return ProductCodes(coded, words, index.centroids)


@dataclass
class HashBuckets:
    """Rows with their bucket number in every hash table of random projections."""

    rows: DataFrame
    model: object

    def search(
        self, queries: DataFrame, k: int, metric: str = "cosine_distance", max_queries: int = 50_000
    ) -> DataFrame:
        """Top-``k`` among the rows that share a bucket with the query in any table.

        A bounded set of queries visits the rows where they are.  A larger one
        meets them in blocks; no vector travels for each of its buckets.
        """
        asked = _bucketed(self.model, queries, "q")
        ascending = V.METRICS[metric]

        def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
            vectors, rows = to_vectors(left["q"]), to_vectors(right["v"])
            mine, theirs = _integers(left["buckets"]), _integers(right["buckets"])
            query_ids, ids = left["query_id"].to_numpy(), right["id"].to_numpy()
            found = []
            for slot in range(mine.shape[1]):
                for a, b in shared_groups(mine[:, slot : slot + 1], theirs[:, slot : slot + 1]):
                    q, r, value = best_pairs(
                        metric, vectors[a], rows[b], k, ascending, V.TIE_DECIMALS
                    )
                    found.append((a[q], b[r], value))
            if not found:
                nothing = np.zeros(0, dtype=np.int64)
                return K.best_hits(nothing, nothing, np.zeros(0), k, ascending)
            q, r, value = (np.concatenate(parts) for parts in zip(*found))
            # The tables may bring the same row more than once.
            _, once = np.unique(q * len(rows) + r, return_index=True)
            return K.best_hits(query_ids[q[once]], ids[r[once]], value[once], k, ascending)

        def shrink(hits: pa.Table) -> pa.Table:
            return K.best_hits(*(hits[c].to_numpy() for c in ("query_id", "id", "score")), k, ascending)

        first = asked.select(F.size("q") + F.size("buckets")).first()
        block_rows = max(BLOCK_ROWS, GRID_CELLS // max(1, first[0] if first else 1))
        hits = compare_blocks(
            asked, self.rows, kernel, K.HIT_SCHEMA, dim=1, combine=shrink, block_rows=block_rows, broadcast_cells=max_queries
        )
        return K.rank_hits(hits, k, metric)


def _integers(column) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _bucketed(model, df: DataFrame, vec_col: str) -> DataFrame:
    """Add the bucket of the unit vector in every hash table."""
    unit = df.withColumn("features", array_to_vector(V.normalize(F.col(vec_col))))
    hashed = model.transform(unit.where(F.col("features").isNotNull()))
    first = F.transform("hashes", lambda h: vector_to_array(h)[0].cast("long"))
    return hashed.select(*df.columns, first.alias("buckets"))


def build_lsh(
    df: DataFrame,
    id_col: str = "id",
    vec_col: str = "embedding",
    tables: int = 8,
    width: float = 0.25,
    seed: int = 42,
) -> HashBuckets:
    rows = K.as_rows(df, id_col, vec_col)
    unit = rows.select(array_to_vector(V.normalize(F.col("v"))).alias("features"))
    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=width, numHashTables=tables, seed=seed
    ).fit(unit.where(F.col("features").isNotNull()))
    return HashBuckets(_bucketed(model, rows, "v"), model)


def recall(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Share of each query's true hits that were found; 0 for a query without truth."""
    pairs = ["query_id", "id"]
    hit = found.select(*pairs).distinct().withColumn("_hit", F.lit(1))
    matched = truth.select(*pairs).distinct().join(hit, pairs, "left")
    queries = found.select("query_id").distinct()
    per_query = matched.groupBy("query_id").agg(
        (F.count("_hit") / F.count(F.lit(1))).alias("recall")
    )
    return queries.join(per_query, "query_id", "full").select(
        "query_id", F.coalesce("recall", F.lit(0.0)).alias("recall")
    )
