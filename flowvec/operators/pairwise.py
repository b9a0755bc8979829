"""Blockwise comparison of two vector tables with numpy inside Spark tasks.

``compare_blocks`` feeds a kernel one block of left rows and one of right rows
at a time, so memory stays bounded and only the kernel's small result is
shuffled, never the pairs.  A left side of checked size is broadcast; otherwise
both sides are cut into hashed blocks that meet on a block grid, where a task
holds the left block and the rows of the right one stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.session import lookup_join

Kernel = Callable[[pa.Table, pa.Table], pa.Table]

# Largest left side that is broadcast, and block of the grid, as cells of its vectors.
BROADCAST_CELLS = 8_000_000
GRID_CELLS = 8_000_000
BLOCK_ROWS = 8_192
# Rows of both sides whose pairs are ranked by one matrix product.
TILE = 1_024
# Rows against which the first limit of a query is found; few rows are compared at once.
FIRST_ROWS, FEW_ROWS = 512, 64


def to_vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array; null or other lengths raise."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(flat) == 0:
        return np.zeros((0, 0))
    widths = pc.list_value_length(flat)
    if widths.null_count or pc.min(widths).as_py() != pc.max(widths).as_py():
        raise ValueError("vectors must be there and of one length")
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """:func:`to_vectors` as doubles."""
    return to_vectors(column).astype(np.float64)


def with_dim(table: pa.Table, column: str, dim: int) -> pa.Table:
    """Rows whose vector is there and has ``dim`` cells."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(table[column]), dim), False)
    return table if pc.all(fits).as_py() else table.filter(fits)


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def shared_groups(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of both sides for every key (a row of integers) that both have."""
    both = np.concatenate([left, right])
    _, codes = np.unique(both, axis=0, return_inverse=True)
    codes = codes.ravel()

    def grouped(part: np.ndarray) -> dict[int, np.ndarray]:
        order = np.argsort(part, kind="stable")
        values, starts = np.unique(part[order], return_index=True)
        return dict(zip(values.tolist(), np.split(order, starts[1:])))

    lefts, rights = grouped(codes[: len(left)]), grouped(codes[len(left) :])
    for code in lefts.keys() & rights.keys():
        yield lefts[code], rights[code]


def _keys(table: pa.Table, on: list[str]) -> np.ndarray:
    return np.column_stack([table[name].to_numpy() for name in on])


def _meet(left: pa.Table, right: pa.Table, on: list[str], kernel: Kernel) -> Iterator[pa.Table]:
    """Run the kernel on the rows that agree on the ``on`` columns."""
    if not on:
        yield kernel(left, right)
        return
    if left.num_rows == 0:
        return
    for mine, theirs in shared_groups(_keys(left, on), _keys(right, on)):
        yield kernel(left.take(pa.array(mine)), right.take(pa.array(theirs)))


def compare_blocks(
    left: DataFrame,
    right: DataFrame,
    kernel: Kernel,
    schema: str,
    on: tuple[str, ...] = (),
    left_id: str = "query_id",
    right_id: str = "id",
    dim: int = 1,
    combine: Callable[[pa.Table], pa.Table] | None = None,
    block_rows: int | None = None,
    broadcast_cells: int = BROADCAST_CELLS,
    mirrored: Callable[[pa.Table, pa.Table], Iterator[pa.Table]] | None = None,
) -> DataFrame:
    """Apply ``kernel(left block, right block)`` to all blocks that share ``on``.

    With ``mirrored`` both sides are the same rows: on the grid two different
    blocks meet once, and it gives the results of either side.
    ``combine`` may shrink the gathered results of one task before they leave it.
    The ``on`` columns must be integers.
    """
    keys = list(on)
    spark = left.sparkSession
    bound = max(1, broadcast_cells // max(1, dim))
    left_rows = left.limit(bound + 1).toArrow() if bound else None
    if left_rows is not None and left_rows.num_rows <= bound:
        shared = spark.sparkContext.broadcast(left_rows)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = (pa.Table.from_batches([batch]) for batch in batches if batch.num_rows)
            yield from gathered((result for block in blocks for result in _meet(shared.value, block, keys, kernel)), combine)

        return right.mapInArrow(scan, schema)

    block_rows = block_rows or max(BLOCK_ROWS, GRID_CELLS // max(1, dim))
    if keys:
        return _grid(left, right, kernel, schema, keys, left_id, right_id, block_rows)
    return _streamed_grid(left, right, kernel, schema, left_id, right_id, block_rows, combine, mirrored)


def gathered(results: Iterator[pa.Table], combine: Callable[[pa.Table], pa.Table] | None) -> Iterator[pa.RecordBatch]:
    """The results of a task, shrunk by ``combine`` as often as they have doubled."""
    held: list[pa.Table] = []
    size, most = 0, 1_000_000
    for result in results:
        if combine is None:
            yield from result.to_batches()
            continue
        held.append(result)
        size += result.num_rows
        if size > most:
            held = [combine(pa.concat_tables(held))]
            # Results that no longer shrink are handed on as they are.
            if held[0].num_rows > 0.8 * size:
                yield from held[0].to_batches()
                held = []
            size = sum(t.num_rows for t in held)
            most = max(1_000_000, 2 * size)
    if held:
        yield from combine(pa.concat_tables(held)).to_batches()


def stream_cells(
    sides: list[DataFrame], cells: int, begin: Callable[[list[pa.Table | None]], Callable[[pa.Table], Iterator[pa.Table]]], schema: str, combine=None, order: str | None = None
) -> DataFrame:
    """Let the rows of the last of ``sides`` stream, by ``order``, past the other sides' rows of their ``_cell``, a number below ``cells``.

    ``begin`` gets the tables of the other sides (``None`` where a cell has none)
    and returns what is called with the last side's rows, batch by batch.
    """
    names = [[c for c in side.columns if c != "_cell"] for side in sides]
    kinds = [side.select(*own).schema for side, own in zip(sides, names, strict=True)]
    both = None
    for number, (side, own) in enumerate(zip(sides, names, strict=True)):
        values = [F.struct(*own) if i == number else F.lit(None).cast(kind) for i, kind in enumerate(kinds)]
        placed = side.select(F.col("_cell").cast("int").alias("_cell"), F.lit(number).alias("_side"), *[v.alias(f"_{i}") for i, v in enumerate(values)])
        both = placed if both is None else both.unionByName(placed)
    # Twice as many ranges as cells, so that each cell gets its own.
    last = len(sides) - 1
    met = both.repartitionByRange(2 * cells, "_cell").sortWithinPartitions("_cell", "_side", *([f"_{last}.{order}"] if order else []))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0).to_numpy().astype(np.int64) * (last + 1) + batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1)).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                cell, side = divmod(int(place[a]), last + 1)
                rows = batch.column(2 + side).slice(a, b - a)
                yield cell, side, pa.Table.from_arrays(rows.flatten(), names=names[side])

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        current, held, meet = None, [[] for _ in range(last)], None
        for cell, side, table in runs(batches):
            if cell != current:
                current, held, meet = cell, [[] for _ in range(last)], None
            if side < last:
                held[side].append(table)
                continue
            if meet is None:
                meet = begin([pa.concat_tables(t).combine_chunks() if t else None for t in held])
                held = []
            yield from meet(table)

    return met.mapInArrow(lambda batches: gathered(results(batches), combine), schema)


def _streamed_grid(
    left: DataFrame, right: DataFrame, kernel: Kernel, schema: str, left_id: str, right_id: str, block_rows: int, combine, mirrored
) -> DataFrame:
    """Every left block meets every right block, a task each; with ``mirrored`` every two blocks meet once."""
    # A few blocks at least, so that there are tasks to share out.
    lefts, rights = (max(1, -(-rows // min(block_rows, max(BLOCK_ROWS, rows // 4)))) for rows in (left.count(), right.count()))
    twice = mirrored is not None

    def placed(df: DataFrame, row_id: str, mine: int, others: Column, cell: Callable[[Column, Column], Column]) -> DataFrame:
        own = F.pmod(F.xxhash64(row_id), F.lit(mine)).cast("int")
        return df.withColumn("_block", own).withColumn("_cell", F.explode(F.transform(others, lambda other: cell(F.col("_block"), other))))

    of_left = F.sequence(F.col("_block") if twice else F.lit(0), F.lit(rights - 1))
    of_right = F.sequence(F.lit(0), F.col("_block") if twice else F.lit(lefts - 1))
    sides = [
        placed(left, left_id, lefts, of_left, lambda own, other: own * rights + other),
        placed(right, right_id, rights, of_right, lambda own, other: other * rights + own),
    ]

    def begin(held: list[pa.Table | None]):
        def meet(rows: pa.Table) -> Iterator[pa.Table]:
            if held[0] is None:
                return
            if twice and held[0]["_block"][0] != rows["_block"][0]:
                yield from mirrored(held[0], rows)
            else:
                yield kernel(held[0], rows)

        return meet

    return stream_cells(sides, lefts * rights, begin, schema, combine)


def _grid(
    left: DataFrame,
    right: DataFrame,
    kernel: Kernel,
    schema: str,
    keys: list[str],
    left_id: str,
    right_id: str,
    block_rows: int,
) -> DataFrame:
    """Every left block meets every right block of its ``keys`` in one small group."""

    def block_counts(df: DataFrame, name: str) -> DataFrame:
        blocks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int")
        return df.groupBy(*keys).agg(blocks.alias(name))

    sizes = block_counts(left, "_lb").join(block_counts(right, "_rb"), keys)
    left = lookup_join(left, sizes, keys, "inner")
    right = lookup_join(right, sizes, keys, "inner")

    def placed(df: DataFrame, row_id: str, own: str, other: str, own_n: str, other_n: str):
        mine = F.pmod(F.xxhash64(row_id), F.col(own_n)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))
        return df.withColumn(own, mine).withColumn(other, theirs).drop("_lb", "_rb")

    # Fresh names keep the sides apart where both come from one table.
    def renewed(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(c) for c in df.columns])

    left = renewed(placed(left, left_id, "_l", "_r", "_lb", "_rb"))
    right = renewed(placed(right, right_id, "_r", "_l", "_rb", "_lb"))
    cells = [*keys, "_l", "_r"]
    empty = arrow_schema(spark_schema(left.sparkSession, schema)).empty_table()

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return kernel(a, b) if a.num_rows and b.num_rows else empty

    return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(cell, schema)


def spark_schema(spark, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances, queries down and rows across."""
    # The expanded square cancels for near points; these get the plain difference.
    center = rows.mean(axis=0) if len(rows) else 0.0
    q, r = queries - center, rows - center
    q_square, r_square = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", r, r)
    if not len(r) or not np.isfinite(q_square).all() or not np.isfinite(r_square).all():
        return plain_distances(queries, rows)
    value = q @ (-2 * r.T)
    value += q_square[:, None]
    value += r_square
    at = np.flatnonzero((value < (1e-4 * (q_square + r_square.max()))[:, None]).ravel())
    if len(at) > value.size // 8:
        return plain_distances(queries, rows)
    flat = value.reshape(-1)
    step = max(1, 2_000_000 // max(1, rows.shape[1]))
    for i in range(0, len(at), step):
        a, b = np.divmod(at[i : i + step], len(rows))
        difference = queries[a] - rows[b]
        flat[at[i : i + step]] = np.einsum("ij,ij->i", difference, difference)
    return np.sqrt(value, out=value)


def plain_distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    value = np.empty((len(queries), len(rows)))
    step = max(1, 2_000_000 // max(1, rows.size))
    for i in range(0, len(queries), step):
        difference = queries[i : i + step, None, :] - rows[None, :, :]
        value[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", difference, difference))
    return value


def best_pairs(
    metric: str, queries: np.ndarray, rows: np.ndarray, k: int, ascending: bool, decimals: int, worst: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, row numbers and rounded scores of a superset of the ``k`` best.

    Matrix products of single precision rank the pairs, tile by tile; what may
    be among the best by its error, or may round like the k-th best one so that
    ids decide later, gets its score in double precision.  With ``worst``, a
    score for each query, pairs that are worse than that may be left out.
    """
    ranked = Ranked(metric, rows, ascending) if len(rows) > FEW_ROWS or worst is not None else None
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for i in range(0, len(queries), TILE):
        part = queries[i : i + TILE]
        got = ranked.best(part, k, decimals, None if worst is None else worst[i : i + TILE]) if ranked and ranked.usable else None
        if got is not None:
            found.append((got[0] + i, *got[1:]))
            continue
        step = max(1, 2 * TILE * TILE // max(1, len(rows)))
        for j in range(0, len(part), step):
            q, r, value = all_pairs(metric, part[j : j + step].astype(np.float64), rows.astype(np.float64), k, ascending, decimals)
            found.append((q + i + j, r, value))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


class Ranked:
    """Rows that are ranked for queries by products of single precision."""

    def __init__(self, metric: str, rows: np.ndarray, ascending: bool):
        self.metric, self.squared, self.unit = metric, metric in ("l2", "l2_sq"), metric.startswith("cosine")
        # The smallest cost is the best: the product or, less the square of the query, the squared distance, with this sign.
        similar = not self.squared and not metric.endswith("distance")
        self.sign = 1.0 if (ascending if self.squared else similar == ascending) else -1.0
        rows = rows.astype(np.float64)
        self.usable = bool(len(rows) and np.isfinite(rows).all())
        if not self.usable:
            return
        self.number = np.arange(len(rows))
        self.center = rows.mean(axis=0) if self.squared else 0.0
        # Distances do not change, and small numbers lose less in the product.
        rows = rows - self.center
        norms = np.linalg.norm(rows, axis=1)
        if self.unit:
            self.number = np.flatnonzero(norms > 0)
            rows, norms = rows[self.number] / norms[self.number, None], np.ones(len(self.number))
        self.rows, self.most = rows, float(norms.max(initial=0.0))
        # Squares must have a place among single numbers.
        self.usable = bool(len(rows)) and (self.most == 0 or 1e-12 < self.most < 1e12)
        if self.usable:
            self.single = np.column_stack([rows, norms**2]).astype(np.float32) if self.squared else rows.astype(np.float32)

    def best(self, queries: np.ndarray, k: int, decimals: int, worst: np.ndarray | None):
        """Like :func:`best_pairs`; ``None`` if too many pairs are too near to each other."""
        queries = queries.astype(np.float64) - self.center
        norms = np.linalg.norm(queries, axis=1)
        if not np.isfinite(norms).all() or norms.max(initial=0.0) > 1e12:
            return None
        number = np.arange(len(queries))
        if self.unit:
            number = np.flatnonzero(norms > 0)
            queries, norms = queries[number] / norms[number, None], np.ones(len(number))
        dim = queries.shape[1]
        if self.squared:
            single = self.sign * np.column_stack([-2 * queries, np.ones(len(queries))])
            largest = 2 * norms * self.most + self.most**2
        else:
            single, largest = self.sign * queries, norms * self.most
        single = single.astype(np.float32)
        error = (dim + 8) * 6e-8 * largest + 1e-30

        def bound() -> np.ndarray:
            """The cost up to which a pair may be as good as one of the cost ``limit``, or round like it."""
            alike = 2e-9
            if self.squared:
                # Roots that round alike differ by more in the square the farther they are.
                alike = 2e-9 * (1 + np.sqrt(np.abs(self.sign * np.where(np.isinf(limit), 0, limit) + norms**2)))
            return np.nextafter((limit + error + alike).astype(np.float32), np.float32(np.inf))

        limit = np.full(len(queries), np.inf)
        if worst is not None:
            score = worst[number]
            if self.squared:
                limit = (score**2 if self.metric == "l2" else score) - norms**2
            else:
                limit = score - 1 if self.metric.endswith("distance") else -score
            limit = np.where(np.isnan(limit), np.inf, limit)
        cap = 64 * (k + 4) * len(queries) + 100_000
        q = r = np.zeros(0, np.int64)
        cost = np.zeros(0, np.float32)
        start, step = 0, TILE if worst is not None else FIRST_ROWS
        while start < len(self.single):
            tile = single @ self.single[start : start + step].T
            if np.isinf(limit).any() and tile.shape[1] >= k:
                limit = np.minimum(limit, np.partition(tile, k - 1, axis=1)[:, k - 1] + error)
            at = np.flatnonzero((tile <= bound()[:, None]).ravel())
            if len(at) + len(q) > cap:
                return None
            if len(at):
                q, r = np.concatenate([q, at // tile.shape[1]]), np.concatenate([r, at % tile.shape[1] + start])
                cost = np.concatenate([cost, tile.ravel()[at]])
                order = np.lexsort((cost, q))
                q, r, cost = q[order], r[order], cost[order]
                heads = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
                kth = heads[np.diff(np.r_[heads, len(q)]) >= k]
                limit[q[kth]] = np.minimum(limit[q[kth]], cost[kth + k - 1] + error[q[kth]])
                keep = cost <= bound()[q]
                q, r, cost = q[keep], r[keep], cost[keep]
            start += step
            step = min(2 * step, TILE)
        value = np.empty(len(q))
        step = max(1, 2_000_000 // max(1, dim))
        for i in range(0, len(q), step):
            mine, theirs = queries[q[i : i + step]], self.rows[r[i : i + step]]
            if self.squared:
                mine = mine - theirs
                theirs = mine
            value[i : i + step] = np.einsum("ij,ij->i", mine, theirs)
        if self.metric == "l2":
            value = np.sqrt(value)
        elif self.metric.endswith("distance"):
            value = 1 - value
        return number[q], self.number[r], np.round(value, decimals) + 0.0


def all_pairs(
    metric: str, queries: np.ndarray, rows: np.ndarray, k: int, ascending: bool, decimals: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`best_pairs`, by one product of double precision, for any numbers and any number of ties."""
    squared = metric in ("l2", "l2_sq")
    if squared and len(rows):
        # Distances do not change, and small numbers lose less in the product.
        center = rows.mean(axis=0)
        queries, rows = queries - center, rows - center
    query_norms, row_norms = np.linalg.norm(queries, axis=1), np.linalg.norm(rows, axis=1)
    if squared:
        rough = (query_norms**2)[:, None] + (row_norms**2)[None, :] - 2 * (queries @ rows.T)
    elif metric.startswith("cosine"):
        with np.errstate(divide="ignore", invalid="ignore"):
            rough = (queries / query_norms[:, None]) @ (rows / row_norms[:, None]).T
        rough[np.isnan(rough)] = np.inf if metric == "cosine_distance" else -np.inf
        undefined = np.isinf(rough)
    else:
        rough = queries @ rows.T
    if metric.endswith("distance"):
        rough = 1 - rough
        if metric.startswith("cosine"):
            rough[undefined] = np.inf
    # From here on the smallest value is the best one.
    order_by = rough if ascending else -rough
    if metric.startswith("cosine"):
        order_by[undefined] = np.inf
    if k < len(rows):
        limit = np.partition(order_by, k - 1, axis=1)[:, k - 1]
        near = 2e-9
        if squared:
            largest = query_norms**2 + row_norms.max() ** 2
            near = 2e-9 * (1 + np.sqrt(np.abs(limit))) + 1e-13 * (queries.shape[1] + 8) * largest
        keep = order_by <= (limit + near)[:, None]
    else:
        keep = np.ones(order_by.shape, dtype=bool)
    if metric.startswith("cosine"):
        keep &= ~undefined
    q, r = np.nonzero(keep)
    if not squared:
        return q, r, np.round(rough[q, r], decimals) + 0.0
    # The expanded square cancels for near points; the kept pairs get the plain one.
    exact = np.empty(len(q))
    step = max(1, 4_000_000 // max(1, queries.shape[1]))
    for i in range(0, len(q), step):
        difference = queries[q[i : i + step]] - rows[r[i : i + step]]
        exact[i : i + step] = np.einsum("ij,ij->i", difference, difference)
    return q, r, np.round(np.sqrt(exact) if metric == "l2" else exact, decimals)


def keep_best(
    group: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int, ascending: bool
) -> np.ndarray:
    """Row numbers of the ``k`` best values of each group, ids breaking ties."""
    order = np.lexsort((ids, values if ascending else -values, group))
    ordered = group[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    place = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    return order[place < k]
