"""Search, index, change and evaluation properties on small tables."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowvec.functions import vectors as V
from flowvec.operators import ann, crud
from flowvec.operators import embedding as M
from flowvec.operators import evaluation as E
from flowvec.operators import knn as K
from flowvec.operators import positions as P
from flowvec.operators.pairwise import to_matrix
from flowvec.streaming import ingest as I

N, DIM = 240, 8


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    data = rng.normal(size=(N, DIM)).astype(np.float32)
    data[80:160] = data[80]  # a third of the rows are copies
    return data


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(points)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, label int").cache()


def exact(points, k, metric, allowed=lambda q, r: True):
    data = points.astype(np.float64)
    result = {}
    for q in range(len(data)):
        if metric == "l2":
            value = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        elif metric == "cosine":
            value = -(data @ data[q]) / (np.linalg.norm(data, axis=1) * np.linalg.norm(data[q]))
        else:
            value = -(data @ data[q])
        value = np.round(value, 9)
        ids = sorted((r for r in range(len(data)) if allowed(q, r)), key=lambda r: (value[r], r))
        result[q] = ids[:k]
    return result


def by_query(hits):
    found = {}
    for r in sorted(hits.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.id)
    return found


def sides(table, *extra):
    return K.as_queries(table, "id", "embedding", *extra), K.as_rows(table, "id", "embedding", *extra)


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
@pytest.mark.parametrize("blocks", [{}, {"broadcast_cells": 8, "block_rows": 50}])
def test_batch_search_is_exact_on_both_paths(table, points, metric, blocks):
    queries, rows = sides(table)
    found = by_query(K.knn_join(queries, rows, 7, metric, **blocks))
    assert found == exact(points, 7, metric)


@pytest.mark.parametrize("blocks", [{}, {"broadcast_cells": 8, "block_rows": 20}])
def test_batch_search_within_groups(table, points, blocks):
    queries, rows = sides(table, "label")
    found = by_query(K.knn_join(queries, rows, 5, "l2", on=("label",), **blocks))
    assert found == exact(points, 5, "l2", lambda q, r: q % 3 == r % 3)


def test_single_query_agrees_with_batch(table, points):
    found = [r.id for r in K.knn(table, points[5], 9, "cosine").orderBy("rank").collect()]
    assert found == exact(points, 9, "cosine")[5]
    assert K.knn(table, points[5], 10_000, "l2").count() == N


def test_farthest_is_nearest_of_the_opposite_under_inner_product(table, points):
    far = [r.id for r in K.knn(table, points[7], 5, "ip", farthest=True).orderBy("rank").collect()]
    near = [r.id for r in K.knn(table, -points[7], 5, "ip").orderBy("rank").collect()]
    assert far == near


def test_filter_comes_before_the_limit(table):
    hits = K.knn(table, [1.0] * DIM, 10, "l2", where=F.col("label") == 2)
    assert hits.count() == 10 and all(r.id % 3 == 2 for r in hits.collect())


@pytest.mark.parametrize("blocks", [{}, {"broadcast_cells": 8, "block_rows": 50}])
def test_missing_and_short_vectors_are_no_hits(spark, table, blocks):
    odd = spark.createDataFrame([(1000, None, 0), (1001, [1.0], 0)], table.schema)
    queries, rows = sides(table.unionByName(odd))
    found = by_query(K.knn_join(queries, rows, 3, "l2", dim=DIM, **blocks))
    assert len(found) == N and all(i < N for ids in found.values() for i in ids)


def test_unknown_metric(table):
    with pytest.raises(ValueError):
        K.knn(table, [0.0] * DIM, 1, "nearest")


def test_ivf_full_probe_is_exact_and_recall_rises(table, points):
    queries, rows = sides(table)
    index = ann.build_ivf(table, nlist=6)
    assert index.rows.count() == N
    truth = K.knn_join(queries, rows, 5, "l2")
    assert by_query(index.search(queries, 5, "l2", nprobe=index.lists)) == by_query(truth)
    recalls = [
        ann.recall(truth, index.search(queries, 5, "l2", nprobe=n)).agg(F.avg("recall")).first()[0]
        for n in (1, 3, 6)
    ]
    assert recalls == sorted(recalls) and recalls[-1] == 1 and recalls[0] > 0.3


def test_stored_index_reads_only_probed_lists(spark, table, tmp_path):
    queries, _ = sides(table.where("id = 3"))
    index = ann.build_ivf(table, nlist=6)
    index.write(str(tmp_path / "ivf"))
    stored = ann.read_ivf(spark, str(tmp_path / "ivf"))
    assert by_query(stored.search(queries, 5, nprobe=2)) == by_query(index.search(queries, 5, nprobe=2))


def test_hash_buckets_agree_on_both_paths(table):
    queries, _ = sides(table)
    index = ann.build_lsh(table, tables=4, width=0.5)
    local = by_query(index.search(queries, 5))
    assert local == by_query(index.search(queries, 5, max_queries=10))


def test_product_codes_and_hash_buckets_find_most(table):
    queries, rows = sides(table)
    coded = ann.build_ivfpq(table, nlist=4, parts=4).search(queries, 20, nprobe=4)
    truth = K.knn_join(queries, rows, 20, "l2")
    assert ann.recall(truth, coded).agg(F.avg("recall")).first()[0] > 0.3
    hashed = ann.build_lsh(table, tables=6, width=0.5).search(queries, 5, "cosine_distance")
    close = K.knn_join(queries, rows, 5, "cosine_distance")
    assert ann.recall(close, hashed).agg(F.avg("recall")).first()[0] > 0.6


def test_recall_of_an_empty_truth_is_zero(spark):
    schema = "query_id long, id long"
    truth = spark.createDataFrame([(1, 5), (1, 6)], schema)
    found = spark.createDataFrame([(1, 5), (2, 9)], schema)
    assert {r.query_id: r.recall for r in ann.recall(truth, found).collect()} == {1: 0.5, 2: 0.0}


def test_list_and_probe_counts():
    assert [ann.list_count(n) for n in (1, 50, 10_000, 10**9)] == [1, 7, 100, ann.MAX_LISTS]
    assert ann.probe_count(4) == 4 and ann.probe_count(100) == 10


# --- positions --------------------------------------------------------------


@pytest.mark.parametrize("size", [9, 1_000])
def test_positions_over_buckets(spark, size):
    keys = [(i * 37) % 1009 for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = P.with_position(df, "k", rows_per_bucket=size).collect()
    assert {r.k: r.pos for r in rows} == {k: i + 1 for i, k in enumerate(sorted(keys))}
    mixed = P.with_hash_position(df, "k", seed="s", rows_per_bucket=size).collect()
    assert sorted(r.pos for r in mixed) == list(range(1, 201))
    again = P.with_hash_position(df, "k", seed="s", rows_per_bucket=1_000).collect()
    assert {r.k: r.pos for r in mixed} == {r.k: r.pos for r in again}


@pytest.mark.parametrize("size", [7, 1_000])
def test_shuffle_keeps_the_values_of_each_part(spark, size):
    df = spark.createDataFrame([(i, f"v{i}", i // 40) for i in range(120)], "k long, v string, p int")
    rows = P.shuffle_in_parts(df, "k", "v", "p", rows_per_bucket=size).collect()
    for part in range(3):
        mine = [r for r in rows if r.p == part]
        assert sorted(r.shuffled for r in mine) == sorted(r.v for r in mine)
    assert any(r.shuffled != r.v for r in rows)


def test_parts_differ_by_at_most_one(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in P.in_parts(df, "k", 10).groupBy("part").count().collect()]
    assert sum(sizes) == 103 and len(sizes) == 10 and max(sizes) - min(sizes) <= 1


# --- changes ----------------------------------------------------------------


@pytest.fixture(scope="module")
def state(spark):
    return spark.createDataFrame(
        [(1, "a", "TCP"), (2, "a", None), (3, "b", "UDP"), (4, "c", "TCP")], "id long, text string, p string"
    )


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_is_idempotent(spark, state):
    log = spark.createDataFrame(
        [(2, "x", "A", 1), (2, "y", "B", 2), (9, "z", "C", 1)], "id long, text string, p string, seq int"
    )
    changes = crud.latest(log, "id", "seq").drop("seq")
    once = crud.upsert(state, changes, "id")
    assert as_set(once) == as_set(crud.upsert(once, changes, "id"))
    assert (2, "y", "B") in as_set(once) and once.count() == 5


def test_changes_by_condition_are_null_safe(state):
    assert {r.id for r in crud.delete_where(state, F.col("p") == "TCP").collect()} == {2, 3}
    changed = crud.changes_where(F.col("id") > 0, "p", F.lit("TCP"))
    assert {r.id for r in state.where(changed).collect()} == {2, 3}


def test_inserts_and_deletes_add_up(spark, state):
    more = crud.insert(state, state.where("id < 3"), "id", "id")
    assert sorted(r.id for r in more.collect()) == [1, 2, 3, 4, 5, 6]
    unknown = spark.createDataFrame([(1,), (77,)], "id long")
    assert crud.delete_ids(more, unknown, "id").count() == 5
    assert crud.delete_sample(more, 100, "id").count() == 0
    moved = crud.fifo_update(more, 2, "id", {"p": F.lit("U")})
    assert sorted(r.id for r in moved.collect()) == [3, 4, 5, 6, 7, 8]


def test_equal_texts_take_the_lowest_id(spark, state):
    texts = spark.createDataFrame([("a",), ("bb",), ("a",)], "text string")
    assert as_set(crud.equal_texts(state, texts, "id", "text")) == {("a", 1)}


# --- evaluation -------------------------------------------------------------


def test_best_matching_against_all_permutations():
    rng = np.random.default_rng(5)
    for rows, columns in [(1, 1), (3, 3), (4, 6), (6, 4), (5, 5)]:
        gain = rng.integers(0, 50, (rows, columns))
        wide = gain if rows <= columns else gain.T
        best = max(
            sum(wide[i, c] for i, c in enumerate(chosen))
            for chosen in itertools.permutations(range(wide.shape[1]), wide.shape[0])
        )
        i, j = np.nonzero(gain)
        assert E.best_matching(i, j, gain[i, j]) == best


def test_best_matching_of_many_sparse_classes():
    rng = np.random.default_rng(6)
    for _ in range(30):
        cells = {(int(a), int(b)): int(g) for a, b, g in zip(rng.integers(0, 6, 12), rng.integers(0, 5, 12), rng.integers(1, 9, 12))}
        best = 0
        for chosen in itertools.permutations(range(6), 5):
            best = max(best, sum(cells.get((a, b), 0) for b, a in enumerate(chosen)))
        rows, columns = zip(*cells)
        assert E.best_matching(np.array(rows), np.array(columns), np.array(list(cells.values()))) == best
    # Classes as one block each, renamed, with some strays: more than any dense table would hold.
    n = 3000
    names = rng.permutation(n)
    rows, columns = np.append(np.arange(n), rng.integers(0, n, 4 * n)), np.append(names, rng.integers(0, n, 4 * n))
    gain = np.append(np.full(n, 1000), rng.integers(1, 5, 4 * n))
    table = {}
    for a, b, g in zip(rows.tolist(), columns.tolist(), gain.tolist()):
        table[a, b] = table.get((a, b), 0) + g
    own = sum(table[a, int(names[a])] for a in range(n))
    assert E.best_matching(*map(np.array, zip(*table)), np.array(list(table.values()))) == own


def test_purity_needs_no_limit_of_classes(spark):
    rows = spark.range(4000).select((F.col("id") % 2000).alias("label"), (F.col("id") % 2000 + 7).alias("cluster"))
    assert E.purity(rows, "label", "cluster") == 1
    assert E.purity(rows.limit(0), "label", "cluster") == 0
    odd = spark.createDataFrame([(1, 1), (1, None), (None, 2), (2, 1)], "label int, cluster int")
    assert E.purity(odd, "label", "cluster") == 0.25


def test_nearest_class_on_both_paths(table, monkeypatch):
    key = lambda df: sorted((r.id, r.label, r.cluster) for r in df.collect())
    few = key(E.nearest_class(table, "id", "label", "embedding"))
    monkeypatch.setattr(E, "CENTROIDS", 2)
    assert key(E.nearest_class(table, "id", "label", "embedding")) == few


@pytest.mark.parametrize("blocks", [{}, {"broadcast_cells": 8, "block_rows": 60}])
def test_silhouette_against_brute_force(table, points, blocks):
    data, own = points.astype(np.float64), np.arange(N) % 3
    distance = np.sqrt(((data[:, None] - data[None]) ** 2).sum(axis=2))
    found = {r.id: r.silhouette for r in E.silhouettes(table, "id", "embedding", "label", DIM, **blocks).collect()}
    for i in range(N):
        a = distance[i, own == own[i]].sum() / ((own == own[i]).sum() - 1)
        b = min(distance[i, own == c].mean() for c in range(3) if c != own[i])
        assert found[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)


def test_pca_has_the_leading_variances(table, points):
    z = (points - points.mean(axis=0)) / points.std(axis=0)
    leading = np.linalg.svd(z.astype(np.float64) - z.mean(axis=0), compute_uv=False)[:2] ** 2 / N
    rows = E.pca2(table, "id", "embedding").collect()
    found = [np.var([r.pc1 for r in rows]), np.var([r.pc2 for r in rows])]
    assert found == pytest.approx(leading, rel=1e-5)


def test_vectors_of_different_widths_raise():
    for rows in ([[1.0], [2.0, 3.0, 4.0]], [[1.0, 2.0], None, [3.0, 4.0, 5.0, 6.0]]):
        with pytest.raises(ValueError, match="one length"):
            to_matrix(pa.array(rows, pa.list_(pa.float64())))


# --- embeddings -------------------------------------------------------------


def test_encoder_failures_become_zero_vectors(spark):
    def load():
        def encode(texts):
            raise RuntimeError("model is away")

        return encode

    df = spark.createDataFrame([(1, "a"), (2, " ")], "id int, t string")
    with pytest.raises(Exception, match="model is away"):
        M.embed(df, "t", load).collect()
    filled = M.fill_failed(M.embed(df, "t", load, on_error="null"), "embedding", 4).collect()
    assert all(not r.valid and r.embedding == [0.0] * 4 for r in filled)
    texts = [r[0] for r in df.orderBy("id").select(M.text_or_default(F.col("t"))).collect()]
    assert texts == ["a", M.DEFAULT_TEXT]


def test_reconstruction_error_is_zero_with_all_components(table):
    rows = M.reconstruction_error(table, "id", "embedding", DIM).collect()
    assert len(rows) == N and max(r.error for r in rows) < 1e-9


def test_projection_repeats_and_hashed_is_unit(spark, table):
    first = M.project(table, "id", "embedding", DIM).orderBy("id").first()["embedding"]
    again = M.project(table, "id", "embedding", DIM).orderBy("id").first()["embedding"]
    assert first == again and len(first) == M.PROJECTION_DIM
    made = M.hashed_text(spark.createDataFrame([("a b a",), ("",)], ["t"]), "t", 16).collect()
    norms = [sum(x * x for x in r.embedding) for r in made]
    assert norms == pytest.approx([1.0, 0.0], abs=1e-6)


# --- streams ----------------------------------------------------------------


def test_bounded_ingest_stops_and_replays(spark, tmp_path):
    rows = [(i, "t", "10.0.0.1", "10.0.0.2", "TCP", "TCP", 1, 2, 60, "i") for i in range(30)]
    from flowvec.schemas import CAPTURE

    landed = str(tmp_path / "landed")
    spark.createDataFrame(rows, CAPTURE).repartition(3).write.parquet(landed)
    for _ in range(2):
        stream = I.read_capture_stream(spark, landed, files_per_trigger=1)
        query = I.ingest_bounded(stream, str(tmp_path / "out"), str(tmp_path / "state"), 25)
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25
    assert I.progress(query).columns == ["batch_id", "rows", "rows_per_second"]


# --- blocks of pairs --------------------------------------------------------


def best_of(found, n, k, ascending):
    q, r, value = found
    order = np.lexsort((r, value if ascending else -value, q))
    q, r, value = q[order], r[order], value[order]
    return [(r[q == i][:k].tolist(), value[q == i][:k]) for i in range(n)]


@pytest.mark.parametrize("metric", sorted(V.METRICS))
@pytest.mark.parametrize("farthest", [False, True])
def test_single_precision_ranks_like_double(metric, farthest):
    from flowvec.operators.pairwise import all_pairs, best_pairs

    rng = np.random.default_rng(5)
    ascending = V.METRICS[metric] != farthest
    made = {
        "plain": lambda n: rng.normal(size=(n, 12)),
        "far away": lambda n: rng.normal(size=(n, 12)) + 300,
        "tight": lambda n: rng.normal(size=(20, 12))[rng.integers(0, 20, n)] * 30 + rng.normal(size=(n, 12)) * 0.01,
        "copies": lambda n: rng.normal(size=(30, 12))[rng.integers(0, 30, n)],
        "zeros": lambda n: np.where(rng.random((n, 1)) < 0.3, 0, rng.normal(size=(n, 12))),
    }
    for name, make in made.items():
        queries, rows = make(60).astype(np.float32), make(1500).astype(np.float32)
        queries[:20] = rows[:20]
        got = best_of(best_pairs(metric, queries, rows, 5, ascending, 9), 60, 5, ascending)
        want = best_of(all_pairs(metric, queries.astype(float), rows.astype(float), 5, ascending, 9), 60, 5, ascending)
        # Products of large numbers have errors of their own in double precision.
        for (a, x), (b, y) in zip(got, want, strict=True):
            assert (a == b or name in ("far away", "tight")) and x == pytest.approx(y, rel=1e-9, abs=2e-8), name


def test_a_large_grid_has_few_blocks(table, monkeypatch):
    from flowvec.operators import pairwise

    sent, stream = [], pairwise.stream_cells

    def counted(sides, *rest):
        sent.append([side.count() for side in sides])
        return stream(sides, *rest)

    monkeypatch.setattr(pairwise, "stream_cells", counted, raising=False)
    # As many blocks as four parts of the rows, not as blocks of a fixed small number of rows.
    monkeypatch.setattr(pairwise, "BLOCK_ROWS", 10)
    queries, rows = sides(table)
    found = by_query(K.knn_join(queries, rows, 5, "l2", broadcast_cells=8))
    assert sent == [[4 * N, 4 * N]] and found == by_query(K.knn_join(queries, rows, 5, "l2"))


@pytest.mark.parametrize("cells", [8_000_000, 8])
def test_a_full_probe_has_no_row_for_each_list(table, monkeypatch, cells):
    sent, compare = [], ann.compare_blocks

    def counted(left, right, *rest, **more):
        sent.append(left.count())
        return compare(left, right, *rest, **more, broadcast_cells=cells, block_rows=100)

    monkeypatch.setattr(ann, "compare_blocks", counted)
    queries, rows = sides(table)
    index = ann.build_ivf(table, nlist=12)
    assert by_query(index.search(queries, 5, nprobe=index.lists)) == by_query(K.knn_join(queries, rows, 5, "l2"))
    assert sent == [N]


def test_hash_buckets_send_a_query_once_a_block(table, monkeypatch):
    sent, compare = [], ann.compare_blocks

    def counted(left, right, *rest, **more):
        sent.append(left.count())
        return compare(left, right, *rest, **more)

    monkeypatch.setattr(ann, "compare_blocks", counted)
    ann.build_lsh(table, tables=4, width=0.5).search(sides(table)[0], 5, max_queries=10)
    assert sent == [N]


def test_code_scores_are_not_held_for_all_pairs(table, monkeypatch):
    queries, _ = sides(table)
    index = ann.build_ivfpq(table, nlist=2, parts=4)
    whole = by_query(index.search(queries, 7))
    # Two queries at once.
    monkeypatch.setattr(ann, "CODE_CELLS", 2 * N)
    assert by_query(index.search(queries, 7)) == whole


def test_silhouettes_meet_two_blocks_once(table, monkeypatch):
    distances = E.distances
    data = np.random.default_rng(2).normal(size=(50, 8))
    near = np.concatenate([data, data + 1e-7]) + 1000
    from flowvec.operators.pairwise import plain_distances

    assert distances(near, near) == pytest.approx(plain_distances(near, near), rel=1e-9, abs=1e-12)
    whole = E.silhouettes(table, "id", "embedding", "label", DIM, broadcast_cells=8, block_rows=60)
    plain = E.silhouettes(table, "id", "embedding", "label", DIM)
    rows = lambda df: sorted((r.id, r.cluster, round(r.silhouette, 9)) for r in df.collect())
    assert rows(whole) == rows(plain)
    # Four blocks of a grid: six pairs of two blocks and four of one, not sixteen.
    copies = [side.count() for side in _grid_sides(table, monkeypatch)]
    assert copies[0] + copies[1] == 5 * N


def _grid_sides(table, monkeypatch):
    from flowvec.operators import pairwise

    found, stream = [], pairwise.stream_cells
    monkeypatch.setattr(pairwise, "stream_cells", lambda sides, *rest: found.extend(sides) or stream(sides, *rest), raising=False)
    monkeypatch.setattr(pairwise, "BLOCK_ROWS", 10)
    E.silhouettes(table, "id", "embedding", "label", DIM, broadcast_cells=8)
    return found


def test_trainings_take_sparse_points_in_several_partitions(spark, table, monkeypatch):
    from pyspark.ml.linalg import DenseVector, SparseVector

    thin = spark.createDataFrame([(i, [float(j == i % 9) for j in range(40)]) for i in range(90)], "id long, embedding array<float>").coalesce(1)
    forms = {type(r.features) for r in ann.training_points(thin, "id", "embedding").collect()}
    assert forms == {SparseVector}
    assert {type(r.features) for r in ann.training_points(table, "id", "embedding").collect()} == {DenseVector}
    parts = lambda: ann.training_points(thin, "id", "embedding").select(F.spark_partition_id()).distinct().count()
    assert parts() == 1
    monkeypatch.setattr(ann, "POINTS", 10)
    assert parts() > 1
    clusters = E.kmeans(thin, "id", "embedding", 9, restarts=4)
    assert clusters.groupBy("cluster").count().count() <= 9 and clusters.count() == 90
    assert all(len({c.cluster for c in clusters.where(f"id % 9 = {i}").collect()}) == 1 for i in range(2))
