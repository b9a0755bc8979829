"""The pruned join: exact under every metric, fewer pairs on clustered rows, never fewer than k hits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowvec.operators import ann, balls
from flowvec.operators import knn as K

DIM = 8


def frame(spark, vectors):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, embedding array<float>")


@pytest.fixture(scope="module")
def clustered():
    """Twelve far clusters, one of which holds a third of the rows as copies."""
    random = np.random.default_rng(7)
    centres = random.normal(size=(12, DIM)) * 20
    data = centres[random.integers(0, 12, 360)] + random.normal(size=(360, DIM))
    data[100:220] = data[100]
    return data.astype(np.float32)


def hits(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 7)) for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "l2_sq", "cosine", "cosine_distance", "ip", "ip_distance"])
@pytest.mark.parametrize("block_rows", [16])
def test_equal_to_all_pairs(spark, clustered, metric, block_rows):
    table = frame(spark, clustered)
    queries, rows = K.as_queries(table, "id", "embedding"), K.as_rows(table, "id", "embedding")
    space = balls.space_of(metric)
    centres = ann.train_centroids(rows, 40, "id", "v")
    asked = balls.place(queries.toDF("id", "v"), centres, space, block_rows)
    found = balls.ball_join(asked, balls.place(rows, centres, space, block_rows), 5, metric)
    assert hits(found.hits) == hits(K.knn_join(queries, rows, 5, metric))
    assert found.possible == 360 * 360
    if metric in ("l2", "l2_sq"):
        assert found.compared < 0.5 * found.possible


def test_pairs_compared_fall_with_the_spread_of_clusters(spark):
    random = np.random.default_rng(1)
    shares = []
    for spread in (0.0, 4.0, 40.0):
        data = random.normal(size=(10, DIM))[random.integers(0, 10, 300)] * spread + random.normal(size=(300, DIM))
        index = ann.build_ivf(frame(spark, data), nlist=10)
        found = index.bounded(K.as_queries(frame(spark, data), "id", "embedding"), 3)
        assert found.hits.count() == 900
        shares.append(found.compared / found.possible)
    assert shares[2] < 0.3 and shares[2] < shares[1] <= shares[0]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_at_the_default_on_two_sizes(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    queries = K.as_queries(rows.where("id % 50 = 0"), "id", "embedding")
    truth = K.knn_join(queries, K.as_rows(rows, "id", "embedding"), 10, "l2")
    found = ann.build_ivf(rows).search(queries, 10)
    assert ann.recall(truth, found).agg(F.min("recall")).first()[0] >= 0.9
    assert found.groupBy("query_id").count().agg(F.min("count")).first()[0] == 10


def test_few_lists_still_give_k_hits(spark, clustered):
    table = frame(spark, clustered)
    index = ann.build_ivf(table, nlist=60)
    found = index.search(K.as_queries(table, "id", "embedding"), 20, nprobe=1)
    assert found.groupBy("query_id").count().where("count < 20").count() == 0


def test_stored_blocks(spark, clustered, tmp_path):
    table = frame(spark, clustered)
    index = ann.build_ivf(table, nlist=12)
    index.write(str(tmp_path / "ivf"))
    stored = ann.read_ivf(spark, str(tmp_path / "ivf"))
    queries = K.as_queries(table.where("id in (3, 150)"), "id", "embedding")
    assert hits(stored.search(queries, 4)) == hits(index.search(queries, 4)) == hits(K.knn_join(queries, K.as_rows(table, "id", "embedding"), 4, "l2"))
    assert hits(stored.search(queries, 4, "cosine")) == hits(K.knn_join(queries, K.as_rows(table, "id", "embedding"), 4, "cosine"))


def test_rows_without_distances(spark):
    odd = [[1.0] * DIM, [0.0] * DIM, None, [1.0, 2.0], [float("nan")] * DIM, [2.0] * DIM, [-1.0] * DIM, [1.0] * DIM]
    table = frame(spark, odd)
    centres = np.eye(DIM)[:2]
    for metric, want in (("cosine", {0: [0, 5], 5: [0, 5], 6: [6, 0], 7: [0, 5]}), ("l2", {0: [0, 7], 1: [1, 0], 5: [5, 0], 6: [6, 1], 7: [0, 7]})):
        side = balls.place(table.select("id", F.col("embedding").alias("v")), centres, balls.space_of(metric))
        got = {}
        for q, _, i, _ in hits(balls.ball_join(side, side, 2, metric).hits):
            got.setdefault(q, []).append(i)
        assert got == want
    side = balls.place(table.select("id", F.col("embedding").alias("v")).limit(0), centres, "plain")
    assert balls.ball_join(side, side, 2, "l2").hits.collect() == []


def test_space_must_fit_the_metric(spark):
    side = balls.place(frame(spark, [[1.0] * DIM]).toDF("id", "v"), np.eye(DIM), "plain")
    with pytest.raises(ValueError):
        balls.ball_join(side, side, 1, "cosine")
    with pytest.raises(ValueError):
        balls.ball_join(side, side, 1, "nearest")


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_vectors_travel_once_a_shelf(spark, clustered, metric, monkeypatch):
    monkeypatch.setattr(balls, "BLOCK_ROWS", 60)
    monkeypatch.setattr(balls, "GRID_CELLS", 120 * DIM)
    sent, stream = [], balls.stream_cells

    def counted(sides, cells, *rest):
        sent.append((cells, sides[1].count(), sides[-1].count()))
        return stream(sides, cells, *rest)

    monkeypatch.setattr(balls, "stream_cells", counted)
    table = frame(spark, clustered)
    queries, rows = K.as_queries(table, "id", "embedding"), K.as_rows(table, "id", "embedding")
    side = balls.place(rows, ann.train_centroids(rows, 40, "id", "v"), balls.space_of(metric), 16)
    assert hits(balls.ball_join(side, side, 5, metric).hits) == hits(K.knn_join(queries, rows, 5, metric))
    # Some forty blocks on a side; four or five shelves of it at last.
    cells, mine, theirs = sent[1]
    assert cells > 1 and mine <= 6 * 360 and theirs <= 6 * 360
