"""Keyed stream tables, versions, batch logs, as-of joins, neighbour vectors, sparse search, several metrics at once."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowvec.operators import asof, sparse
from flowvec.operators import cooccurrence as CO
from flowvec.operators import knn as K
from flowvec.sources import files
from flowvec.sources.versions import VersionedTable
from flowvec.streaming.keyed import KeyedTable
from flowvec.streaming.progress import BatchLog, read_progress

# --- keyed stream tables ----------------------------------------------------


def test_keyed_table_holds_the_last_change_of_each_key(spark, tmp_path):
    random = np.random.default_rng(2)
    table = KeyedTable(spark, str(tmp_path / "t"), "k", "o", compact_every=3, rows_per_range=12)
    want = {}
    for batch in range(11):
        rows = [(int(k), batch, f"{batch}-{i}") for i, k in enumerate(random.integers(0, 60, 15))]
        frame = spark.createDataFrame([*rows, (None, 0, "x")], "k long, o long, v string")
        table.append(frame, batch)
        table.append(frame, batch)  # a replay
        want.update({k: batch for k, _, _ in rows})
        manifest = table.manifest()
        assert len(manifest["changes"]) < 3 and manifest["batch"] == batch
        assert {r.k: int(r.v.split("-")[0]) for r in table.read().collect()} == want
    table.compact()
    manifest = table.manifest()
    assert manifest["changes"] == [] and len(manifest["ranges"]) >= 4
    lows = [r["low"] for r in manifest["ranges"]]
    assert lows[0] is None and lows[1:] == sorted(lows[1:])
    assert table.read().groupBy("k").count().where("count > 1").count() == 0


def test_untouched_ranges_stay_the_files_they_are(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", "o", compact_every=1, rows_per_range=20)
    table.append(spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("o"), F.lit("a").alias("v")), 0)
    before = {r["low"]: r["path"] for r in table.manifest()["ranges"]}
    old = table.read()
    table.append(spark.createDataFrame([(3, 1, "b"), (500, 1, "b")], "k long, o int, v string"), 1)
    after = {r["low"]: r["path"] for r in table.manifest()["ranges"]}
    same = [low for low in before if before[low] == after.get(low)]
    assert len(before) >= 4 and len(same) == len(before) - 2
    assert table.read().count() == 101 and table.read().where("v = 'b'").count() == 2
    # A reader of the version before is not disturbed.
    assert old.count() == 100 and old.where("v = 'b'").count() == 0


def test_an_empty_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", "o", compact_every=1)
    with pytest.raises(FileNotFoundError):
        table.read()
    nothing = spark.createDataFrame([], "k long, o long, v string")
    table.append(nothing, 0)
    assert table.read().collect() == [] and table.read().columns == ["k", "o", "v"]


def test_files_are_put_in_place_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    files.write_text(spark, path, "eins ü")
    assert files.read_text(spark, path) == "eins ü" and files.names(spark, f"{tmp_path}/a")[-1] == "b.json"
    with pytest.raises(FileExistsError):
        files.write_text(spark, path, "zwei")
    assert files.names(spark, f"{tmp_path}/none") == []


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"))
    first = table.write(spark.range(5))
    second = table.write(first.table.where("id > 1"))
    assert (first.number, first.rows, second.number, second.rows) == (1, 5, 2, 3)
    assert table.read().number == 2 and table.read(1).table.count() == 5
    with pytest.raises(LookupError):
        table.read(7)


def test_batch_log_counts_a_batch_once(spark, tmp_path):
    class Event:
        def __init__(self, run, batch, rows, when):
            self.progress = type("P", (), {"id": "q", "runId": run, "batchId": batch, "numInputRows": rows, "observedMetrics": {}, "processedRowsPerSecond": 2.0, "timestamp": when})

    log = BatchLog(spark, str(tmp_path / "log"))
    for event in (Event("a", 0, 5, "1"), Event("a", 1, 7, "2"), Event("b", 1, 9, "3"), Event("b", 1, 0, "4"), Event("b", 2, 6, "5")):
        log.onQueryProgress(event)
    got = [(r.batch_id, r.rows, r.rows_so_far, r.percent) for r in read_progress(spark, str(tmp_path / "log"), 40).orderBy("batch_id").collect()]
    assert got == [(0, 5, 5, 12.5), (1, 9, 14, 35.0), (2, 6, 20, 50.0)]


# --- as-of joins ------------------------------------------------------------


@pytest.mark.parametrize("rows_per_bucket", [7, 500_000])
def test_as_of_and_span_resources(spark, rows_per_bucket):
    random = np.random.default_rng(4)
    series = ["hot"] * 60 + ["a", "b", None] * 8
    samples = [(series[i], float(t), float(c), int(m)) for i, (t, c, m) in enumerate(zip(random.integers(0, 40, 84), random.random(84), random.integers(0, 99, 84)))]
    spans = [(i, series[i], float(s), float(s + d)) for i, (s, d) in enumerate(zip(random.integers(-3, 42, 84), random.integers(0, 9, 84)))]
    spans += [(100, "nobody", 1.0, 2.0), (101, "hot", None, 3.0)]
    left = spark.createDataFrame(spans, "id long, s string, start double, end double")
    right = spark.createDataFrame(samples, "s string, t double, cpu double, memory long")

    def last(name, at, strict=False):
        found = [(t, m) for s, t, _, m in samples if s == name and s is not None and at is not None and (t < at or (t == at and not strict))]
        return max(found)[1] if found else None

    for strict in (False, True):
        got = {r.id: r.memory for r in asof.as_of(left, right, "s", "start", "t", ["memory"], strict, rows_per_bucket).collect()}
        assert got == {i: last(s, a, strict) for i, s, a, _ in spans}
    got = {r.id: r for r in asof.span_resources(left.where("start is not null"), right, "s", "start", "end", "t", "cpu", "memory", rows_per_bucket).collect()}
    for i, s, a, b in spans:
        if a is None:
            continue
        inside = [c for n, t, c, _ in samples if n == s and s is not None and a <= t <= b]
        assert got[i].samples == len(inside)
        assert math.isclose(got[i].cpu_mean, sum(inside) / len(inside) if inside else 0, abs_tol=1e-9)
        known = last(s, a), last(s, b)
        assert got[i].memory_delta == (known[1] - known[0] if None not in known else 0)


@pytest.mark.parametrize("rows_per_bucket", [500_000, 20])
def test_spans_pass_the_samples_in_one_small_plan(spark, rows_per_bucket):
    rng = np.random.default_rng(4)
    # Half of the spans begin at one time, which is also that of a sample; some have no series or no time.
    spans = [(i, None if i % 17 == 0 else "ab"[i % 2], None if i % 19 == 0 else 50.0 if i % 2 else float(rng.integers(0, 100)), float(rng.integers(0, 9))) for i in range(120)]
    spans = [(i, s, t, None if t is None else t + d) for i, s, t, d in spans]
    samples = [("ab"[i % 2], float(i // 2), float(rng.integers(0, 50)), int(rng.integers(0, 1000))) for i in range(200)] + [("b", 50.0, 7.0, 5000)]
    left = spark.createDataFrame(spans, "id long, s string, start double, end double")
    right = spark.createDataFrame(samples, "s string, t double, cpu double, memory long")
    found = asof.span_resources(left, right, "s", "start", "end", "t", "cpu", "memory", rows_per_bucket)
    # Of old each step of four stood in the plan of the next one several times.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") < 40
    got = {r.id: r for r in found.collect()}
    assert len(got) == 120
    for i, series, start, end in spans:
        mine = [x for x in samples if x[0] == series and start is not None]
        inside = [c for _, t, c, _ in mine if start <= t <= end]
        at = lambda limit: max(((t, m) for _, t, _, m in mine if t <= limit), default=None)
        delta = at(end)[1] - at(start)[1] if mine and at(start) else 0
        assert (got[i].samples, got[i].cpu_mean, got[i].memory_delta) == (len(inside), pytest.approx(np.mean(inside) if inside else 0), delta)


def test_cpu_share_of_an_idle_run(spark):
    rows = spark.createDataFrame([(0.0, 0.5)], "seconds double, cpu_mean double")
    assert asof.cpu_share(rows, "seconds").first()["cpu_share"] == 0


# --- vectors from neighbours ------------------------------------------------


def test_neighbours_within_the_window(spark):
    rows = spark.createDataFrame([(["a", "b", "a", None, "c"],), (["x"],), ([],), (None,)], "t array<string>")
    got = {(r.token, r.context): r.n for r in CO.neighbours(rows, "t", 2).collect()}
    tokens, want = ["a", "b", "a", "c"], Counter()
    for i, j in ((i, j) for i in range(4) for j in range(4) if i != j and abs(i - j) <= 2):
        want[tokens[i], tokens[j]] += 1
    assert got == dict(want)


def test_tokens_in_like_places_get_like_vectors(spark):
    random = np.random.default_rng(0)
    rows = [[str(random.choice(["cat", "dog"])), str(random.choice(["eats", "sleeps"])), "home"] for _ in range(150)]
    rows += [[str(random.choice(["tcp", "udp"])), str(random.choice(["port", "packet"])), "wire"] for _ in range(150)]
    found = CO.token_vectors(spark.createDataFrame([(r,) for r in rows], "t array<string>"), "t")
    v = {r.token: np.array(r.vector) for r in found.collect()}
    cosine = lambda a, b: float(v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]))
    assert all(len(x) == 128 for x in v.values())
    assert cosine("cat", "dog") > 0.8 and cosine("tcp", "udp") > 0.8 and abs(cosine("cat", "tcp")) < 0.4
    assert CO.token_vectors(spark.createDataFrame([], "t array<string>"), "t").collect() == []
    with pytest.raises(ValueError):
        CO.token_vectors(found, "token", cells=129)


# --- sparse search ----------------------------------------------------------


@pytest.mark.parametrize("docs_per_block", [3, 4096])
def test_sparse_search_equals_all_products(spark, docs_per_block):
    random = np.random.default_rng(8)
    docs = {(int(d), f"t{int(random.zipf(1.5)) % 30}"): float(np.round(random.normal() if d % 5 == 0 else random.random(), 3)) for d in np.repeat(np.arange(60), 8)}
    asked = {(int(q), f"t{int(random.integers(0, 30))}"): float(np.round(random.random() + 0.1, 3)) for q in np.repeat(np.arange(6), 5)}
    left = spark.createDataFrame([(d, t, w) for (d, t), w in docs.items()], "id long, term string, weight double")
    right = spark.createDataFrame([(q, t, w) for (q, t), w in asked.items()], "query_id long, term string, q_weight double")
    got = {}
    for r in sparse.sparse_search(left, right, 4, docs_per_block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 6)))
    for q in range(6):
        totals = Counter()
        for (d, t), w in docs.items():
            if (q, t) in asked:
                totals[d] += w * asked[q, t]
        best = sorted(totals.items(), key=lambda x: (-round(x[1], 9), x[0]))[:4]
        assert got.get(q, []) == [(d, round(s, 6)) for d, s in best]
    assert sparse.sparse_search(left.limit(0), right, 4).collect() == []


# --- several metrics --------------------------------------------------------


def test_metrics_join_scans_once(spark):
    random = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(random.normal(size=(80, 4)))], "id long, embedding array<double>")
    queries = K.as_queries(rows.where("id < 3"), "id", "embedding")
    metrics = ("l2", "ip", "cosine")
    found = K.metrics_join(queries, K.as_rows(rows, "id", "embedding"), 6, metrics, 4)
    for metric in metrics:
        alone = K.knn_join(queries, K.as_rows(rows, "id", "embedding"), 6, metric)
        key = lambda r: (r.query_id, r["rank"], r.id, r.score)
        assert sorted(map(key, found.where(F.col("metric") == metric).collect())) == sorted(map(key, alone.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    with pytest.raises(ValueError):
        K.metrics_join(queries, rows, 1, ("nearest",), 4)
