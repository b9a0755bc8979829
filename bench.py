"""Headline timings as one JSON line: batch search, bulk changes, analytics, texts.

Each query is run once to warm up and then timed with a no-op sink, so every
row is computed.  ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (a
comma-separated choice) steer the run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from flowvec import plans

HEADLINE = [
    # batch and single search
    "knn_join", "knn_cosine", "knn_farthest", "ivf_search", "lsh_search", "sparse_search",
    # bulk changes
    "crud_insert", "crud_upsert", "crud_update_ids", "crud_delete_ids", "crud_delete_where",
    "crud_fifo_update",
    # traffic
    "agg_protocol_count", "agg_top_sources", "agg_port_recurrence", "clean_dedup_flows",
    # texts and embeddings
    "text_sentence", "chunk_words", "tok_vocab_count", "embed_hashing", "semantic_search",
    # evaluation and logs
    "eval_recall", "bench_throughput",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowvec-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    seconds = {}
    for name in chosen:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 4)

    def rows(table: str) -> int:
        return spark.read.parquet(f"{folder}/{table}.parquet").count()

    flows, vectors = rows("events"), rows("embeddings")
    # Rows that a change touches, not those of the table it changes.
    changed = {
        "crud_upsert": rows("orders"),
        "crud_update_ids": rows("labels"),
        "crud_delete_ids": rows("labels"),
        "embed_hashing": flows,
    }
    rates = {}
    if "knn_join" in seconds:
        rates["knn_join_queries_per_s"] = round(vectors / seconds["knn_join"], 1)
    for name, n in changed.items():
        if name in seconds:
            rates[f"{name}_rows_per_s"] = round(n / seconds[name], 1)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
