"""Top documents by dot products of sparse term weights, with bounds on blocks of documents.

Documents lie in blocks of bounded size.  From the largest weight of a term in a
block follows how much any of its documents can score for a query, so a query
first visits its most promising block, and after that those only whose bound
reaches its ``k``-th best score so far.  A visit gives back ``k`` rows at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.functions import vectors as V
from flowvec.operators.knn import HIT_SCHEMA, best_hits, rank_hits
from flowvec.session import checkpoint, lookup_join

DOCS_PER_BLOCK = 1_024
# Slack of a bound: it is summed in another order than the scores.
SLACK = 1e-8


def _visit(visits: DataFrame, postings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each block for each query that visits it."""
    asked = visits.select(F.col("query_id"), F.col("block").alias("to")).join(queries, "query_id")
    held = postings.join(visits.select("block").distinct(), "block", "left_semi")

    def score(docs: pa.Table, terms: pa.Table) -> pa.Table:
        found = []
        if docs.num_rows and terms.num_rows:
            ids, place = np.unique(docs["id"].to_numpy(), return_inverse=True)
            # Postings in order of term: each term of a query is one run of them.
            both = pa.chunked_array([*docs["term"].chunks, *terms["term"].chunks]).combine_chunks().dictionary_encode()
            codes = both.indices.to_numpy(zero_copy_only=False)
            mine, theirs = codes[: docs.num_rows], codes[docs.num_rows :]
            order = np.argsort(mine, kind="stable")
            start = np.searchsorted(mine[order], np.arange(len(both.dictionary) + 1))
            place, weight = place[order], docs["weight"].to_numpy()[order]
            query_ids, q_weight = terms["query_id"].to_numpy(), terms["q_weight"].to_numpy()
            by_query = np.argsort(query_ids, kind="stable")
            names, begin = np.unique(query_ids[by_query], return_index=True)
            for query, mine in zip(names.tolist(), np.split(by_query, begin[1:]), strict=True):
                size = start[theirs[mine] + 1] - start[theirs[mine]]
                # The postings of all terms of the query, one run after the other.
                at = np.repeat(start[theirs[mine]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                total = np.bincount(place[at], weight[at] * np.repeat(q_weight[mine], size), len(ids))
                hit = np.flatnonzero(np.bincount(place[at], minlength=len(ids)))
                value = np.round(total[hit], V.TIE_DECIMALS)
                if len(hit) > 4 * k:
                    # Ties of the k-th best stay in, ids decide between them.
                    reach = np.partition(value, len(value) - k)[len(value) - k]
                    hit, value = hit[value >= reach], value[value >= reach]
                found.append(best_hits(np.full(len(hit), query), ids[hit], value, k, False))
        return pa.concat_tables(found) if found else best_hits([], [], [], k, False)

    return held.groupBy("block").cogroup(asked.groupBy("to")).applyInArrow(score, HIT_SCHEMA)


def sparse_search(docs: DataFrame, queries: DataFrame, k: int, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """Top-``k`` documents by dot product of ``term, weight`` rows: ``query_id, id, score, rank``.

    ``queries`` has ``query_id, term, q_weight``; ``docs`` has ``id, term, weight``.
    Documents without a term of the query are no hits.  Weights may be negative.
    """
    docs = checkpoint(docs.select(F.col("id").cast("long").alias("id"), "term", F.col("weight").cast("double").alias("weight")))
    queries = checkpoint(queries.select(F.col("query_id").cast("long").alias("query_id"), "term", F.col("q_weight").cast("double").alias("q_weight")))
    count = docs.agg(F.approx_count_distinct("id")).first()[0]
    blocks = max(1, -(-count // docs_per_block))
    postings = docs.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    reach = postings.groupBy("term", "block").agg(F.max("weight").alias("most"), F.min("weight").alias("least"))
    # What a term can add to a document of the block; a document without it adds nothing.
    best = F.greatest(F.col("most") * F.col("q_weight"), F.col("least") * F.col("q_weight"), F.lit(0.0))
    bounds = checkpoint(lookup_join(reach, queries, ["term"], "inner").groupBy("query_id", "block").agg(F.sum(best).alias("bound")))
    first = bounds.groupBy("query_id").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    early = checkpoint(rank_hits(_visit(first, postings, queries, k), k, "ip"))
    # Fewer than k hits leave everything open.
    reached = early.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("reached"))
    rest = bounds.join(first, ["query_id", "block"], "left_anti").join(reached, "query_id", "left")
    open_ = F.col("reached").isNull() | (F.col("bound") >= F.col("reached") - SLACK * (1 + F.abs("reached")))
    late = _visit(rest.where(open_), postings, queries, k)
    return rank_hits(early.drop("rank").unionByName(late), k, "ip")
