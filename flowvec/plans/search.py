"""Registered queries on vector arithmetic, search, hits and vector evaluation."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.functions import cleaning as C
from flowvec.functions import templates as TP
from flowvec.functions import vectors as V
from flowvec.operators import analytics as A
from flowvec.operators import ann
from flowvec.operators import crud
from flowvec.operators import embedding as M
from flowvec.operators import evaluation as E
from flowvec.operators import knn as K
from flowvec.operators import sparse as SP
from flowvec.plans.registry import query
from flowvec.session import checkpoint, lookup_join, new_work_path
from flowvec.sources.tables import Tables
from flowvec.sources.versions import VersionedTable

# The natural-language probe queries.
SEMANTIC_QUERIES = [
    "Find all TCP packets",
    "Show me packets from source IP 192.168.1.1",
    "Find large packets over 1000 bytes",
    "Show me UDP traffic to port 53",
    "Find all HTTPS packets",
    "Show me packets between 192.168.1.1 and 192.168.1.2",
    "Find small packets under 100 bytes",
]

PROBE = "(select v from $vectors order by id limit 1)"


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


def probe(t: Tables) -> list[float]:
    return K.first_vector(vectors(t), "id", "embedding")


def scored(hits: DataFrame, *columns: str) -> DataFrame:
    return hits.select(*columns, "id", "rank", F.round("score", 6).alias("score"))


# --- vector arithmetic ------------------------------------------------------


@query("vec_normalize", """
select id, i - 1 as i, round(v[i] * 3 / (3 * sqrt(list_inner_product(v, v))), 6) + 0.0 as x
from (select id, v, unnest(generate_series(1, len(v))) as i from $vectors)""")
def _(t: Tables) -> DataFrame:
    tripled = F.transform(V.doubles(F.col("embedding")), lambda x: x * 3)
    unit = vectors(t).select("id", V.normalize(tripled).alias("u"))
    return unit.select("id", F.posexplode("u").alias("i", "x")).withColumn(
        "x", F.round("x", 6) + 0.0
    )


@query("vec_norm", "select id, round(sqrt(list_inner_product(v, v)), 6) as norm from $vectors")
def _(t: Tables) -> DataFrame:
    return vectors(t).select("id", F.round(V.norm(F.col("embedding")), 6).alias("norm"))


def _against_probe(metric: str):
    def build(t: Tables) -> DataFrame:
        value = V.score(metric, F.col("embedding"), V.literal(probe(t)))
        return vectors(t).select("id", (F.round(value, 6) + 0.0).alias("score"))

    return build


for _name, _metric, _sql in (
    ("vec_dot", "ip", "list_inner_product(v, p)"),
    ("vec_cosine", "cosine", "list_cosine_similarity(v, p)"),
    ("vec_l2", "l2", "list_distance(v, p)"),
):
    query(
        _name,
        f"select id, round(round({_sql}, 9), 6) + 0.0 as score from $vectors, (select v as p from {PROBE})",
    )(_against_probe(_metric))


@query("vec_dim_check", """
select id, len(v) = 64 as fits, len(v[1:60]) = 64 as cut_fits from $vectors""")
def _(t: Tables) -> DataFrame:
    cut = F.slice("embedding", 1, 60)
    return vectors(t).select(
        "id", V.has_dim(F.col("embedding"), 64).alias("fits"), V.has_dim(cut, 64).alias("cut_fits")
    )


# --- exact search -----------------------------------------------------------

# metric -> (score in SQL, order)
SQL_SCORES = {
    "cosine": ("list_cosine_similarity(v, p)", "desc"),
    "cosine_distance": ("1 - list_cosine_similarity(v, p)", "asc"),
    "l2": ("list_distance(v, p)", "asc"),
    "ip": ("list_inner_product(v, p)", "desc"),
}


def nearest_sql(metric: str, k: int, rows: str = "$vectors", order: str = "") -> str:
    expression, direction = SQL_SCORES[metric]
    return f"""select id, row_number() over (order by s {order or direction}, id) as rank, round(s, 6) as score
from (select id, round({expression}, 9) as s from {rows}, (select v as p from {PROBE}))
qualify rank <= {k}"""


for _metric in ("cosine", "l2", "ip"):
    query(f"knn_{_metric}", nearest_sql(_metric, 10))(
        lambda t, metric=_metric: scored(K.knn(vectors(t), probe(t), 10, metric))
    )


@query("knn_farthest", nearest_sql("cosine_distance", 10, order="desc"))
def _(t: Tables) -> DataFrame:
    return scored(K.knn(vectors(t), probe(t), 10, "cosine_distance", farthest=True))


@query("knn_filtered", nearest_sql("cosine", 10, "(select * from $vectors where label in (3, 7))"))
def _(t: Tables) -> DataFrame:
    allowed = F.col("label").isin(3, 7)
    return scored(K.knn(vectors(t), probe(t), 10, "cosine", where=allowed))


@query("knn_metric_compare", " union all ".join(
    f"select *, '{m}' as metric from ({nearest_sql(m, 10)})" for m in ("l2", "ip", "cosine")))
def _(t: Tables) -> DataFrame:
    hits = K.compare_metrics(vectors(t), probe(t), 10, ("l2", "ip", "cosine"))
    return scored(hits, "metric")


def pairs_sql(metric: str, k: int, condition: str = "true") -> str:
    expression, direction = SQL_SCORES[metric]
    return f"""(select query_id, id, row_number() over (partition by query_id order by s {direction}, id) as rank, s
from (select a.id as query_id, b.id, round({expression.replace('(v, p)', '(b.v, a.v)')}, 9) as s
      from $vectors a, $vectors b where {condition}) qualify rank <= {k})"""


def self_join(t: Tables, k: int, metric: str) -> DataFrame:
    """Every vector against the whole table."""
    rows = vectors(t)
    return K.knn_join(
        K.as_queries(rows, "id", "embedding"), K.as_rows(rows, "id", "embedding"), k, metric
    )


@query("knn_join", f"select query_id, id, rank, round(s, 6) as score from {pairs_sql('cosine', 5)}")
def _(t: Tables) -> DataFrame:
    return scored(self_join(t, 5, "cosine"), "query_id")


@query("report_ranked_hits", f"""
select rank, h.id, round(score, 4) as score, cast(label as varchar) as text
from (select id, row_number() over (order by s desc, id) as rank, s as score
      from (select id, round(list_cosine_similarity(v, p), 9) as s from $vectors, (select v as p from {PROBE}))
      qualify rank <= 5) h join $vectors e on e.id = h.id""")
def _(t: Tables) -> DataFrame:
    rows = vectors(t)
    return K.report(K.knn(rows, probe(t), 5, "cosine"), rows, "id", "label")


def _half_pay(t: Tables) -> DataFrame:
    return vectors(t).where(F.col("label") < 5)


@query("join_hits_payload", f"""
select rank, h.id, round(score, 4) as score,
       coalesce(case when label < 5 then cast(label as varchar) end, 'Entry ' || h.id) as text
from (select id, row_number() over (order by s desc, id) as rank, s as score
      from (select id, round(list_cosine_similarity(v, p), 9) as s from $vectors, (select v as p from {PROBE}))
      qualify rank <= 50) h join $vectors e on e.id = h.id""")
def _(t: Tables) -> DataFrame:
    # Payload exists for some labels only; other hits show a placeholder.
    return K.report(K.knn(vectors(t), probe(t), 50, "cosine"), _half_pay(t), "id", "label")


VERSIONS_SQL = """
with inserted as (select id, v, label from $vectors union all
       select (select max(id) from $vectors) + row_number() over (order by id), list_reverse(v), label
       from $vectors where label = 1),
     deleted as (select * from inserted where label <> (select arg_min(label, id) from $vectors)),
     updated as (select id, case when label = 2 then list_reverse(v) else v end as v, label from deleted),
     versions as (select 'before' as phase, 1 as version, * from $vectors union all select 'insert', 2, * from inserted
       union all select 'delete', 3, * from deleted union all select 'update', 4, * from updated)"""
VERSION_HITS = f"""(select phase, id, row_number() over (partition by phase order by s desc, id) as rank, round(s, 6) as score
from (select phase, id, round(list_cosine_similarity(v, p), 9) as s from versions, (select v as p from {PROBE})) qualify rank <= 5)"""


def version_hits(t: Tables) -> DataFrame:
    """Insert, delete and update, each written as a version, counted meanwhile and searched by one scan."""
    stored = VersionedTable(t.spark, new_work_path(t.spark, "versions"))
    target = probe(t)
    version = stored.write(vectors(t))
    own = version.table.select(F.min_by("label", "id")).first()[0]
    turned = version.table.where("label = 1").withColumn("embedding", F.reverse("embedding"))
    changes = {
        "insert": lambda table: crud.insert(table, turned, "id", "id"),
        "delete": lambda table: crud.delete_where(table, F.col("label") == own),
        "update": lambda table: crud.update_where(table, F.col("label") == 2, "embedding", F.reverse("embedding")),
    }
    phases = {"before": version}
    for phase, change in changes.items():
        version = phases[phase] = stored.write(change(version.table))
    stacked = None
    for phase, version in phases.items():
        about = {"phase": F.lit(phase), "version": F.lit(version.number), "rows": F.lit(version.rows).cast("long")}
        part = K.knn(version.table, target, 5, "cosine").withColumns(about)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


@query("knn_across_versions", f"{VERSIONS_SQL} select phase, id, rank, score from {VERSION_HITS}")
def _(t: Tables) -> DataFrame:
    return scored(version_hits(t), "phase")


@query("crud_round_versions", f"""{VERSIONS_SQL}
select phase, version, rows, id, rank, score from {VERSION_HITS}
join (select phase, any_value(version) as version, count(*) as rows from versions group by phase) using (phase)""")
def _(t: Tables) -> DataFrame:
    return scored(version_hits(t), "phase", "version", "rows")


@query("semantic_search")
def _(t: Tables) -> DataFrame:
    """Natural-language probes against the sentences of all flows."""
    spark = t.spark
    flows = TP.serialize_flow(t.flow_texts, "sentence").select("frame_number", "packet_text")
    # A few fixed texts; the searched side is the table.
    asked = spark.createDataFrame(list(enumerate(SEMANTIC_QUERIES)), "query_id long, query string")
    queries = K.as_queries(M.hashed_text(asked, "query"), "query_id", "embedding")
    rows = K.as_rows(M.hashed_text(flows, "packet_text"), "frame_number", "embedding")
    hits = K.knn_join(queries, rows, 5, "cosine_distance", dim=M.HASH_DIM)
    texts = flows.withColumnRenamed("frame_number", "id")
    # At most five hits of each probe.
    found = texts.join(F.broadcast(hits), "id").join(F.broadcast(asked), "query_id")
    return found.select(
        "query",
        "rank",
        "id",
        F.round("score", 6).alias("distance"),
        F.round(V.similarity("cosine_distance", F.col("score")), 6).alias("similarity"),
        "packet_text",
    )


# --- approximate search -----------------------------------------------------


def _queries(t: Tables) -> DataFrame:
    return K.as_queries(vectors(t), "id", "embedding")


@query("ivf_build")
def _(t: Tables) -> DataFrame:
    index = ann.build_ivf(vectors(t))
    return index.rows.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))


@query("ivf_search_few_lists")
def _(t: Tables) -> DataFrame:
    """One list each, more only until they hold enough rows."""
    return scored(ann.build_ivf(vectors(t)).search(_queries(t), 5, "l2", nprobe=1), "query_id")


@query("knn_join_pruned", f"select query_id, id, rank, round(s, 6) as score from {pairs_sql('cosine', 5)}")
def _(t: Tables) -> DataFrame:
    """The exact join by balls: blocks that cannot hold a better hit never meet."""
    index = ann.build_ivf(vectors(t), space="unit")
    return scored(index.bounded(_queries(t), 5, "cosine").hits, "query_id")


@query("ivf_search_full_probe", f"select query_id, id, rank, round(s, 6) as score from {pairs_sql('l2', 5)}")
def _(t: Tables) -> DataFrame:
    index = ann.build_ivf(vectors(t))
    return scored(index.search(_queries(t), 5, "l2", nprobe=index.lists), "query_id")


@query("ivf_search", f"select query_id, id, rank, round(s, 6) as score from {pairs_sql('l2', 5)}")
def _(t: Tables) -> DataFrame:
    """Lists are read until no unread one can hold a better hit."""
    return scored(ann.build_ivf(vectors(t)).search(_queries(t), 5, "l2"), "query_id")


@query("ivfpq_search")
def _(t: Tables) -> DataFrame:
    return scored(ann.build_ivfpq(vectors(t)).search(_queries(t), 5), "query_id")


@query("lsh_search")
def _(t: Tables) -> DataFrame:
    return scored(ann.build_lsh(vectors(t)).search(_queries(t), 5), "query_id")


@query("index_compare")
def _(t: Tables) -> DataFrame:
    """Build and search time and recall of each index over the same queries."""
    rows, k = vectors(t), 5
    # Written once: no clock below runs the exact search again but its own.
    truth = checkpoint(self_join(t, k, "l2"))
    searches = {
        "flat": lambda: self_join(t, k, "l2"),
        "ivf_flat": lambda: ann.build_ivf(rows).search(_queries(t), k, "l2"),
        "ivf_pq": lambda: ann.build_ivfpq(rows).search(_queries(t), k),
        "lsh": lambda: ann.build_lsh(rows).search(_queries(t), k),
    }
    lines = []
    for method, search in searches.items():
        start = time.perf_counter()
        found = checkpoint(search())
        seconds = time.perf_counter() - start
        row = ann.recall(truth, found).agg(F.avg("recall"), F.count(F.lit(1))).first()
        lines.append((method, row[1], round(row[0], 6), seconds))
    return t.spark.createDataFrame(lines, "method string, queries long, recall double, seconds double")


# --- sparse search ----------------------------------------------------------


def term_weights(df: DataFrame, key: str, text: str) -> DataFrame:
    """Sparse weights of a text: the model output of a word is its length less four.

    Equal words have equal outputs here, so each is looked at once per text.
    """
    words = F.array_distinct(F.split(F.lower(text), r"\s+"))
    tokens = df.select(F.col(key).alias("id"), F.explode(words).alias("term"))
    outputs = tokens.select(
        "id",
        "term",
        (F.length("term") - 4).cast("double").alias("x"),
        F.when(F.col("term").endswith(","), 0).otherwise(1).alias("mask"),
    )
    return M.pool_sparse_max(outputs, "id", "term", "x", "mask")


def terms_sql(table: str, key: str) -> str:
    return f"""(select id, term, max(ln(1 + greatest(length(term) - 4, 0)) * case when term like '%,' then 0 else 1 end) as weight
from (select {key} as id, unnest(string_split_regex(lower(text), '\\s+')) as term from {table})
group by id, term having weight > 0)"""


@query("pool_sparse_max", f"select id, term, round(weight, 6) as weight from {terms_sql('documents', 'doc_id')}")
def _(t: Tables) -> DataFrame:
    weights = term_weights(t.documents, "doc_id", "text")
    return weights.withColumn("weight", F.round("weight", 6))


@query("sparse_search", f"""
select query_id, id, rank, round(s, 6) as score from (
  select q.id as query_id, d.id, round(sum(d.weight * q.weight), 9) as s,
         row_number() over (partition by q.id order by round(sum(d.weight * q.weight), 9) desc, d.id) as rank
  from {terms_sql('documents', 'doc_id')} d join {terms_sql('benchmark', 'item_id')} q using (term)
  group by q.id, d.id) where rank <= 10""")
def _(t: Tables) -> DataFrame:
    docs = term_weights(t.documents, "doc_id", "text")
    asked = term_weights(t.benchmark, "item_id", "text").select(
        F.col("id").alias("query_id"), "term", F.col("weight").alias("q_weight")
    )
    return scored(SP.sparse_search(docs, asked, 10), "query_id")


# --- hits and ports ---------------------------------------------------------

# A fixed probe flow: 192.168.1.1 to 192.168.1.2, ports 30000 and 80.
PROBE_FLOW = [3232235777 / 4294967296, 3232235778 / 4294967296, 30000 / 65535, 80 / 65535]
HITS = 100


def scaled_flow() -> Column:
    port = lambda c: F.coalesce(C.port_share(F.col(c)), F.lit(0.0))
    return F.array(
        C.ip_to_long(F.col("ip_src")) / 4294967296,
        C.ip_to_long(F.col("ip_dst")) / 4294967296,
        port("src_port"),
        port("dst_port"),
    )


def port_hits(t: Tables) -> DataFrame:
    """Nearest flows of the probe flow with their source port."""
    flows = t.flows.withColumn("embedding", scaled_flow())
    hits = K.knn(flows, PROBE_FLOW, HITS, "l2", "frame_number")
    found = hits.collect()  # HITS rows
    ports = t.flows.where(F.col("frame_number").isin([h["id"] for h in found]))
    local = t.spark.createDataFrame(found, hits.schema)
    return local.join(
        ports.select(F.col("frame_number").alias("id"), F.col("src_port").alias("port")), "id"
    )


def _ip(c: str) -> str:
    octets = [f"cast(split_part({c}, '.', {i}) as bigint)" for i in range(1, 5)]
    return f"({octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]})"


HITS_SQL = f"""(select frame_number as id, src_port as port, s,
  row_number() over (order by s, frame_number) as rank
from (select frame_number, src_port, round(list_distance(
    [{_ip('ip_src')} / 4294967296.0::double, {_ip('ip_dst')} / 4294967296.0::double,
     coalesce(src_port, 0) / 65535.0::double, coalesce(dst_port, 0) / 65535.0::double],
    [3232235777 / 4294967296.0::double, 3232235778 / 4294967296.0::double,
     30000 / 65535.0::double, 80 / 65535.0::double]), 9) as s from $flows) qualify rank <= {HITS})"""

RECURRENCE_SQL = """(select port, count(*) as frequency, avg(gap) as avg_distance, min(gap) as min_distance,
       max(gap) as max_distance, stddev_pop(gap) as std_distance, min(p) as first_position, max(p) as last_position
from (select src_port as port, p, p - lag(p) over (partition by src_port order by p) as gap
      from (select src_port, row_number() over (order by frame_number) - 1 as p from $flows)
      where src_port is not null)
group by port having count(*) > 1)"""


@query("agg_port_recurrence", f"""
select port, frequency, round(avg_distance, 6) as avg_distance, min_distance, max_distance,
       round(std_distance, 6) as std_distance, first_position, last_position from {RECURRENCE_SQL}""")
def _(t: Tables) -> DataFrame:
    stats = A.port_recurrence(t.flows, "src_port", "frame_number")
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("avg_distance", "std_distance")}
    )


@query("probe_strata", f"""
select case when frequency < 10 then 'low' when frequency < 50 then 'mid' else 'high' end as stratum,
       arg_min(port, row(-frequency, port)) as port, max(frequency) as frequency
from (select ip_dst as port, count(*) as frequency from $flows group by 1 having count(*) > 1 union all
      select cast(src_port as varchar), count(*) from $flows group by 1 having count(*) > 1 and min(src_port) is not null)
group by 1""")
def _(t: Tables) -> DataFrame:
    # Ports are rare values here and addresses frequent ones: strata over both.
    address = A.port_recurrence(t.flows, "ip_dst", "frame_number")
    port = A.port_recurrence(t.flows.withColumn("src_port", F.col("src_port").cast("string")), "src_port", "frame_number")
    return A.frequency_strata(address.unionByName(port))


PROBE_PORTS = "(select src_port as port, count(*) as n from $flows where src_port is not null group by 1 order by n desc, port limit 5)"
FLOW_VECTORS = f"""(select frame_number as id, src_port as port,
  [{_ip('ip_src')} / 4294967296.0::double, {_ip('ip_dst')} / 4294967296.0::double,
   coalesce(src_port, 0) / 65535.0::double, coalesce(dst_port, 0) / 65535.0::double] as v from $flows)"""


@query("probe_ports_metrics", f"""
with probes as (select port, arg_min(v, id) as p from {FLOW_VECTORS} where port in (select port from {PROBE_PORTS}) group by port),
     scores as (select port, id, round(list_distance(v, p), 9) as l2, round(list_inner_product(v, p), 9) as ip,
                       round(list_cosine_similarity(v, p), 9) as cosine from (select id, v from {FLOW_VECTORS}), probes),
     ranked as (select port, 'l2' as metric, id, row_number() over (partition by port order by l2, id) as rank, l2 as s from scores
       union all select port, 'ip', id, row_number() over (partition by port order by ip desc, id), ip from scores
       union all select port, 'cosine', id, row_number() over (partition by port order by cosine desc, id), cosine from scores)
select port, metric, id, rank, round(s, 6) as score from ranked where rank <= 5""")
def _(t: Tables) -> DataFrame:
    """The first flow of each of the five most frequent ports as probe, under three metrics."""
    flows = t.flows.select("frame_number", "src_port", scaled_flow().alias("embedding"))
    ports = A.top_values(t.flows, "src_port", 5).select("src_port")
    # Five ports.
    probes = flows.join(F.broadcast(ports), "src_port").groupBy("src_port").agg(F.min_by("embedding", "frame_number").alias("embedding"))
    hits = K.metrics_join(
        K.as_queries(probes, "src_port", "embedding"), K.as_rows(flows, "frame_number", "embedding"), 5, ("l2", "ip", "cosine"), 4
    )
    return scored(hits.withColumn("port", F.col("query_id").cast("int")), "port", "metric")


@query("join_hits_port_stats", f"""
select rank, h.port, round(s, 6) as score, frequency, round(avg_distance, 6) as avg_distance,
       frequency is not null as found
from {HITS_SQL} h left join {RECURRENCE_SQL} r on r.port = h.port""")
def _(t: Tables) -> DataFrame:
    stats = A.port_recurrence(t.flows, "src_port", "frame_number")
    return A.hit_port_stats(port_hits(t), stats).select(
        "rank", "port", F.round("score", 6).alias("score"), "frequency",
        F.round("avg_distance", 6).alias("avg_distance"), "found",
    )


@query("join_min_row_gap", f"""
with pos as (select src_port as port, row_number() over (order by frame_number) - 1 as p from $flows),
     known as (select rank, port from {HITS_SQL} where port in (select port from {RECURRENCE_SQL})),
     pairs as (select rank, port, lag(port) over (order by rank) as prev_port from known)
select rank, pairs.port, prev_port, min(abs(a.p - b.p)) as min_row_gap
from pairs join pos a on a.port = pairs.port join pos b on b.port = prev_port
group by all""")
def _(t: Tables) -> DataFrame:
    stats = A.port_recurrence(t.flows, "src_port", "frame_number").select("port")
    known = port_hits(t).select("rank", "port").join(stats, "port", "left_semi")
    return A.consecutive_hit_gaps(known, t.flows, "src_port", "frame_number")


@query("agg_distance_by_rank", f"""
select rank, round(avg(s), 6) as avg_distance from (
  select *, count(*) over (partition by query_id) as n from {pairs_sql('cosine_distance', 5, 'a.label = b.label')})
where n = 5 group by rank""")
def _(t: Tables) -> DataFrame:
    hits = same_label_join(t, 5, "cosine_distance")
    return A.distance_by_rank(hits, 5).withColumn("avg_distance", F.round("avg_distance", 6))


def same_label_join(t: Tables, k: int, metric: str) -> DataFrame:
    """Every vector against the vectors of its label."""
    rows = vectors(t)
    return K.knn_join(
        K.as_queries(rows, "id", "embedding", "label"),
        K.as_rows(rows, "id", "embedding", "label"),
        k, metric, on=("label",),
    )


@query("agg_weighted_parts", f"""
select round(avg(s), 6) as avg_distance, rank from {pairs_sql('cosine_distance', 5, 'a.label = b.label')} group by rank""")
def _(t: Tables) -> DataFrame:
    """Means of the parts of a result, a part per label, merged by their sizes."""
    labels = vectors(t).select(F.col("id").alias("query_id"), "label")
    hits = same_label_join(t, 5, "cosine_distance").join(labels, "query_id")
    parts = hits.groupBy("label", "rank").agg(F.avg("score").alias("avg_distance"), F.count(F.lit(1)).alias("n"))
    return A.weighted_parts(parts, "avg_distance", "n", ["rank"]).withColumn("avg_distance", F.round("avg_distance", 6))


@query("agg_distance_summary", f"""
select round(avg(s), 6) as avg_distance, round(min(s), 6) as min_distance, round(max(s), 6) as max_distance
from {pairs_sql('cosine_distance', 5)}""")
def _(t: Tables) -> DataFrame:
    summary = A.score_summary(self_join(t, 5, "cosine_distance"))
    return summary.select(*[F.round(c, 6).alias(c) for c in summary.columns])


@query("agg_query_similarity", f"""
select query_id, round(avg(1 - s), 6) as similarity, count(*) as hits
from {pairs_sql('cosine_distance', 5)} group by query_id""")
def _(t: Tables) -> DataFrame:
    per_query = A.query_similarity(self_join(t, 5, "cosine_distance"))
    return per_query.withColumn("similarity", F.round("similarity", 6))


# --- evaluation -------------------------------------------------------------


@query("eval_recall", f"""
select t.query_id, count(f.id) / 5.0::double as recall from {pairs_sql('l2', 5)} t
left join {pairs_sql('l2', 5, 'a.label = b.label')} f on f.query_id = t.query_id and f.id = t.id
group by t.query_id""")
def _(t: Tables) -> DataFrame:
    return ann.recall(self_join(t, 5, "l2"), same_label_join(t, 5, "l2"))


@query("eval_recall_times", f"""
select e.event_type as method, count(*) as queries, round(avg(r.recall), 6) as avg_recall, round(avg(e.value), 6) as avg_seconds
from (select t.query_id, count(f.id) / 5.0::double as recall from {pairs_sql('l2', 5)} t
      left join {pairs_sql('l2', 5, 'a.label = b.label')} f on f.query_id = t.query_id and f.id = t.id group by t.query_id) r
join events e on e.event_id = r.query_id group by e.event_type""")
def _(t: Tables) -> DataFrame:
    """Mean recall beside mean time; the events stand for the log of the searches."""
    recall = ann.recall(self_join(t, 5, "l2"), same_label_join(t, 5, "l2"))
    timed = t.events.select(F.col("event_id").alias("query_id"), F.col("event_type").alias("method"), F.col("value").alias("seconds"))
    joined = lookup_join(timed, recall, ["query_id"], "inner")
    return joined.groupBy("method").agg(
        F.count(F.lit(1)).alias("queries"), F.round(F.avg("recall"), 6).alias("avg_recall"), F.round(F.avg("seconds"), 6).alias("avg_seconds")
    )


@query("eval_kmeans")
def _(t: Tables) -> DataFrame:
    found = E.kmeans(vectors(t), "id", "embedding", 10)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("eval_contingency", """
with centers as (select label as cluster, list(x order by i) as c from (
       select label, i, avg(v[i]) as x from (select label, v, unnest(generate_series(1, len(v))) as i from $vectors)
       group by label, i) group by label)
select label, cluster, count(*) as n from (
  select id, label, cluster, row_number() over (partition by id order by round(list_distance(v, c), 9), cluster) as r
  from $vectors, centers) where r = 1 group by label, cluster""")
def _(t: Tables) -> DataFrame:
    return E.contingency(E.nearest_class(vectors(t), "id", "label", "embedding"), "label", "cluster")


@query("eval_purity")
def _(t: Tables) -> DataFrame:
    rows = vectors(t)
    clusters = E.kmeans(rows, "id", "embedding", 10)
    labelled = rows.select("id", "label").join(clusters, "id")
    value = E.purity(labelled, "label", "cluster")
    return labelled.agg(F.count(F.lit(1)).alias("n"), F.lit(value).alias("purity"))


@query("eval_silhouette", """
with sums as (select a.id, a.label as own, b.label as other, sum(list_distance(a.v, b.v)) as total, count(*) as n
              from $vectors a, $vectors b group by all),
     ab as (select id, own, max(case when own = other and n > 1 then total / (n - 1) end) as a,
                   min(case when own <> other then total / n end) as b from sums group by id, own)
select id, own as cluster, round(case when a is null then 0 else (b - a) / greatest(a, b) end, 6) as silhouette from ab""")
def _(t: Tables) -> DataFrame:
    points = E.silhouettes(vectors(t), "id", "embedding", "label", 64)
    return points.select("id", "cluster", F.round("silhouette", 6).alias("silhouette"))


@query("eval_silhouette_sq", """
with sums as (select a.id, a.label as own, b.label as other, sum(list_distance(a.v, b.v) ** 2) as total, count(*) as n
              from $vectors a, $vectors b group by all),
     ab as (select id, own, max(case when own = other and n > 1 then total / (n - 1) end) as a,
                   min(case when own <> other then total / n end) as b from sums group by id, own)
select count(*) as n, round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 5) as silhouette from ab""")
def _(t: Tables) -> DataFrame:
    """The mean silhouette under squared distances, from sums per class: linear in the rows."""
    rows = vectors(t)
    value = E.silhouette_sq(rows, "embedding", "label")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.lit(round(value, 5)).alias("silhouette"))


@query("eval_pca2")
def _(t: Tables) -> DataFrame:
    return E.pca2(vectors(t), "id", "embedding")
