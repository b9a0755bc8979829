"""Registered queries on keyed-table changes and traffic aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.functions import cleaning as C
from flowvec.functions import templates as TP
from flowvec.operators import analytics as A
from flowvec.operators import crud
from flowvec.operators import positions as P
from flowvec.operators import text as T
from flowvec.plans.registry import query
from flowvec.session import lookup_join, new_work_path
from flowvec.sources import flows as S
from flowvec.sources.tables import Tables
from flowvec.sources.versions import VersionedTable

STATE = "frame_number, ip_src, ip_dst, protocol, frame_len"
COLUMNS = STATE.split(", ")


def state(t: Tables) -> DataFrame:
    return t.flows.select(*COLUMNS)


def order_flows(t: Tables) -> DataFrame:
    """New rows in the layout of the state, one per order."""
    return t.orders.select(
        F.col("o_orderkey").alias("frame_number"),
        F.concat(F.lit("10.9.0."), (F.col("o_custkey") % 256)).alias("ip_src"),
        F.lit("172.20.0.99").alias("ip_dst"),
        F.lit("NEW").alias("protocol"),
        F.floor("o_totalprice").cast("int").alias("frame_len"),
    )


ORDER_FLOWS = """(select o_orderkey as frame_number, '10.9.0.' || (o_custkey % 256) as ip_src,
  '172.20.0.99' as ip_dst, 'NEW' as protocol, cast(floor(o_totalprice) as integer) as frame_len from orders)"""
LABEL_IDS = "(select doc_id from labels)"


def label_ids(t: Tables) -> DataFrame:
    return t.labels.select(F.col("doc_id").alias("frame_number"))


# --- changes ----------------------------------------------------------------


@query("crud_insert", f"""
select {STATE} from $flows union all
select (select max(frame_number) from $flows) + row_number() over (order by frame_number),
       ip_src, ip_dst, protocol, frame_len from {ORDER_FLOWS}""")
def _(t: Tables) -> DataFrame:
    return crud.insert(state(t), order_flows(t), "frame_number", "frame_number")


@query("crud_upsert", f"""
select {STATE} from $flows where frame_number not in (select frame_number from {ORDER_FLOWS})
union all select {STATE} from {ORDER_FLOWS}""")
def _(t: Tables) -> DataFrame:
    changes = crud.latest(order_flows(t), "frame_number", "frame_len")
    return crud.upsert(state(t), changes, "frame_number")


@query("crud_update_ids", """
select frame_number, ip_src, ip_dst, case when doc_id is null then protocol when toxic = 1 then 'TOXIC' else protocol end as protocol,
       coalesce(quality + 1000, frame_len) as frame_len
from $flows left join labels on doc_id = frame_number""")
def _(t: Tables) -> DataFrame:
    changes = t.labels.select(
        F.col("doc_id").alias("frame_number"),
        F.when(F.col("toxic") == 1, "TOXIC").alias("protocol"),
        (F.col("quality") + 1000).alias("frame_len"),
    )
    return crud.update_by_ids(state(t), changes, "frame_number")


@query("crud_replace_append", f"""
select {STATE} from $flows where frame_number not in {LABEL_IDS} union all
select (select max(frame_number) from $flows) + row_number() over (order by frame_number),
       ip_src, ip_dst, protocol, frame_len from {ORDER_FLOWS}""")
def _(t: Tables) -> DataFrame:
    return crud.replace_append(
        state(t), label_ids(t), order_flows(t), "frame_number", "frame_number"
    )


@query("crud_fifo_update", f"""
with placed as (select *, row_number() over (order by frame_number) as p from $flows)
select {STATE} from placed where p > 1000 union all
select (select max(frame_number) from $flows) + p, ip_src, ip_dst, 'UDP', frame_len from placed where p <= 1000""")
def _(t: Tables) -> DataFrame:
    return crud.fifo_update(state(t), 1000, "frame_number", {"protocol": F.lit("UDP")})


@query("crud_update_where", f"""
select frame_number, ip_src, ip_dst, protocol, case when protocol = 'TCP' then 1514 else frame_len end as frame_len,
       protocol = 'TCP' and frame_len <> 1514 as changed from $flows""")
def _(t: Tables) -> DataFrame:
    tcp, value = F.col("protocol") == "TCP", F.lit(1514)
    marked = state(t).withColumn("changed", crud.changes_where(tcp, "frame_len", value))
    return crud.update_where(marked, tcp, "frame_len", value)


@query("crud_delete_ids", f"select {STATE} from $flows where frame_number not in {LABEL_IDS}")
def _(t: Tables) -> DataFrame:
    unknown = label_ids(t).select((-1 - F.col("frame_number")).alias("frame_number"))
    return crud.delete_ids(state(t), label_ids(t).union(unknown), "frame_number")


@query("crud_delete_where", f"select {STATE} from $flows where dst_port is distinct from 443")
def _(t: Tables) -> DataFrame:
    # A missing port is not 443, so its row stays.
    return crud.delete_where(t.flows, F.col("dst_port") == 443).select(*COLUMNS)


@query("crud_delete_first_n", f"""
select {STATE} from $flows qualify row_number() over (order by frame_number) > 500""")
def _(t: Tables) -> DataFrame:
    return crud.delete_first(state(t), 500, "frame_number")


@query("crud_delete_sample", f"""
select {STATE} from $flows
qualify row_number() over (order by md5('cut' || frame_number), frame_number) > (select count(*) * 3 // 10 from events)""")
def _(t: Tables) -> DataFrame:
    rows = state(t)
    return crud.delete_sample(rows, rows.count() * 3 // 10, "frame_number", "cut")


def requested_matches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """State with texts, and the row that each requested text applies to.

    Requested are the texts of all UDP flows and of all orders; no row has one
    of the latter.  Only an equal text counts as a match, so equality is looked up.
    """
    rows = TP.serialize_flow(state(t), "comma3")
    wanted = state(t).where("protocol = 'UDP'").unionByName(order_flows(t))
    asked = TP.serialize_flow(wanted, "comma3").select("packet_text").distinct()
    return rows, crud.equal_texts(rows, asked, "frame_number", "packet_text")


MATCHED = "(select min(frame_number) from $flows where protocol = 'UDP' group by ip_src, ip_dst, protocol)"


@query("crud_delete_exact_match", f"select {STATE} from $flows where frame_number not in {MATCHED}")
def _(t: Tables) -> DataFrame:
    rows, matched = requested_matches(t)
    return crud.delete_ids(rows, matched, "frame_number").select(*COLUMNS)


@query("crud_update_exact_match", f"""
select frame_number, ip_src, ip_dst, case when frame_number in {MATCHED} then 'UPDATED' else protocol end as protocol, frame_len
from $flows""")
def _(t: Tables) -> DataFrame:
    rows, matched = requested_matches(t)
    changes = matched.select("frame_number", F.lit("UPDATED").alias("protocol"))
    return crud.update_by_ids(rows, changes, "frame_number").select(*COLUMNS)


@query("crud_count", "select count(*) as n from $flows")
def _(t: Tables) -> DataFrame:
    return t.flows.agg(F.count(F.lit(1)).alias("n"))


@query("crud_round_counts", f"""
with n as (select count(*) as n from $flows), m as (select count(*) as m from orders)
select 'insert all' as phase, n + m as rows from n, m union all
select 'delete sample', (n + m) - (n + m) * 3 // 10 from n, m union all
select 'update first', (n + m) - (n + m) * 3 // 10 from n, m union all
select 'delete all', 0 from n, m""")
def _(t: Tables) -> DataFrame:
    """Insert all, delete 30 %, update 20 % under fresh ids, delete all; rows after each.

    Each phase is a version of its own, counted while it is written, and the next
    one reads it.
    """
    stored = VersionedTable(t.spark, new_work_path(t.spark, "round"))
    first = stored.write(crud.insert(state(t), order_flows(t), "frame_number", "frame_number"))
    changes = {
        "delete sample": lambda table: crud.delete_sample(table, first.rows * 3 // 10, "frame_number"),
        "update first": lambda table: crud.fifo_update(table, first.rows // 5, "frame_number", {"protocol": F.lit("UDP")}),
        "delete all": lambda table: crud.delete_ids(table, table.select("frame_number"), "frame_number"),
    }
    phases, version = [("insert all", first.rows)], first
    for phase, change in changes.items():
        version = stored.write(change(version.table))
        phases.append((phase, version.rows))
    return t.spark.createDataFrame(phases, "phase string, rows long")


@query("crud_recreate", f"select {STATE} from {ORDER_FLOWS}")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "recreated")
    S.write_vector_table(state(t), path, "protocol")
    S.recreate_table(order_flows(t), path)
    return t.spark.read.parquet(path)


# --- batches and parts ------------------------------------------------------


@query("batch_rows", """
select frame_number, (row_number() over (order by frame_number) - 1) // 500 as batch from $flows""")
def _(t: Tables) -> DataFrame:
    return P.in_batches(t.flows.select("frame_number"), "frame_number", 500)


@query("split_ntile", "select frame_number, ntile(6) over (order by frame_number) as part from $flows")
def _(t: Tables) -> DataFrame:
    return P.in_parts(t.flows.select("frame_number"), "frame_number", 6)


SHUFFLED = """
with parts as (select frame_number, ip_src || ', ' || ip_dst || ', ' || protocol as packet_text,
                      ntile(6) over (order by frame_number) as part from $flows),
     slots as (select *, row_number() over (partition by part order by frame_number) as slot,
                      row_number() over (partition by part order by md5(cast(frame_number as varchar)), frame_number) as donor
               from parts)
select a.frame_number, a.part, b.packet_text as shuffled from slots a
join slots b on a.part = b.part and a.slot = b.donor"""


@query("shuffle_within_part", SHUFFLED)
def _(t: Tables) -> DataFrame:
    rows = TP.serialize_flow(t.flows, "comma3").select("frame_number", "packet_text")
    parts = P.in_parts(rows, "frame_number", 6)
    mixed = P.shuffle_in_parts(parts, "frame_number", "packet_text", "part")
    return mixed.select("frame_number", "part", "shuffled")


# --- aggregates -------------------------------------------------------------


@query("agg_protocol_count", "select protocol, count(*) as n from $flows group by protocol")
def _(t: Tables) -> DataFrame:
    return t.flows.groupBy("protocol").agg(F.count(F.lit(1)).alias("n"))


@query("agg_protocol_avg_len", """
select protocol, round(avg(cast(frame_len as integer)), 6) as avg_len from $raw_flows group by protocol""")
def _(t: Tables) -> DataFrame:
    mean = F.avg(F.col("frame_len").cast("int"))
    return t.raw_flows.groupBy("protocol").agg(F.round(mean, 6).alias("avg_len"))


def _top(name: str, column: str, k: int) -> None:
    query(
        name,
        f"select {column}, count(*) as n from $flows where {column} is not null "
        f"group by {column} order by n desc, {column} limit {k}",
    )(lambda t: A.top_values(t.flows, column, k))


_top("agg_top_sources", "ip_src", 10)
_top("agg_top_src_ip", "ip_src", 5)
_top("agg_top_src_port", "src_port", 5)
_top("agg_top_dst_port", "dst_port", 5)
_top("agg_top_protocol", "protocol", 5)


@query("agg_protocol_sets", """
select ip_src, ip_dst, string_agg(distinct protocol, ',' order by protocol) as protocols from $flows
group by ip_src, ip_dst order by ip_src, ip_dst limit 5""")
def _(t: Tables) -> DataFrame:
    sets = A.value_sets(t.flows, ["ip_src", "ip_dst"], "protocol", 5, "protocols")
    return sets.withColumn("protocols", F.array_join("protocols", ","))


@query("agg_text_protocol", """
select split_part(x, ' ', 3) as protocol, count(*) as n
from (select ip_src || ' ' || ip_dst || ' ' || protocol || ' ' || frame_len as x from $flows)
group by 1 order by n desc, protocol limit 10""")
def _(t: Tables) -> DataFrame:
    texts = TP.serialize_flow(t.flows, "space4").select("packet_text")
    return A.text_protocol_share(texts, "packet_text", 10)


@query("set_unique_ips", "select ip_src as ip from $flows union select ip_dst from $flows")
def _(t: Tables) -> DataFrame:
    return A.distinct_values(t.flows, ["ip_src", "ip_dst"], "ip")


@query("join_semi_vocab", """
with vocab as (select ip_src as token from $flows where protocol = 'TCP')
select frame_number, tok as token from (select frame_number, unnest([ip_src, ip_dst]) as tok from $flows)
where tok in (select token from vocab)""")
def _(t: Tables) -> DataFrame:
    sources = t.flows.where("protocol = 'TCP'").select(F.array("ip_src").alias("tokens"))
    known = T.vocabulary(sources, "tokens").select("token")
    tokens = t.flows.select("frame_number", F.explode(F.array("ip_src", "ip_dst")).alias("token"))
    return lookup_join(tokens, known, ["token"], "left_semi").select("frame_number", "token")
