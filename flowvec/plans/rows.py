"""Registered queries on sources, cleaning, row features and row texts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec import schemas
from flowvec.functions import cleaning as C
from flowvec.functions import templates as TP
from flowvec.functions import vectors as V
from flowvec.operators import analytics as A
from flowvec.operators import crud
from flowvec.operators import text as T
from flowvec.plans.registry import query
from flowvec.session import new_work_path
from flowvec.sources import flows as S
from flowvec.sources import synthetic as G
from flowvec.sources.tables import Tables

RAW = "frame_number, frame_time, ip_src, ip_dst, src_port, dst_port, protocol, frame_len"


# --- sources and sinks ------------------------------------------------------


@query("src_flow_csv", f"""
select frame_number, frame_time, ip_src, ip_dst, nullif(src_port, '') as src_port,
       dst_port, protocol, frame_len from $raw_flows""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "flow-csv")
    S.write_flows(t.raw_flows, path)
    # The blank and the missing cell are the same thing in a CSV file.
    return S.read_flows(t.spark, path).withColumn(
        "src_port", F.nullif(F.col("src_port"), F.lit(""))
    )


@query("src_packet_csv", """
select strftime(frame_time, '%Y-%m-%d %H:%M:%S') as timestamp, ip_src as src_ip,
       ip_dst as dst_ip, protocol, frame_len as size from $flows""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "packet-csv")
    packets = t.flow_texts.select("frame_time", "ip_src", "ip_dst", "protocol", "frame_len")
    packets.write.mode("overwrite").csv(path, header=False)
    return S.read_packets(t.spark, path)


@query("src_first_n", "select frame_number, ip_src, ip_dst, protocol from $flows order by frame_number limit 1000")
def _(t: Tables) -> DataFrame:
    return S.first_rows(t.flows.select("frame_number", "ip_src", "ip_dst", "protocol"), 1000, "frame_number")


def captures(t: Tables) -> DataFrame:
    """Decoded capture records: ICMP stands for packets without addresses."""
    transport = F.when(F.col("protocol").isin("TCP", "TLSv1.2"), "TCP").when(
        F.col("protocol") == "UDP", "UDP"
    )
    addressed = F.col("protocol") != "ICMP"
    return t.flow_texts.select(
        F.col("frame_number").alias("no"),
        F.col("frame_time").alias("time"),
        F.when(addressed, F.col("ip_src")).alias("src"),
        F.when(addressed & (F.col("protocol") != "UDP"), F.col("ip_dst")).alias("dst"),
        "protocol",
        transport.alias("transport"),
        F.col("src_port").alias("sport"),
        F.col("dst_port").alias("dport"),
        F.col("frame_len").alias("length"),
        F.repeat(F.concat_ws(" ", "frame_time", "protocol"), F.lit(60)).alias("info"),
    )


CAPTURE_SQL = """
select frame_number as no, frame_time as time, ip_src as src,
       case when protocol = 'UDP' then 'N/A' else ip_dst end as dst, protocol,
       case when protocol in ('TCP', 'TLSv1.2') then 'TCP' when protocol = 'UDP' then 'UDP' end as transport,
       case when protocol <> 'HTTP' then src_port end as sport,
       case when protocol <> 'HTTP' then dst_port end as dport,
       frame_len as length, substring(repeat(frame_time || ' ' || protocol, 60), 1, 1000) as info
from $flow_texts where protocol <> 'ICMP'"""


@query("src_capture_normalize", CAPTURE_SQL)
def _(t: Tables) -> DataFrame:
    return S.normalize_capture(captures(t))


@query("src_split_files", """
select ip_dst || '-split.csv' as kind, count(*) as n, sum(frame_len) as total_len
from $flows group by all""")
def _(t: Tables) -> DataFrame:
    folder = new_work_path(t.spark, "split-files")
    named = t.raw_flows.select(
        *[F.col(c).alias(h) for h, c in schemas.FLOW_CSV_HEADER.items()],
        F.concat("ip_dst", F.lit("-split.csv")).alias("kind"),
    )
    named.write.partitionBy("kind").csv(folder, header=True, quoteAll=True, escape='"')
    # Writers name the files themselves, so the folder carries the name here.
    rows = S.read_split_files(t.spark, folder, "part-*.csv")
    return rows.groupBy(F.concat("ip_dst", F.lit("-split.csv")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("frame_len").cast("long")).alias("total_len")
    )


@query("src_payload_prefix", """
select doc_id, substring(text, 1, 100) as payload, length(text) as n_chars from documents""")
def _(t: Tables) -> DataFrame:
    raw = t.documents.select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    decoded = S.payload_text(raw, "raw")
    return decoded.select(
        "doc_id",
        F.substring("payload", 1, TP.PAYLOAD_CHARS).alias("payload"),
        F.length("payload").cast("long").alias("n_chars"),
    )


HTML_ORACLE = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    r"'(?is)<script\b.*?</script>', '', 'g'), '(?is)<style\b.*?</style>', '', 'g'), '(?s)<[^>]*>', '', 'g')"
)


@query("src_html_text", f"""
select page_id, replace(replace(replace(replace(replace(replace({HTML_ORACLE},
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') as text
from pages""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.html_text(F.col("html")).alias("text"))


@query("src_pages_concat", """
select conv_id, string_agg(text || chr(10), '' order by turn) as text
from conversations where text <> '' group by conv_id""")
def _(t: Tables) -> DataFrame:
    return T.join_pages(t.conversations, "conv_id", "turn", "text")


@query("src_concat_trim", """
select ip_src as "Source IP", src_port as "Source Port", ip_dst as "Destination IP",
       dst_port as "Destination Port", cast(frame_len as double) as "Flow Packets/s" from $flows
union all
select 'customer-' || o_custkey, null, 'order-' || o_orderkey, null, o_totalprice from orders""")
def _(t: Tables) -> DataFrame:
    names = ["Source IP", "Source Port", "Destination IP", "Destination Port", "Flow Packets/s"]
    columns = ["ip_src", "src_port", "ip_dst", "dst_port", "frame_len"]
    flows = t.flows.select("protocol", *columns).toDF("Protocol", *[f" {n} " for n in names])
    flows = flows.withColumn(" Flow Packets/s ", F.col("` Flow Packets/s `").cast("double"))
    orders = t.orders.select(
        F.concat(F.lit("customer-"), "o_custkey").alias("Source IP"),
        F.lit(None).cast("int").alias(" Source Port"),
        F.concat(F.lit("order-"), "o_orderkey").alias("Destination IP"),
        F.lit(None).cast("int").alias(" Destination Port"),
        F.col("o_totalprice").alias("Flow Packets/s "),
        "o_orderstatus",
    )
    return S.stack_trimmed(flows, orders, columns=names)


@query("sink_vector_text_roundtrip", """
select id, label, i - 1 as i, round(cast(printf('%.6f', v[i]) as double), 6) as x
from (select id, label, v, unnest(generate_series(1, len(v))) as i from $vectors)""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "vector-text")
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "label", "embedding")
    S.write_vector_text(rows, path, "embedding")
    back = S.read_vector_text(
        t.spark, path, "id long, label int, embedding array<double>", "embedding"
    )
    return back.select("id", "label", F.posexplode("embedding").alias("i", "x"))


@query("sink_vector_table", """
select label, count(*) as n, sum(len(v)) as cells, (select count(*) from embeddings) as table_rows
from $vectors group by label""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "vector-table")
    rows = S.write_vector_table(t.embeddings, path, "label")
    stored = t.spark.read.parquet(path)
    return stored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("embedding").cast("long")).alias("cells"),
        F.lit(rows).cast("long").alias("table_rows"),
    )


@query("src_metric_log", """
select event_type as operation, count(*) as n, round(sum(value), 4) as duration,
       count(case when event_type = 'signup' then value end) as with_index_time
from events group by event_type""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "metric-log")
    rows = t.events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("event_type").alias("operation"),
        F.col("value").alias("duration"),
        F.lit(1).alias("processed_rows"),
    )
    signup = F.col("operation") == "signup"
    S.append_metrics(rows.where(~signup), path)
    S.append_metrics(rows.where(signup).withColumn("index_construction_time", F.col("duration")), path)
    return S.read_metrics(t.spark, path).groupBy("operation").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("duration"), 4).alias("duration"),
        F.count("index_construction_time").alias("with_index_time"),
    )


@query("src_resource_csv", """
select 'cpu' as kind, count(*) as samples, round(sum(value), 4) as total, round(max(event_id * 0.1), 4) as last from events
union all select 'memory', count(*), round(sum(value * 10), 4), round(max(event_id * 0.5), 4) from events""")
def _(t: Tables) -> DataFrame:
    """Load and memory logs with a header line."""
    path = new_work_path(t.spark, "resource-csv")
    number = F.col("event_id")
    cpu = t.events.select((number * 0.1).alias("time_offset"), F.col("value").alias("cpu_percent"))
    memory = t.events.select((number * 0.5).alias("timestamp"), (F.col("value") * 10).alias("memory_mb"), F.col("value").alias("memory_percent"))
    cpu.write.csv(f"{path}/cpu", header=True)
    memory.write.csv(f"{path}/memory", header=True)
    logs = {
        "cpu": S.read_resource_log(t.spark, f"{path}/cpu").toDF("at", "value"),
        "memory": S.read_resource_log(t.spark, f"{path}/memory", schemas.MEMORY_LOG).select(F.col("timestamp").alias("at"), F.col("memory_mb").alias("value")),
    }
    parts = [
        log.agg(F.count(F.lit(1)).alias("samples"), F.round(F.sum("value"), 4).alias("total"), F.round(F.max("at"), 4).alias("last")).withColumn("kind", F.lit(kind))
        for kind, log in logs.items()
    ]
    return parts[0].unionByName(parts[1])


@query("sink_drop_tables", "select count(*) as rows_written, 2 as tables_before, 0 as tables_after from (select c_custkey from customer union all select s_suppkey from supplier)")
def _(t: Tables) -> DataFrame:
    """Two tables of a database are written, counted and dropped."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"create database {name} location '{new_work_path(t.spark, name)}'")
    for table in ("customer", "supplier"):
        getattr(t, table).write.saveAsTable(f"{name}.{table}")
    tables = [x.name for x in t.spark.catalog.listTables(name)]
    rows = sum(t.spark.table(f"{name}.{x}").count() for x in tables)
    S.drop_tables(t.spark, name)
    left = len(t.spark.catalog.listTables(name))
    t.spark.sql(f"drop database {name}")
    return t.spark.range(1).select(F.lit(rows).cast("long").alias("rows_written"), F.lit(len(tables)).alias("tables_before"), F.lit(left).alias("tables_after"))


@query("src_resource_log", """
select count(*) as samples, round(sum(value), 4) as total, true as offsets_fit from events""")
def _(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "resource-log")
    # Every file is a log of its own; its last offset must fit its line count.
    t.events.repartitionByRange(4, "event_id").select(F.col("value").cast("string")).write.text(path)
    logs = S.read_sample_lines(t.spark, path).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("time_offset").alias("last")
    )
    fits = F.abs(F.col("last") - (F.col("n") - 1) * 0.1) < 1e-6
    return logs.agg(
        F.sum("n").alias("samples"),
        F.round(F.sum("total"), 4).alias("total"),
        F.bool_and(fits).alias("offsets_fit"),
    )


@query("src_inline_rows", """
select c_custkey as id, c_name as name, cast(date '2024-01-01' + cast(c_nationkey as integer) as varchar) as joined
from customer""")
def _(t: Tables) -> DataFrame:
    """A small relational table: created, filled by two inserts, selected."""
    path = new_work_path(t.spark, "students")
    rows = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("joined"),
        F.col("c_acctbal") < 0,
    ).toDF("id", "name", "joined", "late")
    rows.where("not late").drop("late").write.parquet(path)
    rows.where("late").drop("late").write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("id", "name", F.col("joined").cast("string").alias("joined"))


@query("gen_indexed_flows", """
select event_id as i,
       '192.168.1.' || event_id || ' 192.168.1.' || (event_id + 1) || ' TCP ' || (event_id * 10) as inserted,
       '10.0.0.' || event_id || ' 10.0.0.' || (event_id + 1) || ' UDP ' || (event_id * 5) as changed
from events""")
def _(t: Tables) -> DataFrame:
    i = F.col("i")
    return t.events.select(F.col("event_id").alias("i")).select(
        "i", G.indexed_flow_text(i).alias("inserted"), G.indexed_flow_text(i, True).alias("changed")
    )


@query("gen_flow_families")
def _(t: Tables) -> DataFrame:
    flows = G.family_flows(t.events, "event_id")
    return flows.select("event_id", "family", F.array_join("tokens", " ").alias("tokens"))


@query("gen_random_vectors")
def _(t: Tables) -> DataFrame:
    made = G.random_vectors(t.embeddings, "vec_id", 128)
    return made.select("vec_id", F.posexplode("embedding").alias("i", "x"))


# --- cleaning, features, filters -------------------------------------------


@query("clean_safe_int", """
select frame_number, coalesce(try_cast(src_port as integer), 0) as src_port,
       coalesce(try_cast(dst_port as integer), 0) as dst_port,
       coalesce(try_cast(frame_len as integer), 0) as frame_len from $raw_flows""")
def _(t: Tables) -> DataFrame:
    columns = ["src_port", "dst_port", "frame_len"]
    return t.raw_flows.select("frame_number", *[C.safe_int(F.col(c)).alias(c) for c in columns])


@query("clean_digit_or_null", """
select frame_number, case when regexp_full_match(src_port, '[0-9]+') then cast(src_port as integer) end as src_port,
       case when regexp_full_match(dst_port, '[0-9]+') then cast(dst_port as integer) end as dst_port
from $raw_flows""")
def _(t: Tables) -> DataFrame:
    return t.raw_flows.select(
        "frame_number",
        C.digits_or_null(F.col("src_port")).alias("src_port"),
        C.digits_or_null(F.col("dst_port")).alias("dst_port"),
    )


@query("clean_capture_time", """
select frame_number, strftime(frame_time - interval '330 minutes', '%Y-%m-%d %H:%M:%S.%f') as utc from $flows""")
def _(t: Tables) -> DataFrame:
    return t.raw_flows.select(
        F.col("frame_number").cast("long").alias("frame_number"),
        F.date_format(C.capture_time(F.col("frame_time")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("utc"),
    )


@query("clean_protocol", """
select frame_number, upper(trim(protocol)) as protocol,
       replace('it''s ' || protocol, '''', '''''') as escaped from $raw_flows""")
def _(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit("it's "), F.col("protocol"))
    return t.raw_flows.select(
        "frame_number",
        C.clean_protocol(F.col("protocol")).alias("protocol"),
        C.escape_quotes(quoted).alias("escaped"),
    )


def _ip_sql(c: str) -> str:
    octets = [f"cast(split_part({c}, '.', {i}) as bigint)" for i in range(1, 5)]
    return f"({octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]})"


@query("feat_ip_to_int", f"""
select frame_number, {_ip_sql('ip_src')} as src, {_ip_sql('ip_dst')} as dst,
       cast(replace(ip_src, '.', '') as bigint) as src_digits, 0 as bad from $flows""")
def _(t: Tables) -> DataFrame:
    return t.flows.select(
        "frame_number",
        C.ip_to_long(F.col("ip_src")).alias("src"),
        C.ip_to_long(F.col("ip_dst")).alias("dst"),
        C.ip_digits_to_long(F.col("ip_src")).alias("src_digits"),
        C.ip_to_long(F.col("protocol")).cast("int").alias("bad"),
    )


@query("feat_increment_ip", """
select frame_number, split_part(ip_src, '.', 1) || '.' || split_part(ip_src, '.', 2) || '.' ||
       split_part(ip_src, '.', 3) || '.' || ((cast(split_part(ip_src, '.', 4) as integer) + 1) % 256) as next_ip
from $flows""")
def _(t: Tables) -> DataFrame:
    return t.flows.select("frame_number", C.next_ip(F.col("ip_src")).alias("next_ip"))


@query("feat_len_bucket", """
select frame_number, case when frame_len < 100 then 'small' when frame_len < 1500 then 'medium' else 'large' end as bucket
from $flows""")
def _(t: Tables) -> DataFrame:
    return t.flows.select("frame_number", C.length_bucket(F.col("frame_len")).alias("bucket"))


@query("feat_label_encode", """
with codes as (select protocol, row_number() over (order by protocol) - 1 as code
               from (select distinct protocol from $flows))
select f.frame_number, f.protocol, c.code from $flows f join codes c using (protocol)""")
def _(t: Tables) -> DataFrame:
    return A.encode_labels(t.flows.select("frame_number", "protocol"), "protocol").select(
        "frame_number", "protocol", "code"
    )


@query("feat_standardize", """
with s as (select avg(frame_len) as ml, stddev_pop(frame_len) as sl, avg(value) as mv, stddev_pop(value) as sv
           from $flows f join events e on e.event_id = f.frame_number)
select frame_number, round((frame_len - ml) / sl, 6) as frame_len_z, 0.0::double as constant_z
from $flows, s""")
def _(t: Tables) -> DataFrame:
    rows = t.flows.select("frame_number", "frame_len", F.lit(7).alias("constant"))
    scaled = A.standardize(rows, ["frame_len", "constant"])
    return scaled.select("frame_number", F.round("frame_len_z", 6).alias("frame_len_z"), "constant_z")


def numeric_vector(t: Tables) -> DataFrame:
    """``frame_number, vector`` of the numeric five-tuple; a missing port counts as 0."""
    coded = A.encode_labels(t.flows, "protocol", "protocol_code")
    port = lambda c: F.coalesce(C.port_share(F.col(c)), F.lit(0.0))
    return coded.select(
        "frame_number",
        F.array(
            C.ip_to_long(F.col("ip_src")).cast("double"),
            C.ip_to_long(F.col("ip_dst")).cast("double"),
            port("src_port"),
            port("dst_port"),
            F.col("protocol_code").cast("double"),
        ).alias("vector"),
    )


@query("feat_numeric_vector", f"""
with codes as (select protocol, row_number() over (order by protocol) - 1 as code
               from (select distinct protocol from $flows))
select frame_number, cast({_ip_sql('ip_src')} as double) as ip_src, cast({_ip_sql('ip_dst')} as double) as ip_dst,
       round(coalesce(src_port, 0) / 65535.0::double, 9) as src_port,
       round(coalesce(dst_port, 0) / 65535.0::double, 9) as dst_port, cast(code as double) as protocol
from $flows join codes using (protocol)""")
def _(t: Tables) -> DataFrame:
    v = F.col("vector")
    return numeric_vector(t).select(
        "frame_number",
        v[0].alias("ip_src"),
        v[1].alias("ip_dst"),
        F.round(v[2], 9).alias("src_port"),
        F.round(v[3], 9).alias("dst_port"),
        v[4].alias("protocol"),
    )


@query("clean_dedup_flows", """
select ip_src, ip_dst, protocol, min(frame_number) as frame_number, arg_min(frame_len, frame_number) as frame_len
from $flows where ip_src is not null and ip_dst is not null and protocol is not null
group by ip_src, ip_dst, protocol""")
def _(t: Tables) -> DataFrame:
    rows = t.flows.select("frame_number", "ip_src", "ip_dst", "protocol", "frame_len")
    return A.keep_first(rows, ["ip_src", "ip_dst", "protocol"], "frame_number")


@query("filter_scalar", "select event_id, event_type, value from events where value > 90 or event_type = 'signup'")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type", "value").where("value > 90 or event_type = 'signup'")


@query("filter_compound", """
select frame_number, ip_src, ip_dst, src_port from $flows
where protocol = 'TCP' and dst_port = 80 and ip_src <> '10.0.0.0' and frame_len >= 100 and ip_dst = '172.20.0.1'""")
def _(t: Tables) -> DataFrame:
    wanted = (
        F.col("protocol").eqNullSafe("TCP")
        & F.col("dst_port").eqNullSafe(80)
        & ~F.col("ip_src").eqNullSafe("10.0.0.0")
        & (F.col("frame_len") >= 100)
        & F.col("ip_dst").eqNullSafe("172.20.0.1")
    )
    return t.flows.where(wanted).select("frame_number", "ip_src", "ip_dst", "src_port")


@query("get_by_ids", """
select frame_number, ip_src, ip_dst, protocol from $flows where frame_number in (select doc_id from labels)""")
def _(t: Tables) -> DataFrame:
    ids = t.labels.select(F.col("doc_id").alias("frame_number"))
    rows = t.flows.select("frame_number", "ip_src", "ip_dst", "protocol")
    return crud.get_by_ids(rows, ids, "frame_number")


@query("scroll_page", "select frame_number, ip_src, protocol from $flows order by frame_number limit 100 offset 250")
def _(t: Tables) -> DataFrame:
    return S.page(t.flows.select("frame_number", "ip_src", "protocol"), 250, 100, "frame_number")


@query("json_payload_field", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# --- row texts --------------------------------------------------------------


def _flow_text(template: str):
    def build(t: Tables) -> DataFrame:
        rows = t.flow_texts.withColumns(
            {
                "packets_per_s": F.col("frame_len") % 1000,
                "info": F.concat(F.lit("frame "), F.col("frame_number")),
                "payload": F.repeat(F.concat("ip_src", F.lit("|")), 20),
            }
        )
        return TP.serialize_flow(rows, template).select("frame_number", "packet_text")

    return build


def _pattern_sql(pattern: str) -> str:
    pieces = pattern.replace("}", "{").split("{")
    return " || ".join(
        f"coalesce(cast({p} as varchar), '')" if i % 2 else "'" + p + "'"
        for i, p in enumerate(pieces)
    )


TEXT_ROWS = (
    "(select *, frame_len % 1000 as packets_per_s, 'frame ' || frame_number as info, "
    "repeat(ip_src || '|', 20) as payload from $flow_texts)"
)
TEXT_SQL = {name: _pattern_sql(pattern) for name, pattern in TP.PATTERNS.items()}
TEXT_SQL["sentence"] = """'A network packet from ' || coalesce('source IP ' || ip_src, 'an unknown source') || ' '
    || coalesce('from port ' || src_port, '') || ' to ' || coalesce('destination IP ' || ip_dst, 'an unknown destination')
    || ' ' || coalesce('to port ' || dst_port, '') || ' ' || coalesce('using ' || protocol || ' protocol', '') || ' '
    || coalesce('with packet size ' || frame_len || ' bytes', '')"""
TEXT_SQL["payload"] = """'From ' || ip_src || ' to ' || ip_dst || ' using protocol ' || protocol || '. Payload: '
    || substring(payload, 1, 100)"""
TEXT_SQL["join_all"] = " || ' ' || ".join(
    f"coalesce(cast({c} as varchar), '')" for c in schemas.FLOW_COLUMNS
)

for _name in TP.TEMPLATES:
    query(
        f"text_{_name}", f"select frame_number, {TEXT_SQL[_name]} as packet_text from {TEXT_ROWS}"
    )(_flow_text(_name))


TOKEN_SQL = """['src:' || ip_src, 'dst:' || ip_dst, 'sport:' || coalesce(cast(src_port as varchar), ''),
    'dport:' || coalesce(cast(dst_port as varchar), ''), 'proto:' || protocol,
    'len:' || case when frame_len < 100 then 'small' when frame_len < 1500 then 'medium' else 'large' end]"""


@query("text_tokens", f"""
select frame_number, i - 1 as i, toks[i] as token
from (select frame_number, {TOKEN_SQL} as toks, unnest(generate_series(1, 6)) as i from $flows)""")
def _(t: Tables) -> DataFrame:
    return t.flows.select("frame_number", F.posexplode(TP.tokens()).alias("i", "token"))


@query("text_prefixed", f"""
select frame_number, 'passage: ' || x as passage, 'Updated ' || x as updated, 'UPDATED - ' || x as updated_dash
from (select frame_number, {TEXT_SQL['kv_time']} as x from $flow_texts)""")
def _(t: Tables) -> DataFrame:
    text = TP.flow_text("kv_time")
    return t.flow_texts.select(
        "frame_number", *[TP.with_prefix(p, text).alias(p) for p in TP.PREFIXES]
    )
