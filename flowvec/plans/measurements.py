"""Registered queries on measurement logs and on the capture streams.

The events stand for an operation log: the type is the operation, the value
its duration in seconds, the user the worker or model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec import schemas
from flowvec.functions import vectors as V
from flowvec.operators import benchlog as B
from flowvec.operators.asof import cpu_share, span_resources
from flowvec.plans.registry import query
from flowvec.plans.rows import CAPTURE_SQL, captures
from flowvec.session import new_work_path
from flowvec.sources import flows as S
from flowvec.sources.tables import Tables
from flowvec.streaming import ingest as I
from flowvec.streaming.keyed import KeyedTable
from flowvec.streaming.progress import BatchLog, read_progress

MODELS = ["m0", "m1", "m2", "m3"]

LOG_SQL = """(select event_id, event_type as operation, value as seconds, 'm' || (user_id % 4) as model,
  user_id as pid, epoch_us(ts) / 1000000.0::double as start_time, epoch_us(ts) / 1000000.0::double + value as end_time,
  2500 * (1 + user_id % 4) as records from events)"""


def log(t: Tables) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    return t.events.select(
        "event_id",
        F.col("event_type").alias("operation"),
        F.col("value").alias("seconds"),
        F.concat(F.lit("m"), F.col("user_id") % 4).alias("model"),
        F.col("user_id").alias("pid"),
        micros.alias("start_time"),
        (micros + F.col("value")).alias("end_time"),
        (2500 * (1 + F.col("user_id") % 4)).alias("records"),
    )


def rounded(df: DataFrame, *columns: str, decimals: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


@query("bench_throughput", f"""
select operation, count(*) as operations, round(sum(seconds), 4) as total_seconds,
       round(count(*) / sum(seconds), 4) as ops_per_second, round(sum(seconds) / count(*), 4) as seconds_per_op
from {LOG_SQL} group by operation""")
def _(t: Tables) -> DataFrame:
    return rounded(
        B.throughput(log(t), "operation", "seconds"), "total_seconds", "ops_per_second", "seconds_per_op"
    )


@query("bench_merge_workers", f"""
select operation, round(max(end_time) - min(start_time), 3) as wall_seconds, round(sum(seconds), 3) as seconds
from {LOG_SQL} group by operation""")
def _(t: Tables) -> DataFrame:
    merged = B.merge_workers(log(t), "operation", "start_time", "end_time", ["seconds"])
    return rounded(merged, "wall_seconds", "seconds", decimals=3)


@query("bench_resource_summary", f"""
select operation, arg_min(seconds, start_time) as initial, arg_max(seconds, start_time) as final, max(seconds) as peak,
       round(avg(seconds), 4) as average, min(seconds) as minimum,
       round(arg_max(seconds, start_time) - arg_min(seconds, start_time), 4) as delta
from {LOG_SQL} group by operation""")
def _(t: Tables) -> DataFrame:
    return rounded(B.resource_summary(log(t), "operation", "start_time", "seconds"), "average", "delta")


@query("bench_time_offset", f"""
select event_id, operation, round(start_time - min(start_time) over (partition by operation), 3) as offset_s from {LOG_SQL}""")
def _(t: Tables) -> DataFrame:
    placed = B.time_offset(log(t), "operation", "start_time", "offset_s")
    return rounded(placed, "offset_s", decimals=3).select("event_id", "operation", "offset_s")


@query("bench_pivot", "select operation, " + ", ".join(
    f"round(avg(case when model = '{m}' then seconds end), 4) as {m}" for m in MODELS)
    + f" from {LOG_SQL} where operation in ('click', 'view') group by operation")
def _(t: Tables) -> DataFrame:
    chosen = log(t).where(F.col("operation").isin("click", "view"))
    return rounded(B.pivot_times(chosen, "operation", "model", MODELS, "seconds"), *MODELS)


@query("bench_avg_by_op", f"select operation, round(avg(seconds), 4) as avg_seconds from {LOG_SQL} group by operation")
def _(t: Tables) -> DataFrame:
    return rounded(B.average_by(log(t), "operation", "seconds", "avg_seconds"), "avg_seconds")


@query("bench_query_summary", f"""
select operation, round(avg(case when seconds > 0 then seconds end), 4) as avg_duration, max(records) as max_peak,
       round(avg(case when seconds > 0 then records end), 4) as avg_delta,
       round(1 / avg(case when seconds > 0 then seconds end), 4) as throughput
from {LOG_SQL} group by operation""")
def _(t: Tables) -> DataFrame:
    summary = B.query_summary(log(t), "operation", "seconds", "records", "records")
    return rounded(summary, "avg_duration", "avg_delta", "throughput")


@query("bench_op_series", f"""
select event_id, seconds, case when seconds > 0 then round(records / seconds, 4) else 0 end as throughput
from {LOG_SQL} where operation = 'click' order by start_time""")
def _(t: Tables) -> DataFrame:
    series = B.operation_series(log(t), "operation", F.lit("click"), "start_time")
    speed = F.round(B.rate(F.col("records"), F.col("seconds")), 4)
    return series.select("event_id", "seconds", speed.alias("throughput"))


@query("bench_scaling", f"""
select records, round(avg(seconds), 4) as seconds, round(records / avg(seconds), 4) as records_per_second
from {LOG_SQL} group by records""")
def _(t: Tables) -> DataFrame:
    means = B.average_by(log(t), "records", "seconds", "seconds")
    speed = B.rate(F.col("records"), F.col("seconds"))
    return rounded(means.withColumn("records_per_second", speed), "seconds", "records_per_second")


@query("bench_total_latency", f"""
select model, operation, round(sum(seconds / 10), 4) as planning, round(sum(seconds), 4) as execution,
       round(sum(seconds / 10 + seconds), 4) as total from {LOG_SQL} group by model, operation""")
def _(t: Tables) -> DataFrame:
    timed = log(t).withColumn("planning_s", F.col("seconds") / 10)
    return rounded(
        B.total_latency(timed, ["model", "operation"], "planning_s", "seconds"),
        "planning", "execution", "total",
    )


SAMPLE_SQL = """(select 'm' || (user_id % 4) as model, epoch_us(ts) / 1000000.0::double as sampled,
  value as cpu, event_id % 1000 as memory from events where event_id % 3 = 0)"""


def samples(t: Tables) -> DataFrame:
    """Resource samples of the models: every third event."""
    return t.events.where("event_id % 3 = 0").select(
        F.concat(F.lit("m"), F.col("user_id") % 4).alias("model"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("sampled"),
        F.col("value").alias("cpu"),
        (F.col("event_id") % 1000).alias("memory"),
    )


SPAN_SQL = f"""(with marks as (select model, sampled, max(memory) as memory from {SAMPLE_SQL} group by model, sampled),
    started as (select l.event_id, a.memory from {LOG_SQL} l asof left join marks a on a.model = l.model and l.start_time >= a.sampled),
    ended as (select l.event_id, a.memory from {LOG_SQL} l asof left join marks a on a.model = l.model and l.end_time >= a.sampled),
    loads as (select l.event_id, any_value(l.operation) as operation, any_value(l.seconds) as seconds, count(s.cpu) as samples, coalesce(avg(s.cpu), 0) as cpu_mean
      from {LOG_SQL} l left join {SAMPLE_SQL} s on s.model = l.model and s.sampled between l.start_time and l.end_time group by l.event_id)
  select loads.*, coalesce(ended.memory - started.memory, 0) as memory_delta
  from loads join started using (event_id) join ended using (event_id))"""


def spans(t: Tables) -> DataFrame:
    operations = log(t).select("event_id", "operation", "seconds", "model", "start_time", "end_time")
    return span_resources(operations, samples(t), "model", "start_time", "end_time", "sampled", "cpu", "memory")


@query("bench_span_resources", f"""
select event_id, samples, round(cpu_mean, 4) as cpu_mean, memory_delta from {SPAN_SQL}""")
def _(t: Tables) -> DataFrame:
    """Load and memory of each operation from the samples of its model."""
    return rounded(spans(t).select("event_id", "samples", "cpu_mean", "memory_delta"), "cpu_mean")


@query("bench_cpu_share", f"""
select count(*) as operations, round(sum(seconds), 4) as seconds, round(sum(cpu_mean * seconds) / sum(seconds), 4) as cpu_share from {SPAN_SQL}""")
def _(t: Tables) -> DataFrame:
    return rounded(cpu_share(spans(t), "seconds"), "seconds", "cpu_share")


# --- streams ----------------------------------------------------------------


def _land(t: Tables, rows: DataFrame, folder: str) -> None:
    rows.repartition(4, "no").write.mode("append").parquet(folder)


@query("stream_ingest", CAPTURE_SQL)
def _(t: Tables) -> DataFrame:
    base = new_work_path(t.spark, "stream")
    _land(t, captures(t), f"{base}/landed")
    stream = I.read_capture_stream(t.spark, f"{base}/landed", files_per_trigger=2)
    I.ingest(stream, f"{base}/stored", f"{base}/state").awaitTermination()
    return t.spark.read.parquet(f"{base}/stored")


@query("stream_embed_upsert", """
select no, length + 1 as length, 256 as dim, 1.0::double as norm from ($captures) where protocol <> 'HTTP'
union all select no, length, 256, 1.0 from ($captures) where protocol = 'HTTP'""".replace("$captures", CAPTURE_SQL))
def _(t: Tables) -> DataFrame:
    """All captures are stored, then all but HTTP land again, one byte longer; changes are merged every third batch."""
    base = new_work_path(t.spark, "stream-upsert")
    table = KeyedTable(t.spark, f"{base}/stored", "no", "time", compact_every=3)
    for changed in (False, True):
        rows = captures(t)
        if changed:
            rows = rows.where("protocol <> 'HTTP'").withColumn("length", F.col("length") + 1)
        _land(t, rows, f"{base}/landed")
        stream = I.read_capture_stream(t.spark, f"{base}/landed", files_per_trigger=2)
        I.embed_upsert(stream, table, f"{base}/state", "info", 256).awaitTermination()
    return table.read().select(
        "no",
        "length",
        F.size("embedding").alias("dim"),
        F.round(V.norm(F.col("embedding")), 5).alias("norm"),
    )


@query("stream_bounded", f"""
select least(count(*), 100) as stored, least(count(*), 100) as of_the_captures from ({CAPTURE_SQL})""")
def _(t: Tables) -> DataFrame:
    """A capture that ends after 100 records, although it is started twice and more lands meanwhile."""
    base = new_work_path(t.spark, "stream-bounded")
    for _ in range(2):
        _land(t, captures(t), f"{base}/landed")
        stream = I.read_capture_stream(t.spark, f"{base}/landed", files_per_trigger=1)
        I.ingest_bounded(stream, f"{base}/stored", f"{base}/state", 100).awaitTermination()
    stored = t.spark.read.parquet(f"{base}/stored").select("no")
    known = S.normalize_capture(captures(t)).select("no").withColumn("known", F.lit(1))
    return stored.join(known, "no", "left").agg(
        F.count(F.lit(1)).alias("stored"), F.count("known").alias("of_the_captures")
    )


@query("stream_progress", f"""
select count(*) as rows, true as over_100_batches, 100.0::double as percent from ({CAPTURE_SQL})""")
def _(t: Tables) -> DataFrame:
    """Every micro-batch of an ingest of more than a hundred is in the log; their rows are the ingested ones."""
    base = new_work_path(t.spark, "stream-progress")
    captures(t).repartition(104, "no").write.parquet(f"{base}/landed")
    log_ = BatchLog(t.spark, f"{base}/log")
    t.spark.streams.addListener(log_)
    try:
        stream = I.read_capture_stream(t.spark, f"{base}/landed", files_per_trigger=1)
        running = I.ingest(stream, f"{base}/stored", f"{base}/state")
        running.awaitTermination()
        log_.settle(running)
    finally:
        t.spark.streams.removeListener(log_)
    stored = t.spark.read.parquet(f"{base}/stored").count()
    batches = read_progress(t.spark, f"{base}/log", stored)
    return batches.agg(
        F.sum("rows").alias("rows"), (F.count(F.lit(1)) > 100).alias("over_100_batches"), F.max("percent").alias("percent")
    )
