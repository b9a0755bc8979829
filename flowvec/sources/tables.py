"""The given tables, and the flow views derived from them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# One flow per event, in SQL both Spark and the checking engine understand.
FLOWS_SQL = """
select event_id as frame_number,
       ts as frame_time,
       '10.0.' || (user_id % 4) || '.' || (user_id % 251) as ip_src,
       '172.20.0.' || (cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 10 + 1) as ip_dst,
       case when event_type = 'error' then null
            else cast(1024 + (user_id * 7919 + event_id * 31) % 64512 as integer) end as src_port,
       case event_type when 'click' then 80 when 'view' then 443
                       when 'purchase' then 443 when 'signup' then 53 end as dst_port,
       case event_type when 'click' then 'TCP' when 'view' then 'TLSv1.2'
                       when 'purchase' then 'HTTP' when 'signup' then 'UDP' else 'ICMP' end as protocol,
       cast(floor(value * 20) as integer) + 54 as frame_len
from events"""


class Tables:
    """Lazy access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def flows(self) -> DataFrame:
        """Typed flows: ``frame_time`` is a time stamp, ports are null without transport."""
        return self.spark.sql(FLOWS_SQL.replace("from events", "from {events}"), events=self.events)

    @cached_property
    def flow_texts(self) -> DataFrame:
        """Flows with the capture time as ``yyyy-MM-dd HH:mm:ss`` text."""
        return self.flows.withColumn(
            "frame_time", F.date_format("frame_time", "yyyy-MM-dd HH:mm:ss")
        )

    @cached_property
    def raw_flows(self) -> DataFrame:
        """All-text flows as captured: padded times, odd protocols, bad ports."""
        day = F.lpad(F.date_format("frame_time", "d"), 2, " ")
        time = F.concat(
            F.date_format("frame_time", "MMM "),
            day,
            F.date_format("frame_time", ", yyyy HH:mm:ss.SSSSSS"),
            F.lit("255 IST"),
        )
        view = F.col("protocol") == "TLSv1.2"
        return self.flows.select(
            F.col("frame_number").cast("string").alias("frame_number"),
            time.alias("frame_time"),
            "ip_src",
            "ip_dst",
            F.coalesce(F.col("src_port").cast("string"), F.lit("")).alias("src_port"),
            F.when(F.col("protocol") == "UDP", "domain")
            .otherwise(F.col("dst_port").cast("string"))
            .alias("dst_port"),
            F.when(view, F.concat(F.lit(" "), F.lower("protocol"), F.lit(" ")))
            .otherwise(F.col("protocol"))
            .alias("protocol"),
            F.col("frame_len").cast("string").alias("frame_len"),
        )
