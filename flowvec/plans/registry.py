"""Registry of the named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowvec.sources.tables import FLOWS_SQL, Tables

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Flows with the time as text, as in Tables.flow_texts.
FLOW_TEXTS_SQL = (
    "select * replace (strftime(frame_time, '%Y-%m-%d %H:%M:%S') as frame_time) "
    f"from ({FLOWS_SQL})"
)
RAW_FLOWS_SQL = f"""
select cast(frame_number as varchar) as frame_number,
       strftime(frame_time, '%b ') || lpad(strftime(frame_time, '%-d'), 2, ' ')
         || strftime(frame_time, ', %Y %H:%M:%S.%f') || '255 IST' as frame_time,
       ip_src, ip_dst,
       coalesce(cast(src_port as varchar), '') as src_port,
       case when protocol = 'UDP' then 'domain' else cast(dst_port as varchar) end as dst_port,
       case when protocol = 'TLSv1.2' then ' ' || lower(protocol) || ' ' else protocol end as protocol,
       cast(frame_len as varchar) as frame_len
from ({FLOWS_SQL})"""

VIEWS = {
    "$flow_texts": FLOW_TEXTS_SQL,
    "$raw_flows": RAW_FLOWS_SQL,
    "$flows": FLOWS_SQL,
    # Unit of comparison: vectors in doubles.
    "$vectors": "select vec_id as id, cast(embedding as double[]) as v, label from embeddings",
}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its checking SQL if there is one."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if oracle is not None:
            sql = oracle
            for mark, view in VIEWS.items():
                sql = sql.replace(mark, f"({view})")
            ORACLES[name] = sql.strip()
        return build

    return add


def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Derived times are read as UTC on both sides of the check.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(Tables(spark, folder))

    return run
