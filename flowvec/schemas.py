"""Column layouts of the flow, packet, capture and metric records."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Header names of the flow CSV, in file order, and the names used here.
FLOW_CSV_HEADER = {
    "frame.number": "frame_number",
    "frame.time": "frame_time",
    "ip.src": "ip_src",
    "ip.dst": "ip_dst",
    "tcp.srcport": "src_port",
    "tcp.dstport": "dst_port",
    "_ws.col.protocol": "protocol",
    "frame.len": "frame_len",
}
FLOW_COLUMNS = list(FLOW_CSV_HEADER.values())

FLOW_CSV = T.StructType([T.StructField(name, _S) for name in FLOW_CSV_HEADER])
PACKET_CSV = _struct(timestamp=_S, src_ip=_S, dst_ip=_S, protocol=_S, size=_I)

# A decoded capture record before normalising: layer addresses may be missing.
CAPTURE = _struct(
    no=_L,
    time=_S,
    src=_S,
    dst=_S,
    protocol=_S,
    transport=_S,
    sport=_I,
    dport=_I,
    length=_I,
    info=_S,
)

METRIC_LOG = _struct(
    timestamp=_S,
    operation=_S,
    duration=_D,
    processed_rows=_L,
    throughput=_D,
    index_construction_time=_D,
)

CPU_LOG = _struct(time_offset=_D, cpu_percent=_D)
MEMORY_LOG = _struct(timestamp=_D, memory_mb=_D, memory_percent=_D)
