"""Named text renderings of a flow row.

Every template is a column expression over the columns ``frame_number,
frame_time, ip_src, ip_dst, src_port, dst_port, protocol, frame_len`` (any
type; ``frame_time`` as text).  A missing value prints as the empty string
except where a template says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.functions.cleaning import length_bucket
from flowvec.schemas import FLOW_COLUMNS


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _fill(pattern: str) -> Column:
    """Expand ``{column}`` marks of a pattern into one concatenation."""
    parts: list[Column] = []
    for i, piece in enumerate(pattern.replace("}", "{").split("{")):
        if i % 2:
            parts.append(_text(piece))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


# The sentence formats of the flow texts.
PATTERNS = {
    "space4": "{ip_src} {ip_dst} {protocol} {frame_len}",
    "space6": "{ip_src} {ip_dst} {protocol} {src_port} {dst_port} {frame_len}",
    "space7": "{ip_src} {ip_dst} {protocol} {src_port} {dst_port} {protocol} {frame_len}",
    "space6_ports_first": "{ip_src} {ip_dst} {src_port} {dst_port} {protocol} {frame_len}",
    "space5_time": "{ip_src} {ip_dst} {protocol} {frame_len} {frame_time}",
    "comma3": "{ip_src}, {ip_dst}, {protocol}",
    "comma5": "{ip_src}, {ip_dst}, {src_port}, {dst_port},  {protocol}",
    "comma6": "{frame_number},{ip_src},{ip_dst},{src_port},{dst_port},{protocol}",
    "traffic_sentence": (
        "Traffic from IP address {ip_src} to {ip_dst} using {protocol} protocol on ports "
        "{src_port} -> {dst_port}. Packet number {frame_number} was captured at {frame_time} "
        "and was {frame_len} bytes long."
    ),
    "kv_underscore": (
        "Frame_Number:{frame_number} Frame_Time:{frame_time} Source_IP:{ip_src} "
        "Destination_IP:{ip_dst} Source_Port:{src_port} Destination_Port:{dst_port} "
        "Protocol:{protocol} Frame_Length/Packet_Size:{frame_len}"
    ),
    "kv_source": (
        "Source: {ip_src}, Destination: {ip_dst}, Protocol: {protocol}, "
        "Ports: {src_port}:{dst_port}, Size: {frame_len}"
    ),
    "kv_source_ip": (
        "Source IP: {ip_src}, Source Port: {src_port}, Destination IP: {ip_dst}, "
        "Destination Port: {dst_port}, Protocol: {protocol}"
    ),
    "kv_milvus": (
        "Source IP: {ip_src}, Destination IP: {ip_dst}, Source Port: {src_port}, "
        "Destination Port: {dst_port}, Protocol: {protocol}"
    ),
    "kv_time": (
        "Time: {frame_time}, Source: {ip_src}:{src_port}, Destination: {ip_dst}:{dst_port}, "
        "Protocol: {protocol}, Length: {frame_len}"
    ),
    "arrow": "{ip_src}:{src_port} -> {ip_dst}:{dst_port} {protocol} {frame_len}bytes {frame_time}",
    "modified": "{ip_src}:{src_port} -> {ip_dst}:{dst_port} MODIFIED {frame_len}bytes {frame_time}",
    "flowbert": (
        "SRC_IP: {ip_src}, SRC_PORT: {src_port}, DST_IP: {ip_dst}, DST_PORT: {dst_port}, "
        "PACKETS/s: {packets_per_s}"
    ),
    "capture": "{protocol} {ip_src} {ip_dst} {frame_len} {info}",
}

# The first 100 characters of the payload go into its sentence.
PAYLOAD_CHARS = 100
# Prefixes that mark passages and changed texts.
PREFIXES = {"passage": "passage: ", "updated": "Updated ", "updated_dash": "UPDATED - "}


def _optional(name: str, before: str, after: str = "", missing: str = "") -> Column:
    value = F.col(name).cast("string")
    return F.coalesce(F.concat(F.lit(before), value, F.lit(after)), F.lit(missing))


def _sentence() -> Column:
    return F.concat(
        F.lit("A network packet from "),
        _optional("ip_src", "source IP ", missing="an unknown source"),
        F.lit(" "),
        _optional("src_port", "from port "),
        F.lit(" to "),
        _optional("ip_dst", "destination IP ", missing="an unknown destination"),
        F.lit(" "),
        _optional("dst_port", "to port "),
        F.lit(" "),
        _optional("protocol", "using ", " protocol"),
        F.lit(" "),
        _optional("frame_len", "with packet size ", " bytes"),
    )


def _payload() -> Column:
    return F.concat(
        _fill("From {ip_src} to {ip_dst} using protocol {protocol}. Payload: "),
        F.substring(_text("payload"), 1, PAYLOAD_CHARS),
    )


def _join_all() -> Column:
    return F.concat_ws(" ", *[_text(name) for name in FLOW_COLUMNS])


def tokens() -> Column:
    """The flow as six prefixed tokens."""
    named = {
        "src:": _text("ip_src"),
        "dst:": _text("ip_dst"),
        "sport:": _text("src_port"),
        "dport:": _text("dst_port"),
        "proto:": _text("protocol"),
        "len:": length_bucket(F.col("frame_len").cast("int")),
    }
    return F.array(*[F.concat(F.lit(mark), value) for mark, value in named.items()])


_EXPRESSIONS: dict[str, Callable[[], Column]] = {
    "sentence": _sentence,
    "payload": _payload,
    "join_all": _join_all,
}
TEMPLATES = sorted([*PATTERNS, *_EXPRESSIONS])


def flow_text(template: str) -> Column:
    if template in PATTERNS:
        return _fill(PATTERNS[template])
    if template in _EXPRESSIONS:
        return _EXPRESSIONS[template]()
    raise ValueError(f"unknown template {template!r}; choose from {TEMPLATES}")


def with_prefix(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(PREFIXES[prefix]), text)


def serialize_flow(df: DataFrame, template: str, name: str = "packet_text") -> DataFrame:
    return df.withColumn(name, flow_text(template))
