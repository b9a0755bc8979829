"""Casts, time parsing and row features of flow records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length limits of the small and medium buckets, in bytes.
SMALL_BELOW, MEDIUM_BELOW = 100, 1500
MAX_PORT = 65535

# Month names and layout of capture times once the zone name is cut off.
CAPTURE_TIME = "MMM d, yyyy HH:mm:ss.SSSSSS"
CAPTURE_ZONE = "+05:30"

_QUAD = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def safe_int(c: Column, on_bad: str = "zero") -> Column:
    """Integer of a text; a bad or missing one becomes 0, or null with ``on_bad='null'``."""
    number = c.try_cast("int")
    if on_bad == "null":
        return number
    if on_bad == "zero":
        return F.coalesce(number, F.lit(0))
    raise ValueError("on_bad must be 'zero' or 'null'")


def digits_or_null(c: Column) -> Column:
    """Integer where the text holds digits only, else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def capture_time(c: Column) -> Column:
    """UTC instant of ``Feb  9, 2025 01:29:22.694218255 IST``.

    The zone name is dropped and the reading taken as +05:30.  The fraction is
    cut, not rounded, to microseconds.
    """
    text = F.regexp_replace(F.trim(c), r"\s+", " ")
    text = F.regexp_replace(text, r" \S+$", "")
    whole = F.regexp_extract(text, r"^([^.]*)", 1)
    fraction = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d*)", 1), 1, 6), 6, "0")
    # The offset is part of the text, so the session's zone plays no part.
    return F.try_to_timestamp(F.concat(whole, F.lit("."), fraction, F.lit("+05:30")), F.lit(CAPTURE_TIME + "XXX"))


def clean_protocol(c: Column) -> Column:
    return F.upper(F.trim(c))


def escape_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit("''"))


def is_ipv4(c: Column) -> Column:
    return F.coalesce(c.rlike(_QUAD), F.lit(False))


def _octet(c: Column, i: int) -> Column:
    return F.split_part(c, F.lit("."), F.lit(i)).cast("long")


def ip_to_long(c: Column) -> Column:
    """Unsigned value of a dotted quad; 0 for anything else."""
    value = F.lit(0)
    for i in range(1, 5):
        value = value * 256 + _octet(c, i)
    return F.when(is_ipv4(c), value).otherwise(F.lit(0)).cast("long")


def ip_digits_to_long(c: Column) -> Column:
    """Legacy number made by deleting the dots; different addresses can collide."""
    return F.replace(c, F.lit("."), F.lit("")).try_cast("long")


def next_ip(c: Column) -> Column:
    """Address with its last octet raised by one, wrapping at 256."""
    head = F.regexp_extract(c, r"^(.*\.)", 1)
    return F.when(is_ipv4(c), F.concat(head, F.pmod(_octet(c, 4) + 1, F.lit(256)).cast("string")))


def port_share(c: Column) -> Column:
    return c.cast("double") / F.lit(float(MAX_PORT))


def length_bucket(c: Column) -> Column:
    return (
        F.when(c < SMALL_BELOW, "small").when(c < MEDIUM_BELOW, "medium").otherwise("large")
    )
