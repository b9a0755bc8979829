"""Reproducible generated flows and vectors; the row number decides every value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.functions import vectors as V

# The four labelled traffic families.
FAMILIES = {
    "video": {"private": "dst", "port": 443, "proto": "TCP", "len": "huge"},
    "web": {"private": "dst", "port": 80, "proto": "HTTP", "len": "medium"},
    "dns": {"private": "src", "port": 53, "proto": "UDP", "len": "small"},
    "ssh": {"private": "dst", "port": 22, "proto": "TCP", "len": "tiny"},
}


def indexed_flow_text(i: Column, changed: bool = False) -> Column:
    """Text of the ``i``-th inserted flow, or of its changed form."""
    net, proto, factor = ("10.0.0.", "UDP", 5) if changed else ("192.168.1.", "TCP", 10)
    return F.concat(
        F.lit(net), i.cast("string"), F.lit(" " + net), (i + 1).cast("string"),
        F.lit(f" {proto} "), (i * factor).cast("string"),
    )


def draw(key: Column, purpose: str, below: int) -> Column:
    """Stable pseudo-random integer below a bound for a key."""
    return F.pmod(F.xxhash64(key, F.lit(purpose)), F.lit(below))


def uniform(key: Column, purpose: Column) -> Column:
    """Stable pseudo-random double in [0, 1)."""
    return F.pmod(F.xxhash64(key, purpose), F.lit(1 << 30)) / float(1 << 30)


def _address(key: Column, side: str, private: bool) -> Column:
    if private:
        return F.concat(F.lit("172.20.0."), (draw(key, side, 10) + 1).cast("string"))
    octets = [
        draw(key, side + "1", 255) + 1, draw(key, side + "2", 256),
        draw(key, side + "3", 256), draw(key, side + "4", 255) + 1,
    ]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def family_flows(keys: DataFrame, key: str) -> DataFrame:
    """One labelled flow per key: its six tokens and its family."""
    k = F.col(key)
    names = F.array(*[F.lit(name) for name in FAMILIES])
    family = F.get(names, draw(k, "family", len(FAMILIES)).cast("int"))
    cases = None
    for name, f in FAMILIES.items():
        values = {
            "src:": _address(k, "src", f["private"] == "src"),
            "dst:": _address(k, "dst", f["private"] == "dst"),
            "sport:": F.lit(str(f["port"])),
            "dport:": F.lit(str(f["port"])),
            "proto:": F.lit(f["proto"]),
            "len:": F.lit(f["len"]),
        }
        tokens = F.array(*[F.concat(F.lit(mark), value) for mark, value in values.items()])
        matches = F.col("family") == name
        cases = F.when(matches, tokens) if cases is None else cases.when(matches, tokens)
    return keys.select(key, family.alias("family")).withColumn("tokens", cases)


def random_vectors(keys: DataFrame, key: str, dim: int) -> DataFrame:
    """A unit vector per key, normal in every direction."""
    steps = F.sequence(F.lit(0), F.lit(dim - 1))

    def normal(i: Column) -> Column:
        radius = F.sqrt(-2 * F.log(1 - uniform(F.col(key), i * 2)))
        return radius * F.cos(uniform(F.col(key), i * 2 + 1) * (2 * 3.141592653589793))

    return keys.select(key, V.normalize(F.transform(steps, normal)).alias("embedding"))
