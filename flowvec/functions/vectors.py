"""Vector arithmetic as column expressions over ``array<float|double>``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are compared after rounding to this many decimals, so that equal
# vectors tie and the row id decides whatever the summation order was.
TIE_DECIMALS = 9

# metric -> True where a smaller score is the better one
METRICS = {
    "l2": True,
    "l2_sq": True,
    "ip_distance": True,
    "cosine_distance": True,
    "ip": False,
    "cosine": False,
}


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def literal(values: Sequence[float]) -> Column:
    """A constant vector column."""
    return F.array(*[F.lit(float(x)) for x in values])


def _total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row, also where ``body`` uses it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(doubles(v), lambda x: x * x)))


def normalize(v: Column) -> Column:
    """Unit vector; null for a zero vector."""

    def scaled(w: Column) -> Column:
        return let(norm(w), lambda n: F.when(n > 0, F.transform(w, lambda x: x / n)))

    return let(doubles(v), scaled)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where either side is a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_sq(a: Column, b: Column) -> Column:
    return _total(F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(l2_sq(a, b))


def score(metric: str, a: Column, b: Column) -> Column:
    """The named score, rounded for tie-breaking."""
    expressions = {
        "l2": lambda: l2(a, b),
        "l2_sq": lambda: l2_sq(a, b),
        "ip": lambda: dot(a, b),
        "ip_distance": lambda: 1 - dot(a, b),
        "cosine": lambda: cosine(a, b),
        "cosine_distance": lambda: 1 - cosine(a, b),
    }
    if metric not in expressions:
        raise ValueError(f"unknown metric {metric!r}; choose from {sorted(METRICS)}")
    return F.round(expressions[metric](), TIE_DECIMALS)


def similarity(metric: str, value: Column) -> Column:
    """Similarity of a distance; defined for cosine, ip, and squared L2 of unit vectors."""
    if metric in ("cosine", "ip"):
        return value
    if metric in ("cosine_distance", "ip_distance"):
        return 1 - value
    if metric == "l2_sq":
        return 1 - value / 2
    raise ValueError(f"no similarity is defined for metric {metric!r}")


def best_first(metric: str, value: Column, farthest: bool = False) -> Column:
    """Sort order that puts the best (or with ``farthest`` the worst) score first."""
    ascending = METRICS[metric] != farthest
    return value.asc_nulls_last() if ascending else value.desc_nulls_last()


def has_dim(v: Column, dim: int) -> Column:
    return F.coalesce(F.size(v) == dim, F.lit(False))


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def to_text(v: Column, decimals: int = 6) -> Column:
    """``[0.123456,-0.500000]`` form used by the processed-flow files."""
    cells = F.transform(doubles(v), lambda x: F.format_string(f"%.{decimals}f", x))
    return F.concat(F.lit("["), F.array_join(cells, ","), F.lit("]"))


def from_text(c: Column) -> Column:
    """Parse :func:`to_text` output; the text ``NULL`` gives null."""
    return F.from_json(F.nullif(c, F.lit("NULL")), "array<double>")
