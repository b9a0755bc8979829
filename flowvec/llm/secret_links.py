"""Secrets in texts: plain patterns, and weak parts linked by an interval join.

DataFrame operations only.  Patterns give candidates with their spans.  A weak
part (an account name, a short password, an endpoint) means nothing alone; it is
reported where complementary parts lie in the same scope: the span widened by
``reach`` characters on either side, within one document.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvec.llm.common import keyed, write_table

REACH = 200

# kind: pattern with the value as its group, least length of the value, part it
# plays, and strings of which a text with a match has at least one.  Kinds stand
# in the order in which spans of equal start are listed.  Runs that are too
# short for their kind hold no longer run, so their length is in the pattern.
STRONG = {
    "assign": (
        r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        12,
        "secret",
        ("=", ":"),
    ),
    "access": (r"(AKIA[A-Z0-9]{14,})", 18, "id", ("AKIA",)),
    "hex": (r"(?<![0-9a-f])([0-9a-f]{16,})", 16, "secret", ()),
}
WEAK = {
    "id": (
        r"(?:[Cc][Ll][Ii][Ee][Nn][Tt]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Aa][Cc][Cc][Ee][Ss][Ss]|[Uu][Ss][Ee][Rr]"
        r"|[Ll][Oo][Gg][Ii][Nn]|[Tt][Ee][Nn][Aa][Nn][Tt])[_-]?(?:[Kk][Ee][Yy][_-]?)?(?:[Ii][Dd]|[Nn][Aa][Mm][Ee])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]+)",
        3,
        "id",
        ("=", ":"),
    ),
    "key": (
        r"(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd]|[Pp][Hh][Rr][Aa][Ss][Ee])?|[Pp][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Cc][Rr][Ee][Dd][Ee][Nn][Tt][Ii][Aa][Ll]|[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        "secret",
        ("=", ":"),
    ),
    "endpoint": (
        r"((?:[Hh][Tt][Tt][Pp][Ss]?|[Ww][Ss][Ss]?|[Aa][Mm][Qq][Pp][Ss]?|[Pp][Oo][Ss][Tt][Gg][Rr][Ee][Ss](?:[Qq][Ll])?|[Mm][Yy][Ss][Qq][Ll]"
        r"|[Mm][Oo][Nn][Gg][Oo][Dd][Bb]|[Rr][Ee][Dd][Ii][Ss]|[Ss]?[Ff][Tt][Pp])://[A-Za-z0-9][A-Za-z0-9._~:/?#@%&=+-]*)",
        8,
        "place",
        ("://",),
    ),
}
KINDS = [*STRONG, *WEAK]


def candidates(text: Column) -> Column:
    """All matches: ``kind`` (its rank), ``at`` (its number), lengths of the gap before it and of itself, and
    whether the value is long enough.

    A match's place follows from the lengths of what lies between the matches.
    """
    found = []
    for rank, (pattern, least, _, marks) in enumerate({**STRONG, **WEAK}.values()):
        gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
        values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda v: F.length(v))
        lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m))
        both = F.zip_with(lengths, values, lambda m, v: F.struct(m.alias("m"), (v >= least).alias("long")))
        rows = F.zip_with(
            gaps, both, lambda g, b: F.struct(F.lit(rank).alias("kind"), g.alias("gap"), b["m"].alias("m"), b["long"].alias("long"))
        )
        rows = F.filter(rows, lambda r: r["m"].isNotNull())
        numbered = F.transform(
            rows,
            lambda r, i: F.struct(r["kind"].alias("kind"), i.alias("at"), r["gap"].alias("gap"), r["m"].alias("m"), r["long"].alias("long")),
        )
        empty = F.array().cast("array<struct<kind:int,at:int,gap:int,m:int,long:boolean>>")
        there = text.rlike(pattern)
        if marks:
            there = reduce(or_, [F.contains(text, F.lit(mark)) for mark in marks]) & there
        found.append(F.when(there, numbered).otherwise(empty))
    return F.concat(*found)


def spans(hits: DataFrame, reach: int = REACH) -> DataFrame:
    """``key, kind, start, end``: strong spans, and weak ones with their complement in scope.

    The join is a sweep: at each candidate, ordered by place, the furthest end
    of the parts before it and the nearest start of the parts after it.
    A weak identifier or place that a strong span covers is not repeated.
    """
    each = hits.select("key", F.explode("hits").alias("h")).select("key", "h.*")
    upto = Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("m")).over(upto)).where("long")
    parts = {rank: part for rank, (_, _, part, _) in enumerate({**STRONG, **WEAK}.values())}
    part = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("kind")]
    placed = placed.select("key", "kind", part.alias("part"), (F.col("end") - F.col("m")).alias("start"), "end")

    before = Window.partitionBy("key").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy("key")
        .orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def near(which: str) -> Column:
        mine = F.col("part") == which
        last = F.max(F.when(mine, F.col("end"))).over(before)
        following = F.min(F.when(mine, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= reach, F.lit(False)) | F.coalesce(
            following - F.col("end") <= reach, F.lit(False)
        )

    covered = F.coalesce(
        F.max(F.when(F.col("kind") < len(STRONG), F.col("end"))).over(before) >= F.col("end"), F.lit(False)
    )
    swept = placed.select(
        "key", "kind", "part", "start", "end", near("id").alias("id"), near("secret").alias("secret"),
        near("place").alias("place"), covered.alias("covered"),
    )
    linked = (
        ((F.col("part") == "id") & F.col("secret"))
        | ((F.col("part") == "secret") & (F.col("id") | F.col("place")))
        | ((F.col("part") == "place") & F.col("id") & F.col("secret"))
    )
    weak = linked & ~F.col("covered")
    # A weak match that starts where a strong one does is the same place seen twice.
    same = Window.partitionBy("key", "start")
    swept = swept.withColumn("twin", F.min("kind").over(same) < len(STRONG))
    return swept.where((F.col("kind") < len(STRONG)) | (weak & ~F.col("twin"))).select("key", "kind", "start", "end")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans``.

    Spans are code points, the end exclusive, written ``kind:start:end`` by
    start, then kind.  Null text counts as empty; a text without secrets has
    zero counts and an empty list.  Rows with repeated or missing ids are
    scanned one by one.  Other columns are not read.
    """
    rows = keyed(docs)
    slim = write_table(rows.select("key", "doc_id", candidates(F.col("text")).alias("hits")), "candidates")
    found = spans(slim.where(F.size("hits") > 0), reach)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "end", label.alias("label"))))
    count = lambda rank: F.count(F.when(F.col("kind") == rank, 1))
    per_doc = found.groupBy("key").agg(
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.count(F.when(F.col("kind") >= len(STRONG), 1)).alias("n_linked"), listed.alias("found"),
    )
    joined = slim.select("key", "doc_id").join(per_doc, "key", "left")
    text = lambda spans_: F.array_join(F.transform(spans_, lambda s: s["label"]), ",")
    base = F.filter("found", lambda s: s["kind"] < len(STRONG))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return joined.select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), zero("n_linked"),
        F.sha2(F.coalesce(text(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(text(F.col("found")), F.lit("")).alias("spans"),
    )
