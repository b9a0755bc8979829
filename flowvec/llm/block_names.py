"""Exact deduplication by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of a fixed number of characters.  The
distinct blocks are sorted and get whole numbers as names; then neighbouring
names are paired, the distinct pairs sorted and named, until one name is left
for each document.  A name stands for exactly one text, so documents of equal
name and level are equal and others are not; no digest decides.

Digests only route: a block meets its name by a 64-bit digest, and digests that
two different blocks share are detected and resolved by the blocks themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import BLANKS, free_name, keyed, write_table

BLOCK_CHARS = 4096
# Stands for the missing right neighbour of the last name of an odd row of names.
NONE = -(2**63)


def normalised(text: Column) -> Column:
    """Runs of blanks as one space."""
    return F.regexp_replace(text, BLANKS, " ")


def blocks_of(text: Column, chars: int = BLOCK_CHARS) -> Column:
    """The text in blocks of ``chars`` code points; an empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % chars), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Whole numbers for distinct rows: sorted within the partitions of the shuffle.

    Partitions hold rows by hash and are sorted, so a task that runs again
    gives every row the same number.
    """
    return rows.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def block_names(rows: DataFrame, placed: DataFrame, chars: int, digest: Callable[[Column], Column]) -> DataFrame:
    """``key, pos, n, name`` of every block.

    ``rows`` has ``key, norm``; ``placed`` has ``key, pos, n, digest``.
    """
    blocks = rows.select(F.explode(blocks_of(F.col("norm"), chars)).alias("block"))
    named = _numbered(blocks.distinct(), "block").select(digest(F.col("block")).alias("digest"), "name")
    named = write_table(named, "block-names")
    per_digest = named.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.min("name").alias("name"))
    per_digest = write_table(per_digest, "block-digests")
    clear = per_digest.where("texts = 1").select("digest", "name")
    found = placed.join(clear, "digest").select("key", "pos", "n", "name")
    shared = per_digest.where("texts > 1").select("digest")
    if shared.limit(1).count():
        # Different blocks behind one digest: these few meet their names by the block.
        full = rows.select("key", F.posexplode(blocks_of(F.col("norm"), chars)).alias("pos", "block"))
        full = full.withColumn("digest", digest(F.col("block"))).join(shared, "digest", "left_semi")
        full = write_table(full.select("key", "pos", "block"), "shared-digests")
        exact = write_table(_numbered(full.select("block").distinct(), "block"), "shared-names")
        exact = exact.withColumn("name", -1 - F.col("name"))
        lengths = placed.select("key", "pos", "n")
        met = full.join(exact, "block").select("key", "pos", "name").join(lengths, ["key", "pos"])
        found = found.unionByName(met.select("key", "pos", "n", "name"))
    return write_table(found, "names-0")


def identities(names: DataFrame) -> DataFrame:
    """``key, level, name``: names paired until one is left for each document."""
    level, done = 0, []
    while True:
        done.append(names.where("n = 1").select("key", F.lit(level).alias("level"), "name"))
        rest = names.where("n > 1")
        if not rest.limit(1).count():
            break
        at = F.col("pos") % 2
        pairs = (
            rest.groupBy("key", F.floor(F.col("pos") / 2).cast("int").alias("pos"), F.ceil(F.col("n") / 2).cast("int").alias("n"))
            .agg(
                F.max(F.when(at == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(at == 1, F.col("name"))), F.lit(NONE)).alias("right"),
            )
        )
        pairs = write_table(pairs, "pairs")
        distinct = pairs.select("left", "right").distinct()
        named = write_table(_numbered(distinct, "left", "right"), "pair-names")
        names = write_table(
            pairs.join(named, ["left", "right"]).select("key", "pos", "n", "name"), f"names-{level + 1}"
        )
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_groups(
    docs: DataFrame, chars: int = BLOCK_CHARS, digest: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null text counts as empty; empty texts are equal.  Of equal texts the row
    with the smallest ``doc_id`` stays, a null id coming last; of rows that
    repeat both id and text exactly one stays.  Other columns are not read.
    An empty table gives an empty result.
    """
    rows = keyed(docs).withColumn("norm", normalised(F.col("text")))
    digests = F.transform(blocks_of(F.col("norm"), chars), lambda b: digest(b))
    slim = rows.select("key", "doc_id", F.sha2("norm", 256).alias("text_sha256"), digests.alias("digests"))
    slim = write_table(slim, "texts")
    placed = slim.select("key", F.size("digests").alias("n"), F.posexplode("digests").alias("pos", "digest"))
    names = block_names(rows.select("key", "norm"), placed, chars, digest)
    named = slim.drop("digests").join(identities(names), "key")
    named = write_table(named, "identities")
    groups = named.groupBy("level", "name").agg(
        F.min(F.struct("key", "doc_id")).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    groups = write_table(groups, "groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("key") == F.col("first.key")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns unchanged.

    Rows that repeat a kept id and text are reduced to one.  Other columns may have any names.
    """
    verdict = write_table(exact_groups(docs), "verdict")
    digest, kept_id, kept_text, same_id, same_text = (free_name(docs, n) for n in ("_sha", "_kept_id", "_kept_text", "_id", "_text"))
    kept = verdict.where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_text))
    sha = F.sha2(normalised(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    met = docs.withColumn(digest, sha).join(
        kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_text)), "left_semi"
    )
    repeated = verdict.groupBy("doc_id", "text_sha256").count().where("count > 1")
    if not repeated.limit(1).count():
        return met.select(*[F.col(f"`{c}`") for c in docs.columns])
    # Rows that repeat id and text: the first by their other columns stays.
    marks = repeated.select(F.col("doc_id").alias(same_id), F.col("text_sha256").alias(same_text))
    again = F.col("doc_id").eqNullSafe(F.col(same_id)) & (F.col(digest) == F.col(same_text))
    single = met.join(marks, again, "left_anti")
    several = met.join(marks, again, "left_semi").dropDuplicates(["doc_id", digest])
    return single.unionByName(several).select(*[F.col(f"`{c}`") for c in docs.columns])
