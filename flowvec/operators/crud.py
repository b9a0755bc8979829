"""Changes of a keyed table as set operations: each returns the new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.operators.positions import with_hash_position, with_position
from flowvec.session import BROADCAST_ROWS, checkpoint, fits, lookup_join


# Rows with payload, vectors perhaps, are broadcast in smaller numbers than ids.
PAYLOAD_ROWS = BROADCAST_ROWS // 20


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    bound = BROADCAST_ROWS if len(df.columns) == 1 else PAYLOAD_ROWS
    return F.broadcast(df) if fits(df, bound) else df


def next_id(state: DataFrame, key: str) -> int:
    highest = state.agg(F.max(key)).first()[0]
    return 0 if highest is None else highest + 1


def insert(state: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Append ``rows`` under fresh ids, given out in ``order`` after the highest id."""
    start = next_id(state, key)
    fresh = with_position(rows, order, "_pos")
    fresh = fresh.withColumn(key, (F.col("_pos") - 1 + start).cast(state.schema[key].dataType))
    return state.unionByName(fresh.select(*state.columns))


def latest(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The last change of every key, combined before the shuffle."""
    rest = [c for c in changes.columns if c != key]
    last = F.max_by(F.struct(*rest), seq).alias("_last")
    return changes.groupBy(key).agg(last).select(key, "_last.*")


def _each_once(changes: DataFrame, key: str) -> None:
    """A repeated id would double rows of the state; :func:`latest` keeps one change of each."""
    if changes.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"changes have a repeated {key}")


def upsert(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replace rows whose id exists and add the others; ``changes`` has each id once, or it raises."""
    _each_once(changes, key)
    ids = _maybe_broadcast(changes.select(key))
    return state.join(ids, key, "left_anti").unionByName(changes.select(*state.columns))


def update_by_ids(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Set the columns of ``changes`` on the rows with its ids, each once; null keeps the old value."""
    _each_once(changes, key)
    columns = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = state.join(_maybe_broadcast(renamed), key, "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else c for c in state.columns]
    )


def update_where(state: DataFrame, condition: Column, column: str, value: Column) -> DataFrame:
    """Set ``column`` where the condition holds and the value differs."""
    return state.withColumn(
        column, F.when(changes_where(condition, column, value), value).otherwise(F.col(column))
    )


def changes_where(condition: Column, column: str, value: Column) -> Column:
    """Rows an :func:`update_where` really changes; null-safe."""
    return F.coalesce(condition, F.lit(False)) & ~F.col(column).eqNullSafe(value)


def delete_ids(state: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Drop the rows whose id is listed; unknown ids are ignored."""
    return state.join(_maybe_broadcast(ids.select(key)), key, "left_anti")


def delete_where(state: DataFrame, condition: Column) -> DataFrame:
    return state.where(~F.coalesce(condition, F.lit(False)))


def get_by_ids(state: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return state.join(_maybe_broadcast(ids.select(key).distinct()), key, "left_semi")


def delete_first(state: DataFrame, n: int, key: str) -> DataFrame:
    """Drop the ``n`` rows with the lowest keys."""
    return with_position(state, key, "_pos").where(F.col("_pos") > n).drop("_pos")


def sampled(state: DataFrame, n: int, key: str, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """Split off ``n`` rows (all, if there are fewer) in a fixed shuffled order."""
    placed = with_hash_position(state, key, "_pos", seed)
    picked, kept = placed.where(F.col("_pos") <= n), placed.where(F.col("_pos") > n)
    return picked.drop("_pos"), kept.drop("_pos")


def delete_sample(state: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    return sampled(state, n, key, seed)[1]


def replace_append(
    state: DataFrame, ids: DataFrame, rows: DataFrame, key: str, order: str
) -> DataFrame:
    """Remove the listed rows and append ``rows`` under ids that were never used."""
    start = next_id(state, key)
    fresh = with_position(rows, order, "_pos")
    fresh = fresh.withColumn(key, (F.col("_pos") - 1 + start).cast(state.schema[key].dataType))
    return delete_ids(state, ids, key).unionByName(fresh.select(*state.columns))


def fifo_update(state: DataFrame, n: int, key: str, changed: dict[str, Column]) -> DataFrame:
    """The oldest ``n`` rows leave and return, changed, under fresh ids at the end."""
    start = next_id(state, key)
    placed = with_position(state, key, "_pos")
    old, kept = placed.where(F.col("_pos") <= n), placed.where(F.col("_pos") > n)
    fresh = old.withColumns(changed).withColumn(
        key, (F.col("_pos") - 1 + start).cast(state.schema[key].dataType)
    )
    return kept.drop("_pos").unionByName(fresh.drop("_pos"))


def equal_texts(state: DataFrame, texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """Rows a text-keyed change applies to, one per requested text: the lowest id with that text.

    ``texts`` holds the requested texts in ``text_col``.  An equal text is its own
    nearest neighbour, so no search is needed.
    """
    wanted = checkpoint(texts.select(text_col).distinct())
    # One text may be that of very many rows, so the join must stand hot keys.
    matching = lookup_join(state.select(key, text_col), wanted, [text_col], "left_semi")
    return matching.groupBy(text_col).agg(F.min(key).alias(key))
