"""A keyed table that micro-batches change: ranges of keys, change folders, and a manifest that names both.

A batch writes one change folder and a new manifest.  Once there are several
change folders they are merged into the ranges whose keys they touch; the other
ranges stay the files they are.  Every version of the manifest names whole
folders that nothing writes to any more, so the table can be read meanwhile, and
a read costs the ranges and at most ``compact_every`` change folders, however
many batches there were.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowvec.session import checkpoint
from flowvec.sources import files

COMPACT_EVERY = 8
ROWS_PER_RANGE = 1_000_000
EMPTY = {"version": 0, "batch": -1, "schema": None, "ranges": [], "changes": []}


class KeyedTable:
    """The table at ``path``: one row per numeric ``key``, the last batch and then the highest ``order`` wins.

    Rows with a null key are left out.  There is one writer, the stream.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, order: str,
        compact_every: int = COMPACT_EVERY, rows_per_range: int = ROWS_PER_RANGE,
    ):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.compact_every, self.rows_per_range = compact_every, rows_per_range

    def manifest(self) -> dict:
        """The newest version."""
        found = [n for n in files.names(self.spark, f"{self.path}/manifest") if n.endswith(".json") and n.startswith("v")]
        return json.loads(files.read_text(self.spark, f"{self.path}/manifest/{found[-1]}")) if found else dict(EMPTY)

    def _commit(self, manifest: dict) -> dict:
        manifest = {**manifest, "version": manifest["version"] + 1}
        files.write_text(self.spark, f"{self.path}/manifest/v{manifest['version']:010d}.json", json.dumps(manifest))
        return manifest

    def _rows(self, manifest: dict, folders: list[str], batch: bool) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        if batch:
            schema = StructType([*schema.fields]).add("_batch", "long")
        reader = self.spark.read.schema(schema)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (self.key, "_batch")]
        last = F.max_by(F.struct(*rest), F.struct("_batch", self.order))
        return rows.groupBy(self.key).agg(last.alias("_row")).select(self.key, "_row.*")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Take a micro-batch; one that was taken before changes nothing."""
        manifest = self.manifest()
        if batch_id <= manifest["batch"]:
            return
        folder = f"{self.path}/changes/batch-{batch_id:010d}"
        kept = batch.where(F.col(self.key).isNotNull())
        kept.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(folder)
        manifest = self._commit({**manifest, "batch": batch_id, "schema": kept.schema.jsonValue(), "changes": [*manifest["changes"], folder]})
        if len(manifest["changes"]) >= self.compact_every:
            self.compact()

    def _number(self, lows: list) -> Column:
        """The range of a key: ranges start at ``lows``, the first one at the least key."""
        return F.size(F.filter(F.array(*[F.lit(x) for x in lows]), lambda low: low <= F.col(self.key)))

    def compact(self) -> None:
        """Merge the change folders into the ranges they touch, and split those that have grown."""
        manifest = self.manifest()
        if not manifest["changes"]:
            return
        changes = checkpoint(self._latest(self._rows(manifest, manifest["changes"], True)))
        ranges = manifest["ranges"]
        lows = [r["low"] for r in ranges[1:]]
        number = self._number(lows) if lows else F.lit(0)
        touched = {r[0] for r in changes.select(number.cast("int")).distinct().collect()}
        if not touched:
            self._commit({**manifest, "changes": []})
            return
        base = self._rows(manifest, [r["path"] for i, r in enumerate(ranges) if i in touched], False)
        merged = checkpoint(base.join(changes, self.key, "left_anti").unionByName(changes).withColumn("_range", number.cast("int")))
        sizes = {r["_range"]: r["count"] for r in merged.groupBy("_range").count().collect()}
        cuts = []
        for i in sorted(sizes):
            parts = -(-sizes[i] // self.rows_per_range)
            if parts > 1:
                keys = merged.where(F.col("_range") == i).select(F.col(self.key).cast("double").alias("k"))
                least = keys.agg(F.min("k")).first()[0]
                cuts += [c for c in keys.approxQuantile("k", [j / parts for j in range(1, parts)], 0.05 / parts) if c > least]
        target = f"{self.path}/ranges/v{manifest['version'] + 1:010d}"
        new_lows = sorted({*lows, *cuts})
        numbered = merged.withColumn("_range", (self._number(new_lows) if new_lows else F.lit(0)).cast("int"))
        numbered.repartition("_range").sortWithinPartitions("_range", self.key).write.mode("overwrite").partitionBy("_range").parquet(target)
        written = {r["_range"] for r in numbered.select("_range").distinct().collect()}
        kept = {0 if i == 0 else new_lows.index(r["low"]) + 1: r for i, r in enumerate(ranges) if i not in touched}
        starts = [None, *new_lows]
        listed = [
            {"low": starts[i], "path": f"{target}/_range={i}"} if i in written else {**kept[i], "low": starts[i]}
            for i in range(len(starts)) if i in written or i in kept
        ]
        # A range that lost its rows to none starts with the next one.
        self._commit({**manifest, "ranges": listed, "changes": []})

    def read(self) -> DataFrame:
        """The current rows: changed keys by their last change, all others from their range."""
        manifest = self.manifest()
        if manifest["schema"] is None:
            raise FileNotFoundError(f"{self.path} holds no batch")
        base = self._rows(manifest, [r["path"] for r in manifest["ranges"]], False)
        if not manifest["changes"]:
            return base
        changes = self._latest(self._rows(manifest, manifest["changes"], True))
        return base.join(changes.select(self.key), self.key, "left_anti").unionByName(changes)
