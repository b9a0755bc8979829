"""A table kept as numbered versions: each change writes one, each reader names the one it wants."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowvec.sources import files


@dataclass(frozen=True)
class Version:
    number: int
    rows: int
    table: DataFrame


class VersionedTable:
    """Versions in folders of ``path``, numbered from 1.

    The rows of a version are counted while they are written, so its size costs
    no scan.  A version that was not finished has no number and is not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in files.names(self.spark, f"{self.path}/log") if n.startswith("v") and n.endswith(".json")]

    def write(self, df: DataFrame) -> Version:
        """Store ``df`` as the next version."""
        number = max(self.numbers(), default=0) + 1
        seen = Observation(f"version-{number}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.path}/v{number:010d}")
        entry = {"rows": seen.get["rows"], "schema": df.schema.jsonValue()}
        files.write_text(self.spark, f"{self.path}/log/v{number:010d}.json", json.dumps(entry))
        return self.read(number)

    def read(self, number: int | None = None) -> Version:
        """A version by its number, the newest one by default."""
        known = self.numbers()
        number = max(known, default=0) if number is None else number
        if number not in known:
            raise LookupError(f"{self.path} has no version {number}")
        entry = json.loads(files.read_text(self.spark, f"{self.path}/log/v{number:010d}.json"))
        table = self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{self.path}/v{number:010d}")
        return Version(number, entry["rows"], table)
