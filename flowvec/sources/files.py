"""Small files in the folders that tables live in, through the session's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(hadoop)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder in order; none where it is not there."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place) if status.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    size = system.getFileStatus(place).getLen()
    stream = system.open(place)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file in place at once: a reader sees all of it or nothing.  A file of that name stays as it is and raises."""
    place, system = _place(spark, path)
    if system.exists(place):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    draft, _ = _place(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if not system.rename(draft, place):
        raise FileExistsError(path)
