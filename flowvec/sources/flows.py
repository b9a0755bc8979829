"""Readers and writers of flow, packet, capture and vector files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvec import schemas
from flowvec.functions import vectors as V
from flowvec.operators.positions import number_rows

# Text for a missing address, longest kept packet description.
MISSING_ADDRESS = "N/A"
INFO_CHARS = 1000
PORT_PROTOCOLS = ["TCP", "UDP"]

# Blanks at the ends of a cell belong to it.
WRITE_CSV = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Flow CSV with a quoted header line; every column stays text.

    Missing cells come back as null; carriage returns at line ends are dropped.
    """
    raw = spark.read.schema(schemas.FLOW_CSV).csv(
        path, header=True, quote='"', escape='"', enforceSchema=True
    )
    return raw.toDF(*schemas.FLOW_COLUMNS)


def write_flows(df: DataFrame, path: str) -> None:
    """Write the flow columns as quoted CSV with the dotted header names."""
    names = [
        F.col(name).cast("string").alias(header)
        for header, name in schemas.FLOW_CSV_HEADER.items()
    ]
    df.select(*names).write.mode("overwrite").csv(path, **WRITE_CSV)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """Headerless packet CSV."""
    return spark.read.schema(schemas.PACKET_CSV).csv(path, header=False)


def read_split_files(spark: SparkSession, folder: str, pattern: str = "*split*") -> DataFrame:
    """Flow CSV files whose name matches, with the file each row came from."""
    raw = spark.read.schema(schemas.FLOW_CSV).csv(
        folder, header=True, quote='"', escape='"', pathGlobFilter=pattern, recursiveFileLookup=True
    )
    return raw.select(
        *[
            F.col(f"`{header}`").alias(name)
            for header, name in schemas.FLOW_CSV_HEADER.items()
        ],
        F.col("_metadata.file_name").alias("file_name"),
    )


def first_rows(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*key).limit(n)


def page(df: DataFrame, offset: int, n: int, *key: str) -> DataFrame:
    """``n`` rows after the first ``offset`` in key order."""
    return df.orderBy(*key).offset(offset).limit(n)


def normalize_capture(df: DataFrame) -> DataFrame:
    """Capture records with addresses: short info, ports of TCP and UDP only."""
    ip_rows = df.where(F.col("src").isNotNull() | F.col("dst").isNotNull())
    has_ports = F.col("transport").isin(PORT_PROTOCOLS)
    return ip_rows.withColumns(
        {
            "src": F.coalesce("src", F.lit(MISSING_ADDRESS)),
            "dst": F.coalesce("dst", F.lit(MISSING_ADDRESS)),
            "info": F.substring("info", 1, INFO_CHARS),
            "sport": F.when(has_ports, F.col("sport")),
            "dport": F.when(has_ports, F.col("dport")),
        }
    )


def payload_text(df: DataFrame, payload: str, name: str = "payload") -> DataFrame:
    """Raw payload bytes as text."""
    return df.withColumn(name, F.decode(payload, "UTF-8"))


def stack_trimmed(*tables: DataFrame, columns: list[str]) -> DataFrame:
    """Stack tables by column name after trimming the names, keeping ``columns``."""
    stacked = None
    for table in tables:
        part = table.toDF(*[c.strip() for c in table.columns]).select(*columns)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def write_vector_text(df: DataFrame, path: str, vec: str) -> None:
    """Typed CSV with the vector as bracketed text; missing cells read ``NULL``."""
    cells = [
        F.coalesce(V.to_text(F.col(c)) if c == vec else F.col(c).cast("string"), F.lit("NULL")).alias(c)
        for c in df.columns
    ]
    df.select(*cells).write.mode("overwrite").csv(path, **WRITE_CSV)


def read_vector_text(spark: SparkSession, path: str, schema: str, vec: str) -> DataFrame:
    """Read back :func:`write_vector_text` under the wanted column types."""
    wanted = spark.createDataFrame([], schema).schema
    text = spark.read.schema(", ".join(f"`{f.name}` string" for f in wanted)).csv(
        path, header=True, quote='"', escape='"'
    )
    return text.select(
        *[
            (
                V.from_text(F.col(f.name))
                if f.name == vec
                else F.nullif(F.col(f.name), F.lit("NULL")).cast(f.dataType)
            ).alias(f.name)
            for f in wanted
        ]
    )


def write_vector_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write a keyed vector table and return the rows it holds afterwards."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Operation rows as JSON lines, or as one JSON list with ``multiline``."""
    return spark.read.schema(schemas.METRIC_LOG).json(path, multiLine=multiline)


def read_resource_log(spark: SparkSession, path: str, schema=schemas.CPU_LOG) -> DataFrame:
    """Resource samples with a header line."""
    return spark.read.schema(schema).csv(path, header=True)


def read_sample_lines(spark: SparkSession, path: str, step: float = 0.1) -> DataFrame:
    """One value per line; a sample's time is its line number times ``step``.

    Lines are counted per split of a file, in the order of the splits.
    """
    lines = spark.read.text(path).select(
        F.col("value").try_cast("double").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_bucket"),
        F.monotonically_increasing_id().alias("_line"),
    )
    samples = lines.where(F.col("value").isNotNull())
    numbered = number_rows(samples, [F.col("_line")], "_i", ("file",))
    return numbered.select("file", ((F.col("_i") - 1) * step).alias("time_offset"), "value")


def recreate_table(df: DataFrame, path: str) -> None:
    """Drop what a table folder holds and write it anew."""
    df.write.mode("overwrite").parquet(path)


def drop_tables(spark: SparkSession, database: str) -> None:
    """Drop all tables of a database."""
    for table in spark.catalog.listTables(database):
        spark.sql(f"drop table if exists `{database}`.`{table.name}`")
