"""Text, delimited and Parquet files, in batch and as streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SEPARATOR = "\x01"
# What a micro-batch takes of a table, so also the most that one key holds of it.
BYTES_PER_TRIGGER = 512 << 20


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path of a location."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A bounded table from literal rows."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One row per line, column ``value``."""
    return (spark.readStream if stream else spark.read).text(path)


def delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = FIELD_SEPARATOR,
    header: bool = False,
    stream: bool = False,
) -> DataFrame:
    """Delimited text with a fixed schema; empty fields are null."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(sep=sep, header=header).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = FIELD_SEPARATOR) -> None:
    df.write.mode("overwrite").options(sep=sep, emptyValue="").csv(path)


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread the scan of a table in fewer files than cores over all cores, ahead
    of costly work. A table of many files keeps its splits and is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table_stream(
    spark: SparkSession, folder: str, name: str, bytes_per_trigger: int = BYTES_PER_TRIGGER
) -> DataFrame:
    """Stream the Parquet table ``folder/name.parquet``, a file or a folder of
    files. ``bytes_per_trigger`` bounds what one micro-batch may hold; a single
    file is never cut."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option(
        "maxBytesPerTrigger", bytes_per_trigger
    )
    files, location = file_system(spark, path)
    if files.getFileStatus(location).isFile():
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def numbered_rows(
    spark: SparkSession,
    rows: int,
    columns: Sequence[str] = ("id", "name", "work_day", "destination"),
    sep: str = FIELD_SEPARATOR,
) -> DataFrame:
    """Delimited test lines: the id, an empty field for day columns, and the
    column name followed by the id for the rest."""
    fields = [
        F.col("id").cast("string")
        if name == "id"
        else F.lit("")
        if "day" in name
        else F.concat(F.lit(name), F.col("id"))
        for name in columns
    ]
    return spark.range(rows).select(F.concat_ws(sep, *fields).alias("value"))
