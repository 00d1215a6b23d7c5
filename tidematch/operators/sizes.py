"""Size checks before broadcasting, and cutting lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.session import checkpoint_root, work_dir

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the rows, measured as text, stay under both bounds. Reads at most
    one row beyond the bound."""
    widths = [
        F.coalesce(F.octet_length(_as_text(df, c)), F.lit(0)).cast("long") + 8
        for c in df.columns
    ]
    width = reduce(lambda a, b: a + b, widths)
    rows, size = (
        df.select(width.alias("w")).limit(max_rows + 1).agg(F.count("w"), F.sum("w")).first()
    )
    return rows <= max_rows and (size or 0) <= max_bytes


def _as_text(df: DataFrame, column: str):
    plain = df.schema[column].dataType.typeName() not in ("array", "map", "struct")
    return F.col(column).cast("string") if plain else F.to_json(F.struct(column))


@contextmanager
def kept(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows stored in the shared work folder while they are in use, for several
    consumers; the files go afterwards."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Keep the rows in the shared checkpoint folder, so that several consumers
    read them instead of computing them again and a lost executor costs none."""
    context = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)
