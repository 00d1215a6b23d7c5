"""Side outputs: one input, several named outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.operators.sizes import kept

MAIN, SIDE = "main", "side"
ITEM, ITEM_COPY, COUNT = "item", "item_copy", "count"


def route(df: DataFrame, to_main: Column) -> DataFrame:
    """Mark each record ``main`` or ``side``; an unknown condition is side."""
    return df.withColumn("route", F.when(to_main, F.lit(MAIN)).otherwise(F.lit(SIDE)))


def copies(df: DataFrame, routes: Column) -> DataFrame:
    """One row per record and entry of the ``routes`` array; none, no row."""
    return df.withColumn("route", F.explode(routes))


def both(df: DataFrame) -> DataFrame:
    """Each record on the main and on the side output."""
    return copies(df, F.array(F.lit(MAIN), F.lit(SIDE)))


def split_requests(requests: DataFrame) -> DataFrame:
    """Type '01' goes to two item outputs, '02' to the count output; requests of
    another type are dropped."""
    return copies(
        requests,
        F.when(F.col("message_type") == "01", F.array(F.lit(ITEM), F.lit(ITEM_COPY))).when(
            F.col("message_type") == "02", F.array(F.lit(COUNT))
        ),
    )


def taken(df: DataFrame, name: str) -> DataFrame:
    """One output."""
    return df.where(F.col("route") == name).drop("route")


def write_routes(writers: Mapping[str, Callable[[DataFrame, int], None]]) -> Callable:
    """A ``foreachBatch`` function that computes a routed micro-batch once and
    hands each output and the batch's number to its writer. Writers such as
    ``jobs.write_batch`` replace what an earlier try of the batch wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch, "routed") as rows:
            for name, writer in writers.items():
                writer(taken(rows, name), batch_id)

    return write
