"""Running aggregates that no single task has to compute for a whole key.

Keys that hold a large share of all records are found first. Their records are
cut into blocks by the order column; each block is aggregated with partial
aggregation, a window over a key's block rows gives what came before each block,
and that value enters the block as one leading row. The window over the records
is partitioned by (key, block), so a heavy key is spread over many tasks while
all other keys cost one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidematch.operators.joins import CHUNKS

BLOCK = 100_000
# A key with fewer rows is no burden for one task.
HEAVY_ROWS = 1_000_000


def heavy_keys(
    df: DataFrame, keys: Sequence[str], chunks: int = CHUNKS, min_rows: int = HEAVY_ROWS
) -> DataFrame | None:
    """Keys with more than ``1/chunks`` of all rows, at most ``chunks`` of them,
    or None. Null counts as a key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    heavy = counts.where(
        (F.col("_n") > min_rows) & (F.col("_n") > F.coalesce(total, F.lit(0)) / chunks)
    ).select(*keys)
    rows = heavy.collect()
    return df.sparkSession.createDataFrame(rows, heavy.schema) if rows else None


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of the keys of two aliased inputs, null equal to null."""
    terms = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, terms)


def split_heavy(
    df: DataFrame, keys: Sequence[str], min_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Records of light keys, and those of heavy ones or None."""
    heavy = heavy_keys(df, keys, min_rows=min_rows)
    if heavy is None:
        return df, None
    few = F.broadcast(heavy).alias("h")
    light = df.alias("d").join(few, same_keys("d", "h", keys), "left_anti")
    return light, df.alias("d").join(few, same_keys("d", "h", keys), "left_semi")


def with_carry(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    aggregates: dict[str, Column],
    merge,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``df`` with ``_block``, which is 0 for all but heavy keys, and ``_carry``
    set on one more row per block of a heavy key: there the columns named in
    ``aggregates`` hold the aggregate of the key's earlier blocks. ``merge``
    combines block values over a window."""
    heavy = heavy_keys(df, keys, min_rows=min_rows)
    if heavy is None:
        return df.withColumns({"_block": F.lit(0).cast("long"), "_carry": F.lit(False)})
    blocked = (
        df.withColumn("_in_block", block)
        .alias("d")
        .join(
            F.broadcast(heavy.withColumn("_heavy", F.lit(True))).alias("h"),
            same_keys("d", "h", keys),
            "left",
        )
        .select("d.*", "h._heavy")
        .withColumn("_block", F.when(F.col("_heavy"), F.col("_in_block")).otherwise(0))
        .drop("_in_block")
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = (
        blocked.where("_heavy")
        .groupBy(*keys, "_block")
        .agg(*[value.alias(name) for name, value in aggregates.items()])
    )
    carried = sums.select(
        *keys, "_block", *[merge(F.col(name)).over(earlier).alias(name) for name in aggregates]
    ).withColumn("_carry", F.lit(True))
    return blocked.drop("_heavy").withColumn("_carry", F.lit(False)).unionByName(
        carried, allowMissingColumns=True
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    alias: str,
    block: int = BLOCK,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the key's records up to and including each one, and
    ``<alias>_before`` without it; ``_first`` marks the key's first record.

    ``order`` is an integer column, unique within a key, so a block of a heavy
    key holds at most ``block`` records.
    """
    counted = df.withColumn("_sum", F.col(value)).withColumn("_rows", F.lit(1).cast("long"))
    rows = with_carry(
        counted,
        keys,
        F.col(order) - F.pmod(F.col(order), F.lit(block)),
        {"_sum": F.sum("_sum"), "_rows": F.sum("_rows")},
        F.sum,
        min_rows,
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(
        F.col("_carry").desc(), F.col(order).asc()
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn(alias, F.sum("_sum").over(upto))
        .withColumn(f"{alias}_before", F.sum("_sum").over(before))
        .withColumn("_first", F.sum("_rows").over(upto) == 1)
        .where(~F.col("_carry"))
        .drop("_sum", "_rows", "_block", "_carry")
    )
