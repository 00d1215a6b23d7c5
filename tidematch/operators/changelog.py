"""The changes an updating aggregate goes through, record by record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.operators.running import BLOCK, HEAVY_ROWS, running_sum


def sum_changelog(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    alias: str = "total",
    block: int = BLOCK,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Rows ``(is_add, keys, alias, order)``: each record that changes its key's
    sum retracts the old one and adds the new one; the first only adds."""
    rows = df.select(*keys, value, order)
    sums = running_sum(rows, keys, value, order, alias, block, min_rows)
    old, new = F.col(f"{alias}_before"), F.col(alias)
    retract = F.struct(F.lit(False).alias("is_add"), old.alias(alias))
    add = F.struct(F.lit(True).alias("is_add"), new.alias(alias))
    changes = F.when(F.col("_first"), F.array(add)).when(
        ~old.eqNullSafe(new), F.array(retract, add)
    )
    return sums.select(*keys, order, F.explode(changes).alias("change")).select(
        "change.is_add", *keys, f"change.{alias}", order
    )


def net_result(changes: DataFrame, keys: Sequence[str], alias: str = "total") -> DataFrame:
    """Replay a changelog: rows added more often than retracted remain."""
    net = F.sum(F.when(F.col("is_add"), 1).otherwise(-1))
    return changes.groupBy(*keys, alias).agg(net.alias("_net")).where("_net > 0").drop("_net")
