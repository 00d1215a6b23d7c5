"""Joins on equality, lookups, and a join whose hot keys are split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.operators.sizes import fits_broadcast

# A key is hot when it holds more than 1/CHUNKS of its side or of all pairs. At
# most 3 * CHUNKS keys can, which bounds the table of hot keys.
CHUNKS = 1024
# Below these sizes splitting a key does not pay.
MIN_ROWS = 100_000
MIN_PAIRS = 20_000_000
LOOKUP_ROWS = 10_000
LOOKUP_BYTES = 4 << 20


def equi_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join on equality, all columns of both sides. Works for a stream on the
    left. Catalyst picks the strategy; adaptive execution splits hot keys."""
    return left.join(right, left[left_key] == right[right_key], how)


def count_joined(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    by: Sequence[str],
    alias: str = "user_count",
) -> DataFrame:
    """Rows of an equi-join per group of left columns, without making the pairs:
    each side is counted per key first, so a hot key costs one row."""
    lefts = left.where(F.col(left_key).isNotNull()).groupBy(*{*by, left_key}).agg(
        F.count(F.lit(1)).alias("_left_rows")
    )
    rights = right.groupBy(F.col(right_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_right_rows")
    )
    return (
        lefts.join(rights, F.col(left_key) == F.col("_key"))
        .groupBy(*by)
        .agg(F.sum(F.col("_left_rows") * F.col("_right_rows")).alias(alias))
    )


def _hot_keys(
    left: DataFrame, right: DataFrame, keys: list[str], chunks: int, min_rows: int, min_pairs: int
) -> DataFrame:
    """Keys to split, with the number of chunks for each side. A key's rows are
    cut so that no chunk exceeds a fair share of its side, and further until no
    pair of chunks makes more than a fair share of all pairs."""
    one, none = F.lit(1.0), F.lit(0.0)
    tagged = left.select(*keys, one.alias("l"), none.alias("r")).unionByName(
        right.select(*keys, none.alias("l"), one.alias("r"))
    )
    both = tagged.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    shares = both.agg(
        F.struct(
            F.greatest(F.sum("l") / chunks, F.lit(float(min_rows))).alias("l"),
            F.greatest(F.sum("r") / chunks, F.lit(float(min_rows))).alias("r"),
            F.greatest(F.sum(F.col("l") * F.col("r")) / chunks, F.lit(float(min_pairs))).alias(
                "pairs"
            ),
        )
    ).scalar()
    parts = both.withColumn("_share", shares).select(
        "*",
        F.greatest(F.ceil(F.col("l") / F.col("_share.l")), F.lit(1)).alias("_l"),
        F.greatest(F.ceil(F.col("r") / F.col("_share.r")), F.lit(1)).alias("_r"),
        F.ceil(F.col("l") * F.col("r") / F.col("_share.pairs")).alias("_cells"),
    )
    # Cutting a square of l x r pairs into this many stripes repeats fewest rows;
    # more stripes than cells would only repeat the other side.
    stripes = F.ceil(F.sqrt(F.col("_cells") * F.col("l") / F.nullif("r", F.lit(0.0))))
    more = F.col("_cells") > F.col("_l") * F.col("_r")
    parts = parts.withColumn(
        "_l", F.when(more, F.greatest("_l", F.least(stripes, "_cells", F.ceil("l")))).otherwise(F.col("_l"))
    ).withColumn(
        "_r",
        F.when(
            more, F.greatest("_r", F.least(F.ceil(F.col("_cells") / F.col("_l")), F.ceil("r")))
        ).otherwise(F.col("_r")),
    )
    return parts.where("_l > 1 OR _r > 1").select(
        *keys, F.col("_l").alias("_left_chunks"), F.col("_r").alias("_right_chunks")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    chunks: int = CHUNKS,
    min_rows: int = MIN_ROWS,
    min_pairs: int = MIN_PAIRS,
) -> DataFrame:
    """Inner equi-join for two large sides with hot keys.

    Keys are counted on both sides first, in a job of its own whose result, the
    hot keys, is bounded by ``chunks``. Rows of a hot key are spread over several
    chunks and the other side's rows of that key are repeated for each chunk, so
    every pair meets exactly once. Rows are dealt to the chunks in turn, in order
    of a hash of their content within their partition: equal rows are spread as
    well, and a recomputed task deals them alike. Without hot keys it is a plain
    join.
    """
    keys = list(keys)
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    found = _hot_keys(left, right, keys, chunks, min_rows, min_pairs)
    rows = found.collect()
    if not rows:
        return left.join(right, keys)
    hot = left.sparkSession.createDataFrame(rows, found.schema)

    def spread(df: DataFrame, own: str, other: str, own_salt: str, other_salt: str) -> DataFrame:
        # Rows of other keys have no place in the order, so they are not moved for it.
        content = F.xxhash64(*[F.col(c) for c in df.columns])
        return (
            df.join(F.broadcast(hot), keys, "left")
            .withColumn("_content", F.when(F.col(own).isNotNull(), content))
            .sortWithinPartitions("_content")
            .withColumn("_turn", F.monotonically_increasing_id())
            .withColumn(own_salt, F.pmod("_turn", F.coalesce(own, F.lit(1))))
            .withColumn(
                other_salt,
                F.explode(
                    F.sequence(
                        F.lit(0).cast("long"), (F.coalesce(other, F.lit(1)) - 1).cast("long")
                    )
                ),
            )
            .drop("_content", "_turn", "_left_chunks", "_right_chunks")
        )

    salted = [*keys, "_left_salt", "_right_salt"]
    # A number of partitions is given, as adaptive execution merges partitions by their
    # bytes and would put chunks of many pairs but few rows back into one task.
    pieces = sum(r["_left_chunks"] * r["_right_chunks"] for r in rows)
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, min(int(pieces), 2 * chunks))
    lefts = spread(left, "_left_chunks", "_right_chunks", "_left_salt", "_right_salt")
    rights = spread(right, "_right_chunks", "_left_chunks", "_right_salt", "_left_salt")
    lefts, rights = lefts.repartition(parts, *salted), rights.repartition(parts, *salted)
    return lefts.join(rights, salted).drop(
        "_left_salt", "_right_salt"
    )


def attach_rows(df: DataFrame, lookup: DataFrame, chunks: int | None = None) -> DataFrame:
    """Every record with every row of a lookup result, such as the rows of one
    key or of a small fixed table.

    The lookup's size is checked. A small one travels as one array value inside
    the plan and is unfolded in the scan of ``df``: one pass, no shuffle. Beyond
    the bound each record meets the lookup's rows through an equi-join on a
    chunk number, so that no task holds all of either side; there are four chunks
    for each shuffle partition of the session, which follows the data's size.
    """
    if fits_broadcast(lookup, LOOKUP_ROWS, LOOKUP_BYTES):
        rows = lookup.agg(F.collect_list(F.struct(*lookup.columns))).scalar()
        return df.select("*", F.inline(rows))
    if chunks is None:
        chunks = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    content = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    lefts = df.withColumn("_chunk", F.pmod(content, F.lit(chunks)).cast("int"))
    rights = lookup.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return lefts.join(rights, "_chunk").drop("_chunk")


def lookup_by_value(
    df: DataFrame, table: DataFrame, column: str, value, columns: Sequence[str]
) -> DataFrame:
    """The table's rows with ``column = value``, attached to each record."""
    return attach_rows(df, table.where(F.col(column) == value).select(*columns))


def count_attached(df: DataFrame, lookup: DataFrame, alias: str = "cnt") -> DataFrame:
    """Number of rows ``attach_rows`` would give, from one count per side."""
    rows = lookup.agg(F.count(F.lit(1))).scalar()
    return df.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") * rows).alias(alias))
