"""Sums, counts, limits and the top row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], value: str, alias: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def _times(weight: str | None, column: str | None = None) -> Column:
    """The number of rows, or of non-null values of a column; with ``weight`` a row counts
    as many times as that column says."""
    value = F.lit(1) if column is None else F.col(column)
    if weight is None:
        return F.count(value)
    return F.coalesce(F.sum(F.when(value.isNotNull(), F.col(weight))), F.lit(0)).cast("long")


def count_all(df: DataFrame, alias: str = "cnt", weight: str | None = None) -> DataFrame:
    return df.agg(_times(weight).alias(alias))


def count_by(
    df: DataFrame,
    keys: Sequence[str],
    column: str | None = None,
    alias: str = "cnt",
    weight: str | None = None,
) -> DataFrame:
    """Rows per key, or non-null values of a column per key; ``weight`` names a column with
    the number of rows that each stands for."""
    return df.groupBy(*keys).agg(_times(weight, column).alias(alias))


def groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct groups, without an aggregate."""
    return df.select(*keys).distinct()


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def count_of_limited(
    df: DataFrame, n: int, keys: Sequence[str] = (), alias: str = "cnt"
) -> DataFrame:
    """Counts over any ``n`` rows; which rows count is left open, as with every
    limit without an order."""
    return df.limit(n).groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def top_one(df: DataFrame, count: str, ties: Sequence[str]) -> DataFrame:
    """The row with the greatest count, compared as a number; equal counts go to
    the least ``ties``."""
    return df.orderBy(F.col(count).cast("long").desc(), *ties).limit(1)
