"""Filters, projections, renames and enrichment of single records."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.functions import jsontext
from tidematch.functions.timetext import SECONDS


def at_least(df: DataFrame, column: str, bound) -> DataFrame:
    return df.where(F.col(column) >= bound)


def starts_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def containing(df: DataFrame, text: str, prefix: str = "new", column: str = "value") -> DataFrame:
    """Lines holding a text, with a prefix put before them."""
    return df.where(F.col(column).contains(text)).withColumn(
        column, F.concat(F.lit(prefix), F.col(column))
    )


def set_json_field(
    df: DataFrame, name: str, json_value: str, column: str = "value"
) -> DataFrame:
    """Set a field of JSON objects of unknown shape."""
    return df.withColumn(column, jsontext.with_field(F.col(column), name, json_value))


def json_field_equals(df: DataFrame, name: str, value: str, column: str = "value") -> DataFrame:
    return df.where(F.get_json_object(column, f"$.{name}") == value)


def stamp_low_status(
    df: DataFrame, now: Column | None = None, below: int = 5, column: str = "status_code"
) -> DataFrame:
    """Keep records whose status is a number below the bound and stamp them."""
    return df.where(F.col(column).try_cast("int") < below).withColumn(
        "update_time", F.current_timestamp() if now is None else now
    )


def enrich_request(
    requests: DataFrame, request_type: str = "1", now: Column | None = None
) -> DataFrame:
    """Processing date, its text form and a constant type; ``now`` is the batch
    time unless given."""
    moment = F.current_timestamp() if now is None else now
    return (
        requests.withColumn("create_time", moment)
        .withColumn("type", F.lit(request_type))
        .withColumn("date_string", F.date_format(moment, SECONDS))
    )


def with_processing_time(
    df: DataFrame, name: str = "proctime", moment: Column | None = None
) -> DataFrame:
    """The time of the batch or micro-batch, the same for all of its rows;
    ``moment`` sets a fixed one, as for a repeated run."""
    return df.withColumn(name, F.current_timestamp() if moment is None else moment)


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Choose and rename columns."""
    return df.select(*[F.col(c).alias(name) for c, name in columns.items()])


def query_view(df: DataFrame, name: str, sql: str, args: Mapping | None = None) -> DataFrame:
    """Register ``df`` as a view and query it; parameters are bound, not pasted."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql, args=dict(args) if args else None)


def append_parameter(df: DataFrame, column: str, value: str) -> DataFrame:
    """Append '-' and a job parameter to a text column."""
    return df.withColumn(column, F.concat(F.col(column), F.lit("-"), F.lit(value)))


def observed(df: DataFrame, name: str) -> DataFrame:
    """Pass records through unchanged and count them on the way."""
    return df.observe(name, F.count(F.lit(1)).alias("records"))


def rowwise(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Arbitrary code over batches of rows: ``fn`` maps an iterator of pandas
    frames. For logic no column expression can state."""
    return df.mapInPandas(fn, schema)


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs' rows, duplicates kept; columns missing on one side are null."""
    return left.unionByName(right, allowMissingColumns=True)
