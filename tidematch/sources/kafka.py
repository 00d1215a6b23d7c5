"""Kafka topics. The connector ships separately from Spark
(``spark-sql-kafka-0-10``); the option builders work without it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidematch.functions.jsontext import BAD, probe
from tidematch.schemas import TOPIC_FIELDS, TOPIC_JSON, TOPIC_TIME_OPTIONS

# Topic names are fixed values.
TOPIC_COUPON_INPUT = "coupon-input"
TOPIC_COUPON_OUTPUT = "coupon-output"

# Bounds what one micro-batch may bring.
OFFSETS_PER_TRIGGER = 50_000_000


def source_options(
    servers: str,
    topics: str | Sequence[str],
    start: str = "latest",
    start_timestamp_ms: int | None = None,
    max_per_trigger: int = OFFSETS_PER_TRIGGER,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``start`` is 'earliest', 'latest' or per-partition JSON
    and only counts for a new query: a query resumes from its checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }
    if start_timestamp_ms is None:
        options["startingOffsets"] = start
    else:
        options["startingTimestamp"] = str(start_timestamp_ms)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def topic_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Topic, value as text and the broker's time; one or several topics."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string").alias("value"), "timestamp")
    )


def decode(
    lines: DataFrame,
    schema: T.StructType,
    names: Mapping[str, str],
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Parse ``value`` and rename its fields. Text that is no such record is
    dropped; other columns of the input are kept."""
    others = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*others, probe(F.col("value"), schema, options).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col(f"r.{BAD}").isNull()).select(
        *others, *[F.col(f"r.{field}").alias(name) for field, name in names.items()]
    )


def decode_topic(lines: DataFrame) -> DataFrame:
    return decode(lines, TOPIC_JSON, TOPIC_FIELDS, TOPIC_TIME_OPTIONS)


def sink_writer(
    values: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    """Write column ``value`` to a topic. Delivery is at least once; where a
    record must count once, use a file sink or a key readers can deduplicate."""
    return values.select(F.col("value").cast("string")).writeStream.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "topic": topic,
            "checkpointLocation": checkpoint,
        }
    )
