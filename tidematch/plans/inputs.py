"""The job's inputs derived from the driver's tables.

The tables hold no positions, so those come from key arithmetic that any engine
evaluates alike; the multipliers are fixed values of the test mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidematch.functions.jsontext import to_text
from tidematch.functions.timetext import SECONDS, epoch_micros
from tidematch.plans.coupon import parse_requests
from tidematch.session import use_utc, work_dir
from tidematch.sources.files import spread_scan, table_stream
from tidematch.sources.layout import write_by_place
from tidematch.sources.tables import write_partitioned

MESSAGE_TYPES = ("signup", "purchase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(key: str, factor: int, base: int):
    return (F.lit(base) + F.expr(f"{key} * {factor} % 10000") / F.lit(1e4)).cast("string")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as located users with day and night positions and a partition."""
    key = "c_custkey"
    return spread_scan(table(spark, sf_dir, "customer")).select(
        F.expr(f"cast({key} % 3 + 1 as string)").alias("cert_type"),
        F.col(key).cast("string").alias("cert_nbr"),
        _spread(key, 7919, 20).alias("lat"),
        _spread(key, 104729, 100).alias("lng"),
        _spread(key, 6827, 20).alias("lat_night"),
        _spread(key, 2909, 100).alias("lng_night"),
        F.expr(
            f"case {key} % 3 when 0 then '20220207' when 1 then '20220210' else '20220218' end"
        ).alias("partstart"),
    )


def request_lines(suppliers: DataFrame) -> DataFrame:
    """Suppliers as request messages. Every tenth store lies outside the area."""
    key = "s_suppkey"
    latitude = (
        F.lit(20)
        + F.expr(f"{key} * 6101 % 10000") / F.lit(1e4)
        + F.expr(f"case when {key} % 10 = 9 then 40 else 0 end")
    )
    return suppliers.select(
        to_text(
            F.struct(
                F.concat(F.lit("C"), key).alias("COUPON_ID"),
                F.expr(f"cast(5000 + {key} % 4 * 5000 as string)").alias("STORE_RANGE"),
                _spread(key, 3571, 100).alias("STORE_LONGITUDE"),
                latitude.cast("string").alias("STORE_LATITUDE"),
                F.expr(f"cast({key} % 50 as string)").alias("USER_NUM"),
                F.expr(f"case when {key} % 3 = 0 then '02' else '01' end").alias("MESSAGE_TYPE"),
                F.concat(F.lit("S"), key).alias("STORE_ID"),
                F.concat(F.lit("R"), key).alias("UNIQUE_REQ_ID"),
            )
        ).alias("value")
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_requests(request_lines(table(spark, sf_dir, "supplier")))


def topic_records(events: DataFrame) -> DataFrame:
    """Events as records of both topics: messages carry an id, statuses a code."""
    is_message = F.col("event_type").isin(*MESSAGE_TYPES)
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("trade_id"),
        F.when(is_message, F.concat(F.lit("m"), "event_id")).alias("msg_id"),
        F.when(~is_message, F.expr("cast(event_id % 10 as string)")).alias("status_code"),
        F.col("ts").cast("timestamp").alias("create_time"),
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_records(table(spark, sf_dir, "events"))


def topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_records(table_stream(spark, sf_dir, "events"))


ROUNDS = 4
# Of the records of a slice of time, those with this remainder come one round later.
LATE_OF, LATE = 7, 3


def topic_rounds(spark: SparkSession, sf_dir: str) -> tuple[list[DataFrame], int]:
    """The records as they are delivered, in ``ROUNDS`` slices of time and a last
    round, and the length of a slice in seconds. Every seventh record comes one round
    late, so up to a slice behind the latest one."""
    records = topics(spark, sf_dir)
    micros = epoch_micros(F.col("create_time"))
    low, high = records.agg(F.min(micros), F.max(micros)).first()
    slice_s = (high - low) // (ROUNDS * 1_000_000) + 1 if low is not None else 1
    number = F.floor((micros - F.lit(low)) / (slice_s * 1_000_000))
    late = (F.col("seq") % LATE_OF == LATE).cast("int")
    rounds = [records.where(number + late == k) for k in range(ROUNDS + 1)]
    return rounds, slice_s


def topic_lines(records: DataFrame) -> DataFrame:
    """Topic records as message text."""
    return records.select(
        to_text(
            F.struct(
                F.col("msg_id").alias("msgId"),
                F.col("trade_id").alias("tradeId"),
                F.col("status_code").alias("statusCode"),
                F.date_format("create_time", SECONDS).alias("createTime"),
            )
        ).alias("value")
    )


_partitioned: dict[tuple[str, str], str] = {}


def partitioned_users(spark: SparkSession, sf_dir: str) -> str:
    """The users written once per application as a folder partitioned by
    ``partstart``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _partitioned:
        path = work_dir(spark, "users")
        write_partitioned(users(spark, sf_dir), path)
        _partitioned[key] = path
    return _partitioned[key]


_placed: dict[tuple[str, str], str] = {}


def placed_users(spark: SparkSession, sf_dir: str) -> str:
    """The users written once per application by ``partstart`` and by place."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _placed:
        path = work_dir(spark, "users-by-place")
        write_by_place(users(spark, sf_dir), path)
        _placed[key] = path
    return _placed[key]
