"""How far a stream has come in event time.

Records older than a watermark's closed windows are dropped; Spark counts them
in ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

NEVER = "36500 days"


def bounded_disorder(
    df: DataFrame, delay: str = "2 seconds", time: str = "create_time"
) -> DataFrame:
    """The watermark trails the latest record by a fixed delay."""
    return df.withWatermark(time, delay)


def with_lateness(
    df: DataFrame, delay_s: float = 1, lateness_s: float = 1, time: str = "create_time"
) -> DataFrame:
    """Windows stay open for the delay and the allowed lateness. Run in ``update``
    mode a window is given out again for each late record until then; ``append``
    gives the final row only."""
    return df.withWatermark(time, f"{delay_s + lateness_s} seconds")


def punctuated_by_statuses(
    messages: DataFrame, statuses: DataFrame, time: str = "create_time"
) -> DataFrame:
    """Both topics as one stream whose watermark only statuses move, each to its
    own time. Messages carry a watermark that trails too far to matter; the query
    must run in a session whose watermark policy is 'max'."""
    policy = messages.sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy")
    if policy != "max":
        raise ValueError("use streaming_session(spark, watermark_policy='max')")
    return messages.withWatermark(time, NEVER).unionByName(
        statuses.withWatermark(time, "0 seconds")
    )
