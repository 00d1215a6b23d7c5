"""Keyed time windows and the functions evaluated on them.

Window functions use aggregates of fixed size only (counts, first and last
records), so a hot key is pre-aggregated before the shuffle and no window is
ever held as a list. The same expressions serve batch and streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.functions.jsontext import (
    MESSAGE_DELAYED,
    MESSAGE_FAILED,
    MESSAGE_INCOMPLETE,
    error_envelope,
    not_empty,
    to_text,
)
from tidematch.functions.timetext import epoch_micros, window_label
from tidematch.operators.running import HEAVY_ROWS, split_heavy

KEY = "trade_id"


def pair_text(msg_id: Column, status: Column) -> Column:
    return to_text(F.struct(msg_id.alias("msgId"), status.alias("statusCode")))


def _order(time: str, sequence: str) -> Column:
    return F.struct(F.col(time), F.col(sequence))


def pair_aggregates(time: str = "create_time", sequence: str = "seq") -> dict[str, Column]:
    """Record count, and first and last record of either topic by (time, seq)."""
    order = _order(time, sequence)
    message, status = not_empty(F.col("msg_id")), ~not_empty(F.col("msg_id"))
    has_status = status & not_empty(F.col("status_code"))
    entry = F.struct(order.alias("at"), F.col("msg_id"), F.col("status_code"))
    return {
        "records": F.count(F.lit(1)),
        "first_message": F.min(F.when(message, entry)),
        "first_status": F.min(F.when(status, entry)),
        "last_message": F.max(F.when(message, entry)),
        "last_status": F.max(F.when(has_status, entry)),
    }


# How two partial results of pair_aggregates combine.
PAIR_MERGES = {
    "records": F.sum,
    "first_message": F.min,
    "first_status": F.min,
    "last_message": F.max,
    "last_status": F.max,
}


def pair_by_count(windows: DataFrame) -> DataFrame:
    """Windows with two records or more give the first message id and the first
    status; a lone message gives an error text; a lone status gives nothing."""
    pair = pair_text(F.col("first_message.msg_id"), F.col("first_status.status_code"))
    return windows.where("records > 1 OR first_message IS NOT NULL").select(
        *_bounds(windows),
        F.when(F.col("records") > 1, F.col("first_message.msg_id")).alias("msg_id"),
        F.col("first_status.status_code").alias("status_code"),
        F.when(F.col("records") > 1, pair)
        .otherwise(error_envelope(MESSAGE_DELAYED))
        .alias("value"),
    )


def pair_by_last(windows: DataFrame) -> DataFrame:
    """The last message id with the last status, or an error text when either is
    missing; every window gives a row."""
    complete = F.col("last_message").isNotNull() & F.col("last_status").isNotNull()
    msg_id, status = F.col("last_message.msg_id"), F.col("last_status.status_code")
    return windows.select(
        *_bounds(windows),
        F.when(complete, msg_id).alias("msg_id"),
        F.when(complete, status).alias("status_code"),
        F.when(complete, pair_text(msg_id, status))
        .otherwise(error_envelope(MESSAGE_INCOMPLETE))
        .alias("value"),
    )


def pair_or_failure(pairs: DataFrame) -> DataFrame:
    """Text of joined pairs; one without a message id becomes an error text."""
    text = F.when(
        not_empty(F.col("msg_id")), pair_text(F.col("msg_id"), F.col("status_code"))
    ).otherwise(error_envelope(MESSAGE_FAILED))
    return pairs.withColumn("value", text)


def _bounds(windows: DataFrame) -> list[Column]:
    return [
        *[F.col(c) for c in windows.columns if c not in ("window", *PAIR_MERGES)],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    ]


def tumbling(
    df: DataFrame,
    length: str,
    keys: Sequence[str] = (KEY,),
    time: str = "create_time",
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key and tumbling window. On a stream, set the watermark
    first."""
    values = aggregates or pair_aggregates(time)
    return df.groupBy(F.window(time, length), *keys).agg(
        *[v.alias(n) for n, v in values.items()]
    )


def window_info(
    df: DataFrame,
    length: str,
    keys: Sequence[str] = (KEY,),
    time: str = "create_time",
    result: str = "apply result",  # fixed value
) -> DataFrame:
    """Key, number of members, bounds as text, and a constant result."""
    counted = tumbling(df, length, keys, time, {"records": F.count(F.lit(1))})
    return counted.select(
        *keys,
        "records",
        window_label(F.col("window.start"), F.col("window.end")).alias("bounds"),
        F.lit(result).alias("result"),
    )


def window_members(df: DataFrame, length: str, time: str = "create_time") -> DataFrame:
    """Each record with its window's label, members being rows, not a list."""
    window = F.window(time, length)
    return df.withColumn("bounds", window_label(window["start"], window["end"]))


def slice_start(micros: Column, length_s: int) -> Column:
    """Start of the slice of time a moment lies in, in microseconds."""
    return micros - F.pmod(micros, F.lit(length_s * 1_000_000))


def slices_of(
    df: DataFrame, gap_s: int, keys: Sequence[str], time: str, aggregates: dict[str, Column]
) -> DataFrame:
    """One row per key and gap-long slice of time. Records of one slice are less
    than a gap apart, so they always share a session."""
    return (
        df.withColumn("_slice", slice_start(epoch_micros(F.col(time)), gap_s))
        .groupBy(*keys, "_slice")
        .agg(
            F.min(time).alias("_from"),
            F.max(time).alias("_to"),
            *[v.alias(n) for n, v in aggregates.items()],
        )
    )


def _slice_session(gap_s: int) -> Column:
    """Session window of a slice: from its first record to a gap past its last."""
    micros = epoch_micros(F.col("_to")) - epoch_micros(F.col("_from"))
    reach = F.make_interval(secs=micros.cast("decimal(18,0)") / 1_000_000 + F.lit(gap_s))
    return F.session_window(F.col("_from"), reach)


def sessions(
    df: DataFrame,
    gap_s: int,
    keys: Sequence[str] = (KEY,),
    time: str = "create_time",
    aggregates: dict[str, Column] | None = None,
    merges: dict | None = None,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per key and session, in batch. Records of heavy keys are first
    combined per gap-long slice of time with partial aggregation; only slices are
    merged into sessions, so such a key costs at most (time span / gap) rows in
    one task."""
    values = aggregates or pair_aggregates(time)
    merges = merges or PAIR_MERGES
    light, heavy = split_heavy(df, keys, min_rows)
    found = stream_sessions(light, f"{gap_s} seconds", keys, time, values)
    if heavy is None:
        return found
    merged = (
        slices_of(heavy, gap_s, keys, time, values)
        .groupBy(_slice_session(gap_s).alias("window"), *keys)
        .agg(*[merges[n](n).alias(n) for n in values])
    )
    return found.unionByName(merged)


def stream_sessions(
    df: DataFrame,
    gap: str,
    keys: Sequence[str] = (KEY,),
    time: str = "create_time",
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key and session; on a stream, set the watermark first."""
    values = aggregates or pair_aggregates(time)
    return df.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(
        *[v.alias(n) for n, v in values.items()]
    )
