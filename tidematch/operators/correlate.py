"""Two topics joined by key: inside a session, or by remembered state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidematch.functions.jsontext import not_empty
from tidematch.functions.timetext import epoch_micros
from tidematch.operators.joins import salted_join
from tidematch.operators.running import (
    BLOCK,
    HEAVY_ROWS,
    running_sum,
    same_keys,
    split_heavy,
    with_carry,
)
from tidematch.operators.sizes import cut_lineage
from tidematch.operators.windows import KEY, slice_start, slices_of


def _islands(df: DataFrame, gap_s: int, key: str, order: str) -> DataFrame:
    """Session start and end of rows that reach from ``_from`` to ``_to``."""
    gap = F.make_dt_interval(secs=F.lit(gap_s))
    in_order = Window.partitionBy(key).orderBy(order)
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("_to").over(in_order)
    opens = F.when(before.isNull() | (F.col("_from") > before + gap), F.col("_from"))
    return (
        df.withColumn("_opens", opens)
        .withColumn("session_start", F.last("_opens", ignorenulls=True).over(upto))
        .withColumn(
            "session_end", F.max("_to").over(Window.partitionBy(key, "session_start")) + gap
        )
        .drop("_opens", "_from", "_to")
    )


def with_session(
    df: DataFrame,
    gap_s: int,
    key: str = KEY,
    time: str = "create_time",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Each record with its session's start and end. For heavy keys sessions are
    found on gap-long slices, and records meet them by (key, slice), never by key
    alone."""
    light, heavy = split_heavy(df.dropna(subset=[time]), [key], min_rows)
    moment = F.col(time)
    placed = _islands(light.withColumns({"_from": moment, "_to": moment}), gap_s, key, time)
    if heavy is None:
        return placed
    found = _islands(slices_of(heavy, gap_s, [key], time, {}), gap_s, key, "_slice")
    in_slice = heavy.withColumn("_slice", slice_start(epoch_micros(moment), gap_s))
    columns = [F.col(f"d.{c}") for c in df.columns] + ["session_start", "session_end"]
    joined = in_slice.alias("d").join(
        found.alias("s"), same_keys("d", "s", [key, "_slice"])
    )
    return placed.unionByName(joined.select(*columns))


def session_join(
    messages: DataFrame,
    statuses: DataFrame,
    gap_s: int,
    key: str = KEY,
    time: str = "create_time",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Every message with every status of the same key and session. Sessions are
    formed over the records of both inputs together; the status is taken from
    the second input. Records with their sessions are stored once, for counting
    heavy sessions and for both sides of the join."""
    columns = [key, time, "msg_id", "status_code"]
    tagged = messages.select(*columns, F.lit(True).alias("_is_message")).unionByName(
        statuses.select(*columns, F.lit(False).alias("_is_message"))
    )
    placed = cut_lineage(with_session(tagged.dropna(subset=[key]), gap_s, key, time, min_rows))
    keys = [key, "session_start"]
    lefts = placed.where("_is_message").select(
        *keys, "session_end", "msg_id", F.col(time).alias("message_time")
    )
    rights = placed.where("NOT _is_message").select(
        *keys, "status_code", F.col(time).alias("status_time")
    )
    return salted_join(lefts, rights, keys)


def correlate_within(
    records: DataFrame,
    ttl_s: int,
    key: str = KEY,
    time: str = "create_time",
    sequence: str = "seq",
    block_s: int | None = None,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Each status with the key's latest earlier message, if that message is
    younger than the time to live; other statuses are dropped.

    A message arriving later replaces the one before and starts its life anew,
    as a state that is refreshed on write. The time of keys with more than
    ``min_rows`` records is cut into blocks of ``block_s`` (the time to live
    unless given).
    """
    micros = epoch_micros(F.col(time))
    latest = F.struct(micros.alias("at"), F.col(sequence).alias("no"), F.col("msg_id"))
    entries = records.select(
        key,
        sequence,
        "status_code",
        time,
        micros.alias("_at"),
        F.when(not_empty(F.col("msg_id")), latest).alias("_message"),
    )
    rows = with_carry(
        entries,
        [key],
        slice_start(F.col("_at"), block_s or ttl_s),
        {"_message": F.max("_message")},
        F.max,
        min_rows,
    )
    inside = (
        Window.partitionBy(key, "_block")
        .orderBy(F.col("_carry").desc(), "_at", sequence)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("_latest", F.max("_message").over(inside))
        .where(~F.col("_carry") & F.col("_message").isNull())
        .where(F.col("_at") - F.col("_latest.at") < ttl_s * 1_000_000)
        .select(key, sequence, F.col("_latest.msg_id").alias("msg_id"), "status_code", time)
    )


def state_history(
    records: DataFrame,
    keys: Sequence[str] = ("msg_id",),
    entry: Sequence[str] = ("msg_id", "status_code"),
    order: str = "seq",
    block: int = BLOCK,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Each record re-emitted with the number of distinct entries its key's state
    holds after it. ``order`` is an integer that orders a key's records; two keys
    may use the same numbers.

    An entry is new at its first record. Both that and the running count are
    windows within the key, so its records are shuffled once; a heavy key's
    entries are found by an aggregate instead and meet its records per entry.
    """
    group = list(dict.fromkeys([*keys, *entry]))
    light, heavy = split_heavy(records, keys, min_rows)
    first = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    marked = light.withColumn("_new", (first == 1).cast("long"))
    if heavy is not None:
        firsts = heavy.groupBy(*group).agg(F.min(order).alias("_first_at"))
        met = heavy.alias("d").join(
            firsts.alias("f"),
            same_keys("d", "f", group) & (F.col(f"d.{order}") == F.col("f._first_at")),
            "left",
        )
        new = F.col("f._first_at").isNotNull().cast("long").alias("_new")
        marked = marked.unionByName(met.select("d.*", new))
    return running_sum(marked, keys, "_new", order, "entries", block, min_rows).drop(
        "_new", "entries_before", "_first"
    )
