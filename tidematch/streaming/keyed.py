"""Keyed state that windows and joins cannot express.

The rows of one micro-batch, of a key or of a bucket of keys, are put in order and
handled as columns; the source's limit of bytes per trigger bounds what a task holds
of them. State is read and written once per key and micro-batch, or once per new entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidematch.functions.timetext import epoch_micros
from tidematch.operators.windows import KEY
from tidematch.session import ship_package
from tidematch.streaming import buckets


def _text(value) -> str:
    """A text cell, with null and missing as ''."""
    return value if isinstance(value, str) else ""


def _in_order(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """All of a key's rows of a micro-batch; they come in chunks."""
    return pd.concat(list(rows), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


def _last_message(frame: pd.DataFrame, held: tuple | None) -> pd.DataFrame:
    """``frame`` in order with the columns ``held_id``, ``held_at`` and ``held_seq``:
    the latest message at or before each row. ``held``, remembered from earlier
    micro-batches as (msg_id, at_us, seq), takes its place among them."""
    if held is not None:
        first = pd.DataFrame(
            {"at_us": [held[1]], "seq": [held[2]], "msg_id": [held[0]], "status_code": [None]}
        )
        frame = pd.concat([first.assign(own=False), frame.assign(own=True)], ignore_index=True)
        frame = frame.sort_values(["at_us", "seq"], kind="stable", ignore_index=True)
    else:
        frame = frame.assign(own=True)
    is_message = (frame["msg_id"].map(_text) != "").to_numpy()
    # The place of the last message so far, -1 before the first.
    place = np.maximum.accumulate(np.where(is_message, np.arange(len(frame)), -1))
    known = place >= 0
    at = np.where(known, place, 0)
    return frame.assign(
        is_message=is_message,
        held_id=frame["msg_id"].to_numpy()[at],
        held_at=frame["at_us"].to_numpy()[at],
        held_seq=frame["seq"].to_numpy()[at],
        known=known,
    )


class MessageMemory(StatefulProcessor):
    """Remembers each key's message id for ``ttl_ms`` after it was last written and
    pairs later statuses with it. ``ttl_ms`` counts processing time."""

    OUTPUT = "trade_id string, msg_id string, status_code string"

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.memory = handle.getMapState(
            "messages", "trade_id string", "msg_id string", ttlDurationMs=self.ttl_ms
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        frame, names, starts = buckets.in_order(rows, "trade_id", ["at_us", "seq"])
        code, ids = frame["code"].to_numpy(), frame["msg_id"].to_numpy(dtype=object)
        is_message = (frame["msg_id"].map(_text) != "").to_numpy()
        # The place of the last message so far, before the key's first row if there is none.
        place = np.maximum.accumulate(np.where(is_message, np.arange(len(frame)), -1))
        known = place >= starts[code]
        before = np.full(len(names), None, dtype=object)
        for asked in np.unique(code[~known & ~is_message]):
            live = self.memory.getValue((names[asked],))
            before[asked] = live[0] if live is not None else None
        held = np.where(known, ids[place], before[code])
        for last in np.r_[starts[1:], len(frame)] - 1:
            if known[last]:
                self.memory.updateValue((names[code[last]],), (held[last],))
        paired = ~is_message & pd.notna(held)
        yield pd.DataFrame(
            {
                "trade_id": frame["trade_id"][paired],
                "msg_id": held[paired],
                "status_code": frame["status_code"][paired],
            }
        )

    def close(self) -> None:
        pass


class EventMemory(StatefulProcessor):
    """As ``MessageMemory``, with the time to live counted in event time, so that
    a replay gives the same result. The message that is later in event time is
    kept, whichever micro-batch brings it; a timer frees the key once the
    watermark has passed its life."""

    OUTPUT = "trade_id string, seq bigint, msg_id string, status_code string"

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_us = ttl_ms * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("message", "msg_id string, at_us bigint, seq bigint")

    def _end_ms(self, at_us: int) -> int:
        return -(-(at_us + self.ttl_us) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        before = self.memory.get() if self.memory.exists() else None
        seen = _last_message(_in_order(rows, ["at_us", "seq"]), before)
        if len(seen) and seen["known"].iloc[-1]:
            last = seen.iloc[-1]
            after = (last["held_id"], int(last["held_at"]), int(last["held_seq"]))
            if before is None or tuple(before) != after:
                if before is not None:
                    self.handle.deleteTimer(self._end_ms(before[1]))
                self.memory.update(after)
                self.handle.registerTimer(self._end_ms(after[1]))
        young = seen["at_us"] - seen["held_at"] < self.ttl_us
        paired = seen["own"] & ~seen["is_message"] & seen["known"] & young
        yield pd.DataFrame(
            {
                "trade_id": key[0],
                "seq": seen["seq"][paired],
                "msg_id": seen["held_id"][paired],
                "status_code": seen["status_code"][paired],
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.memory.clear()
        yield from ()

    def close(self) -> None:
        pass


class EntryHistory(StatefulProcessor):
    """Remembers each message id and status without expiry and re-emits every
    record with the number of entries held and the time of its handling."""

    OUTPUT = (
        "msg_id string, status_code string, seq bigint, entries bigint, "
        "update_time timestamp"
    )

    def init(self, handle) -> None:
        self.entries = handle.getMapState("entries", "entry string", "msg_id string")
        self.size = handle.getValueState("size", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        frame = _in_order(rows, ["seq"])
        size = self.size.get()[0] if self.size.exists() else 0
        # Length first, so that two columns never read as the same entry.
        ids = frame["msg_id"].map(_text)
        entry = ids.str.len().astype(str) + ":" + ids + frame["status_code"].map(_text)
        fresh = ~entry.duplicated()
        for row in entry.index[fresh]:  # each entry of the micro-batch once
            name = (entry[row],)
            if self.entries.containsKey(name):
                fresh[row] = False
            else:
                self.entries.updateValue(name, (ids[row],))
        counted = size + fresh.cumsum()
        if fresh.any():
            self.size.update((int(counted.iloc[-1]),))
        yield frame.assign(entries=counted, update_time=pd.Timestamp.now())[
            ["msg_id", "status_code", "seq", "entries", "update_time"]
        ]

    def close(self) -> None:
        pass


class ProcessingWindows(StatefulProcessor):
    """One key's window in processing time, given out by a timer even when no
    more data comes. A tumbling window ends at the next multiple of the length; a
    session ends one length after its last records."""

    OUTPUT = (
        "trade_id string, start_ms bigint, end_ms bigint, records bigint, first_message string, "
        "first_status string, last_message string, last_status string"
    )
    EMPTY = (0, None, None, None, None)

    def __init__(self, length_ms: int, session: bool) -> None:
        self.length_ms, self.session = length_ms, session

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", self.OUTPUT.split(", ", 1)[1])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        start, end = now, now + self.length_ms
        if not self.session:
            start = now - now % self.length_ms
            end = start + self.length_ms
        held = self.EMPTY
        if self.window.exists():
            old_start, old_end, *old = self.window.get()
            self.handle.deleteTimer(old_end)
            if old_end <= now:
                yield self._row(key, old_start, old_end, old)
            else:
                start, held = old_start, old
        self.window.update((start, end, *self._extended(held, pd.concat(list(rows)))))
        self.handle.registerTimer(end)

    @staticmethod
    def _extended(held, frame: pd.DataFrame) -> tuple:
        count, first_message, first_status, last_message, last_status = held
        frame = frame.sort_values(["at_us", "seq"])
        is_message = frame["msg_id"].map(_text) != ""
        messages = frame["msg_id"][is_message]
        statuses = frame["status_code"][~is_message].map(_text)
        filled = statuses[statuses != ""]
        if first_message is None and len(messages):
            first_message = messages.iloc[0]
        if first_status is None and len(statuses):
            first_status = statuses.iloc[0]
        if len(messages):
            last_message = messages.iloc[-1]
        if len(filled):
            last_status = filled.iloc[-1]
        return count + len(frame), first_message, first_status, last_message, last_status

    def _row(self, key, start, end, values) -> pd.DataFrame:
        names = [field.split()[0] for field in self.OUTPUT.split(", ")]
        return pd.DataFrame([(key[0], start, end, *values)], columns=names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start, end, *values = self.window.get()
        self.window.clear()
        yield self._row(key, start, end, values)

    def close(self) -> None:
        pass


class SumChanges(StatefulProcessor):
    """Each key's sum and the retract and add rows of every change to it. A null
    score leaves the sum as it is; before the first other score it is null."""

    OUTPUT = "is_add boolean, name string, total bigint, seq bigint"

    def init(self, handle) -> None:
        self.totals = handle.getMapState("totals", "name string", "total bigint, known boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        frame, names, starts = buckets.in_order(rows, "name", ["seq"])
        held = [self.totals.getValue((name,)) for name in names]
        code = frame["code"].to_numpy()
        started = np.array([h is not None for h in held])[code]
        held_sum = np.array([h[0] if h else 0 for h in held], dtype="int64")[code]
        held_known = np.array([bool(h and h[1]) for h in held])[code]
        by_key = frame.assign(scores=frame["has_score"].astype("int64")).groupby("code")
        sums = held_sum + by_key["score"].cumsum().to_numpy()
        filled = held_known | (by_key["scores"].cumsum().to_numpy() > 0)
        before, before_filled = np.roll(sums, 1), np.roll(filled, 1)
        before[starts], before_filled[starts] = held_sum[starts], held_known[starts]
        change = (sums != before) | (filled != before_filled)
        add, retract = change.copy(), change.copy()
        add[starts] |= ~started[starts]
        retract[starts] &= started[starts]
        seq, name = frame["seq"].to_numpy(), frame["name"].to_numpy(dtype=object)

        def rows_of(which, totals, is_null, is_add):
            values = pd.array(totals[which], dtype="Int64")
            values[is_null[which]] = pd.NA
            return pd.DataFrame(
                {"is_add": is_add, "name": name[which], "total": values, "seq": seq[which]}
            )

        for last in np.r_[starts[1:], len(frame)] - 1:
            after = (int(sums[last]), bool(filled[last]))
            before_row = held[code[last]]
            if before_row is None or tuple(before_row) != after:
                self.totals.updateValue((names[code[last]],), after)
        yield pd.concat(
            [rows_of(retract, before, ~before_filled, False), rows_of(add, sums, ~filled, True)],
            ignore_index=True,
        )

    def close(self) -> None:
        pass


def _run(rows: DataFrame, key: str, processor: StatefulProcessor, time_mode: str) -> DataFrame:
    ship_package(rows.sparkSession)  # the processors are pickled by name
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.OUTPUT,
        outputMode="Append",
        timeMode=time_mode,
    )


def _topic_rows(records: DataFrame, key: str, *more: str) -> DataFrame:
    return records.select(
        F.col(key).alias("trade_id"),
        "msg_id",
        "status_code",
        epoch_micros(F.col("create_time")).alias("at_us"),
        "seq",
        *more,
    )


def correlate_by_state(records: DataFrame, ttl_ms: int, key: str = KEY) -> DataFrame:
    """State with a time to live in processing time."""
    return buckets.run(
        _topic_rows(records, key), "trade_id", MessageMemory(ttl_ms), "ProcessingTime"
    )


def correlate_by_event_state(records: DataFrame, ttl_ms: int, key: str = KEY) -> DataFrame:
    """State with a time to live in event time. ``records`` need a watermark on
    ``create_time``; rows behind it are dropped as late."""
    rows = _topic_rows(records, key, "create_time")
    return _run(rows, "trade_id", EventMemory(ttl_ms), "EventTime")


def processing_windows(
    records: DataFrame, length_ms: int, session: bool = False, key: str = KEY
) -> DataFrame:
    """Windows in processing time, in the form the pair functions take."""
    processor = ProcessingWindows(length_ms, session)
    found = _run(_topic_rows(records, key), "trade_id", processor, "ProcessingTime")

    def entry(column: str, field: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias(field)))

    return found.select(
        "trade_id",
        F.struct(
            F.timestamp_millis("start_ms").alias("start"),
            F.timestamp_millis("end_ms").alias("end"),
        ).alias("window"),
        "records",
        entry("first_message", "msg_id").alias("first_message"),
        entry("first_status", "status_code").alias("first_status"),
        entry("last_message", "msg_id").alias("last_message"),
        entry("last_status", "status_code").alias("last_status"),
    )


def entry_history(records: DataFrame) -> DataFrame:
    rows = records.select("msg_id", "status_code", "seq")
    return _run(rows, "msg_id", EntryHistory(), "None")


def sum_changes(records: DataFrame) -> DataFrame:
    """Changelog of ``sum(score)`` per ``name``; ``seq`` orders a micro-batch."""
    score = F.col("score").cast("bigint")
    rows = records.select(
        "name",
        F.coalesce(score, F.lit(0).cast("bigint")).alias("score"),
        score.isNotNull().alias("has_score"),
        "seq",
    )
    return buckets.run(rows, "name", SumChanges())
