"""Two streams joined by key inside sessions that grow and merge as records come.

Records lie in list state, by bucket of their keys, until their session can change no
more. A record opens a session, widens one, or bridges several, also when it comes in
a later micro-batch than its neighbours. A timer in event time stands where the first
session of a bucket may end; once the watermark is past a session's end no record can
reach it, its pairs are given out and its records freed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidematch.functions.timetext import epoch_micros
from tidematch.operators.windows import KEY
from tidematch.streaming import buckets

#: Pairs in one piece of output.
PAIRS_AT_ONCE = 100_000

Span = tuple[int, int]


def merged(spans: list[Span], gap_us: int) -> list[Span]:
    """Spans that are at most a gap apart become one."""
    out: list[Span] = []
    for first, last in sorted(spans):
        if out and first - out[-1][1] <= gap_us:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def spans_of(at: np.ndarray, gap_us: int) -> list[Span]:
    """The spans of some moments."""
    at = np.sort(at)
    opens = np.flatnonzero(np.r_[True, np.diff(at) > gap_us])
    ends = np.r_[opens[1:], len(at)] - 1
    return list(zip(at[opens].tolist(), at[ends].tolist()))


class SessionPairs(StatefulProcessor):
    """Every message with every status of the same key and session. A bucket has one
    timer, never later than its first session's end, and closes all that are over."""

    OUTPUT = (
        "trade_id string, start_us bigint, last_us bigint, msg_id string, "
        "message_us bigint, status_code string, status_us bigint"
    )
    #: Many records as columns; the list has one such row for each micro-batch.
    RECORDS = (
        "trade_id array<string>, at_us array<bigint>, is_message array<boolean>, text array<string>"
    )
    COLUMNS = ["trade_id", "at_us", "is_message", "text"]

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", self.RECORDS)
        self.timer = handle.getValueState("timer", "end_ms bigint")

    def _end_ms(self, last_us: int) -> int:
        """The first watermark at which no record reaches the session any more; one
        that comes exactly a gap after the last still does."""
        return (last_us + self.gap_us) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        ends = []
        for frame in rows:
            self.records.appendValue(self._columns(frame))
            ends.append(self._end_ms(int(frame["at_us"].min())))
        set_for = self.timer.get()
        if set_for is None or min(ends) < set_for[0]:
            if set_for is not None:
                self.handle.deleteTimer(set_for[0])
            self._set_timer(min(ends))
        yield from ()

    def _columns(self, frame: pd.DataFrame) -> tuple:
        texts = frame["text"].astype(object)
        plain = frame.assign(text=texts.where(texts.notna(), None))
        return tuple(plain[c].tolist() for c in self.COLUMNS)

    def _set_timer(self, end_ms: int) -> None:
        self.handle.registerTimer(end_ms)
        self.timer.update((end_ms,))

    def _held(self) -> pd.DataFrame:
        """The records by key and time, with their session's number and bounds."""
        parts = [pd.DataFrame(dict(zip(self.COLUMNS, part))) for part in self.records.get()]
        frame = pd.concat(parts, ignore_index=True)
        frame = frame.sort_values(["trade_id", "at_us"], ignore_index=True)
        name, at = frame["trade_id"].to_numpy(), frame["at_us"].to_numpy(dtype="int64")
        opens = np.r_[True, (name[1:] != name[:-1]) | (np.diff(at) > self.gap_us)]
        number = np.cumsum(opens) - 1
        first = np.flatnonzero(opens)
        last = np.r_[first[1:], len(at)] - 1
        return frame.assign(number=number, first=at[first][number], last=at[last][number])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self._held()
        end_ms = self._end_ms(held["last"])
        over = end_ms <= timerValues.getCurrentWatermarkInMs()
        left = held[~over]
        if over.any():
            if len(left):
                self.records.put([self._columns(left)])
            else:
                self.records.clear()
        if len(left):
            self._set_timer(int(end_ms[~over].min()))
        else:
            self.timer.clear()
        yield from self._closed(held[over])

    def _closed(self, records: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The pairs of closed sessions, of many small sessions together."""
        is_message = records["is_message"].astype(bool)
        messages, statuses = records[is_message], records[~is_message]
        sizes = (
            messages.groupby("number").size().rename("m").to_frame()
            .join(statuses.groupby("number").size().rename("s"), how="inner")
        )
        pairs = sizes["m"] * sizes["s"]
        for number in pairs.index[pairs > PAIRS_AT_ONCE]:
            some, others = messages[messages["number"] == number], statuses[statuses["number"] == number]
            yield from self._pairs(
                some["trade_id"].iloc[0], int(some["first"].iloc[0]), int(some["last"].iloc[0]),
                list(zip(some["at_us"], some["text"])), list(zip(others["at_us"], others["text"])),
            )
        small = pairs[pairs <= PAIRS_AT_ONCE]
        piece = (small.cumsum() // PAIRS_AT_ONCE).rename("piece")
        for _, numbers in piece.groupby(piece):
            met = messages[messages["number"].isin(numbers.index)].merge(
                statuses[["number", "at_us", "text"]], on="number", suffixes=("", "_s")
            )
            yield pd.DataFrame(
                {
                    "trade_id": met["trade_id"],
                    "start_us": met["first"],
                    "last_us": met["last"],
                    "msg_id": met["text"],
                    "message_us": met["at_us"],
                    "status_code": met["text_s"],
                    "status_us": met["at_us_s"],
                }
            )

    @staticmethod
    def _pairs(key, first, last, messages, statuses) -> Iterator[pd.DataFrame]:
        """All pairs, in pieces."""
        wide = max(1, PAIRS_AT_ONCE // max(1, min(len(statuses), PAIRS_AT_ONCE)))
        for a in range(0, len(messages), wide):
            some = messages[a : a + wide]
            for b in range(0, len(statuses), PAIRS_AT_ONCE):
                others = statuses[b : b + PAIRS_AT_ONCE]
                yield pd.DataFrame(
                    {
                        "trade_id": key,
                        "start_us": first,
                        "last_us": last,
                        "msg_id": np.repeat([text for _, text in some], len(others)),
                        "message_us": np.repeat([at for at, _ in some], len(others)),
                        "status_code": [text for _, text in others] * len(some),
                        "status_us": [at for at, _ in others] * len(some),
                    }
                )

    def close(self) -> None:
        pass


def session_pairs(
    messages: DataFrame,
    statuses: DataFrame,
    gap_s: int,
    key: str = KEY,
    time: str = "create_time",
) -> DataFrame:
    """The streaming form of ``correlate.session_join``: every message with every
    status of the same key and session, sessions being formed over the records of
    both inputs. Pairs are given out when the watermark closes their session; both
    inputs need one on ``time``. Records without a key or a time are left out.

    A bucket's open sessions and their records are held by the task that has the bucket.
    """
    def side(df: DataFrame, text: str, is_message: bool) -> DataFrame:
        return df.dropna(subset=[key, time]).select(
            F.col(key).alias("trade_id"),
            F.col(time),
            epoch_micros(F.col(time)).alias("at_us"),
            F.lit(is_message).alias("is_message"),
            F.col(text).alias("text"),
        )

    both = side(messages, "msg_id", True).unionByName(side(statuses, "status_code", False))
    found = buckets.run(both, "trade_id", SessionPairs(gap_s * 1_000_000), "EventTime")
    moment = lambda c: F.timestamp_micros(F.col(c))
    return found.select(
        F.col("trade_id").alias(key),
        moment("start_us").alias("session_start"),
        F.timestamp_micros(F.col("last_us") + gap_s * 1_000_000).alias("session_end"),
        "msg_id",
        moment("message_us").alias("message_time"),
        "status_code",
        moment("status_us").alias("status_time"),
    )
