"""Processors that take a bucket's keys in one call, over a state that is a plain dict."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tidematch.streaming import deltas, keyed, sessions


class Held:
    """A map, list or value state and the number of its entries that were touched."""

    def __init__(self):
        self.entries, self.rows, self.value, self.touched = {}, [], None, Counter()

    def getValue(self, name):
        self.touched[name] += 1
        return self.entries.get(name)

    def updateValue(self, name, value):
        self.touched[name] += 1
        self.entries[name] = value

    def get(self):
        return iter(list(self.rows)) if self.rows else self.value

    def appendValue(self, value):
        self.rows.append(value)

    def put(self, rows):
        self.rows = list(rows)

    def update(self, value):
        self.value = value

    def clear(self):
        self.rows, self.value = [], None


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getMapState(self, name, *_, **__):
        return self.states.setdefault(name, Held())

    getListState = getValueState = getMapState

    def registerTimer(self, end_ms):
        self.timers.add(end_ms)

    def deleteTimer(self, end_ms):
        self.timers.remove(end_ms)


class Clock:
    def __init__(self, watermark_ms):
        self.watermark_ms = watermark_ms

    def getCurrentWatermarkInMs(self):
        return self.watermark_ms


def started(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def call(processor, *frames):
    """The rows of one call, in no order."""
    found = [f for f in processor.handleInputRows((0,), iter(frames), None) if len(f)]
    rows = pd.concat(found).astype(object) if found else pd.DataFrame()
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in rows.to_numpy()), key=repr)


def test_sums_of_many_keys_in_one_call():
    rng = random.Random(3)
    processor = keyed.SumChanges()
    handle = started(processor)
    held, seq = {}, 0
    for _ in range(6):
        given, wanted = [], []
        for _ in range(40):
            seq += 1
            given.append((rng.choice(["a", "b", "c", "d", None]), rng.choice([None, 0, 1, -5]), seq))
        for name, score, at in given:
            old = held.get(name, "new")
            new = old if score is None else score + (old if old not in (None, "new") else 0)
            new = None if new == "new" else new
            if old == "new":
                wanted.append((True, name, new, at))
            elif new != old:
                wanted += [(False, name, old, at), (True, name, new, at)]
            held[name] = new
        rng.shuffle(given)
        frame = pd.DataFrame(
            [(n, s or 0, s is not None, at) for n, s, at in given], columns=["name", "score", "has_score", "seq"]
        )
        assert call(processor, frame[:25], frame[25:]) == sorted(wanted, key=repr)
    assert len(handle.states["totals"].entries) == 5


def test_join_counts_of_many_keys_in_one_call():
    processor = deltas.JoinCounts()
    handle = started(processor)
    columns = ["key", "is_left", "grp"]
    first = pd.DataFrame(
        [("1", True, "x"), ("1", True, "y"), ("2", True, "z"), ("1", False, None), ("3", False, None)],
        columns=columns,
    )
    assert call(processor, first) == [(True, "x", 1), (True, "y", 1)]
    more = pd.DataFrame(
        [("1", True, "x"), ("2", False, None), ("2", False, None), ("3", True, "w")], columns=columns
    )
    before = Counter(handle.states["counts"].touched)
    assert call(processor, more[:1], more[1:]) == [
        (False, "x", 1), (True, "w", 1), (True, "x", 2), (True, "z", 2),
    ]
    again = pd.DataFrame([("2", False, None)], columns=columns)
    assert call(processor, again) == [(False, "z", 2), (True, "z", 3)]
    # Of the state a call reads and writes only the keys that have rows.
    assert handle.states["counts"].touched[("3",)] == before[("3",)] + 2


def test_counts_of_many_names_in_one_call():
    processor = deltas.CountUpdates()
    started(processor)
    frame = pd.DataFrame({"name": ["a", "b", "a"]})
    assert call(processor, frame, frame) == [("a", 4), ("b", 2)]
    assert call(processor, pd.DataFrame({"name": ["c", "a"]})) == [("a", 5), ("c", 1)]


def test_messages_of_many_keys_in_one_call():
    processor = keyed.MessageMemory(1000)
    started(processor)
    columns = ["trade_id", "msg_id", "status_code", "at_us", "seq"]
    first = pd.DataFrame(
        [("t", None, "0", 1, 1), ("t", "m1", None, 2, 2), ("u", None, "9", 3, 3), (None, "n1", None, 1, 4)],
        columns=columns,
    )
    assert call(processor, first) == []
    more = pd.DataFrame(
        [("u", "m2", None, 5, 5), ("u", None, "3", 6, 6), ("t", None, None, 4, 7), ("t", "m3", None, 7, 8),
         ("t", None, "4", 8, 9), (None, None, "5", 2, 10), ("v", None, "6", 2, 11)],
        columns=columns,
    )
    assert call(processor, more) == sorted(
        [("u", "m2", "3"), ("t", "m1", None), ("t", "m3", "4"), (None, "n1", "5")], key=repr
    )


@pytest.mark.parametrize("at_once", [7, 100_000])
def test_sessions_of_many_keys_in_one_call(monkeypatch, at_once):
    """Records of several keys in disorder: every session that is over is given out once."""
    monkeypatch.setattr(sessions, "PAIRS_AT_ONCE", at_once)
    rng = random.Random(6)
    gap = 10_000
    processor = sessions.SessionPairs(gap)
    handle = started(processor)
    records, given, now = [], [], 0
    for _ in range(30):
        some = [
            (rng.choice("tuv"), now + rng.randrange(60) * 1000, rng.random() < 0.5, f"x{len(records) + k}")
            for k in range(rng.randrange(1, 9))
        ]
        records += some
        call(processor, pd.DataFrame(some, columns=processor.COLUMNS))
        now += 20_000  # nothing before it comes any more
        if min(handle.timers) <= now // 1000:
            handle.timers.remove(min(handle.timers))
            for frame in processor.handleExpiredTimer((0,), Clock(now // 1000), None):
                given += [tuple(r) for r in frame.astype(object).to_numpy()]
        assert len(handle.timers) <= 1
    wanted = []
    for key in "tuv":
        own = sorted(r[1:] for r in records if r[0] == key)
        breaks = np.flatnonzero(np.diff([r[0] for r in own]) > gap) + 1
        for session in (own[a:b] for a, b in zip([0, *breaks], [*breaks, len(own)])):
            first, last = session[0][0], session[-1][0]
            if (last + gap) // 1000 + 1 <= now // 1000:
                wanted += [
                    (key, first, last, m[2], m[0], s[2], s[0])
                    for m in session if m[1] for s in session if not s[1]
                ]
    assert sorted(given) == sorted(wanted) and len(wanted) > 50
