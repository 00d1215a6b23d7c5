"""Updating results as changes: counts over a join, and the top rows of counts.

A change is a row that takes back an old result (``is_add`` false) or adds a new
one. State holds counts, never the rows that were counted.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidematch.session import ship_package
from tidematch.streaming import buckets

#: Parts of the first level of a top list; a fixed number, so the second level
#: holds at most so many times ``n`` rows.
PARTS = 64


def _changes(rows: list[tuple], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=list(names))


class JoinCounts(StatefulProcessor):
    """Pairs of each join key, counted by a group of the left side.

    A right row adds one to the count of every left row's group, a left row as many
    as there are right rows; so a key's state is one count for the right side and one
    for each left group, and a micro-batch changes each group's result once.
    """

    OUTPUT = "is_add boolean, grp string, total bigint"

    def init(self, handle) -> None:
        self.counts = handle.getMapState(
            "counts", "key string", "rights bigint, groups array<string>, lefts array<bigint>"
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        rights, lefts = Counter(), defaultdict(Counter)
        for frame in rows:
            is_left = frame["is_left"].to_numpy(dtype=bool)
            for name, n in frame["key"][~is_left].value_counts().items():
                rights[name] += int(n)
            for (name, group), n in frame[is_left].groupby(["key", "grp"]).size().items():
                lefts[name][group] += int(n)
        out = []
        for name in rights.keys() | lefts.keys():
            held = self.counts.getValue((name,))
            had, counts = (held[0], dict(zip(held[1], held[2]))) if held else (0, {})
            have, added = had + rights[name], lefts.get(name, {})
            for group in counts.keys() | added.keys() if have != had else added.keys():
                before = counts.get(group, 0)
                after = before + added.get(group, 0)
                if before * had != after * have:
                    if before * had:
                        out.append((False, group, before * had))
                    out.append((True, group, after * have))
                counts[group] = after
            self.counts.updateValue((name,), (have, list(counts.keys()), list(counts.values())))
        yield from _changes(out, ["is_add", "grp", "total"])

    def close(self) -> None:
        pass


def join_count_changes(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, by: Sequence[str]
) -> DataFrame:
    """Changes of ``count(*)`` over ``left JOIN right ON left_key = right_key GROUP
    BY by``, as either side grows: rows (is_add, by, total). ``by`` are columns of
    the left side, the join key among them, so that a group lies under one key. A
    group appears with its first pair. Null keys meet nothing."""
    if left_key not in by:
        raise ValueError("group by the join key as well")
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    lefts = left.where(F.col(left_key).isNotNull()).select(
        F.col(left_key).cast("string").alias("key"), F.lit(True).alias("is_left"), group.alias("grp")
    )
    rights = right.where(F.col(right_key).isNotNull()).select(
        F.col(right_key).cast("string").alias("key"),
        F.lit(False).alias("is_left"),
        F.lit(None).cast("string").alias("grp"),
    )
    found = buckets.run(lefts.unionByName(rights), "key", JoinCounts())
    kinds = ", ".join(f"`{c}` {dict(left.dtypes)[c]}" for c in by)
    return found.select("is_add", F.from_json("grp", kinds).alias("g"), "total").select(
        "is_add", "g.*", "total"
    )


class CountUpdates(StatefulProcessor):
    """Each key's number of rows so far, once for each micro-batch that has some."""

    OUTPUT = "name string, total bigint"

    def init(self, handle) -> None:
        self.totals = handle.getMapState("totals", "name string", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        added = Counter()
        for frame in rows:
            for name, n in frame["name"].value_counts().items():
                added[name] += int(n)
        out = []
        for name, n in added.items():
            held = self.totals.getValue((name,))
            total = n + (held[0] if held else 0)
            self.totals.updateValue((name,), (total,))
            out.append((name, total))
        yield from _changes(out, ["name", "total"])

    def close(self) -> None:
        pass


class TopRows(StatefulProcessor):
    """The ``n`` greatest (total, name) of what a part has been told, equal totals
    by name. Totals only grow, so a name outside the list need not be remembered:
    it comes again with a greater total or stays outside.

    The first level tells what is new in its list, the second, which is one part,
    gives the changes of the whole list.
    """

    TOLD = "name string, total bigint, part int"
    OUTPUT = "is_add boolean, name string, total bigint, rank int"

    def __init__(self, n: int, final: bool) -> None:
        self.n, self.final = n, final

    def init(self, handle) -> None:
        self.top = handle.getListState("top", "name string, total bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        before = [tuple(r) for r in self.top.get()]
        now = dict(before)
        for frame in rows:
            for name, total in zip(frame["name"].tolist(), frame["total"].tolist()):
                now[name] = max(total, now.get(name, 0))
            now = dict(self._first(now))
        after = self._first(now)
        if after != before:
            self.top.put(after)
        if not self.final:
            known = set(before)
            news = [(name, total, 0) for name, total in after if (name, total) not in known]
            yield from _changes(news, ["name", "total", "part"])
            return
        old = [(False, name, total, k + 1) for k, (name, total) in enumerate(before)]
        new = [(True, name, total, k + 1) for k, (name, total) in enumerate(after)]
        same = {r[1:] for r in old} & {r[1:] for r in new}
        changed = [r for r in old + new if r[1:] not in same]
        yield from _changes(changed, ["is_add", "name", "total", "rank"])

    def _first(self, totals: dict) -> list[tuple[str, int]]:
        return sorted(totals.items(), key=lambda r: (-r[1], r[0]))[: self.n]

    def close(self) -> None:
        pass


def top_changes(rows: DataFrame, name: Column, n: int = 1, parts: int = PARTS) -> DataFrame:
    """Changes of the ``n`` most frequent names of a stream: rows (is_add, name,
    total, rank). Equal counts go by the name's text.

    Counts are kept by name; the list is kept in two levels, the best of each of
    ``parts`` parts and the best of those, ``(parts + 1) * n`` rows in all however
    many names there are. A null name counts as none.
    """
    given = rows.select(name.cast("string").alias("name")).where("name IS NOT NULL")
    part = F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int")
    counts = buckets.run(given, "name", CountUpdates()).withColumn("part", part)
    first = TopRows(n, final=False)
    first.OUTPUT = TopRows.TOLD
    best = _run(counts, "part", first)
    return _run(best, "part", TopRows(n, final=True))


def _run(rows: DataFrame, key: str, processor: StatefulProcessor) -> DataFrame:
    ship_package(rows.sparkSession)  # the processors are pickled by name
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
