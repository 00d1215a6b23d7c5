"""How sources of a language differ in their words, term by term and pair by pair.

Counts become whole-number chances per billion with one added to every count.
``f = floor((p - q)^2 / q)`` tells how far a group's chance ``p`` of a term is from
another chance ``q``.

* Terms, against the whole language: ``f`` grows with a term's count in the group
  and falls with its count in the language. So a term is out of the top ``k`` once
  ``k`` others have at least its group count, at most its language count and an
  earlier name: the dominance skyband. Every task keeps the skyband of its terms in
  numpy, the skybands are merged the same way, and what is left is ranked exactly.
* Pairs of sources, over all kept terms: the sources of a language are numbered and
  cut into blocks; a tile is a pair of blocks. The counts of a term go to its tiles,
  dealt out by a hash of the term as well, so no tile is one task. A task lays some
  terms of a tile out as a matrix at a time and adds up ``f`` for all of the tile's
  pairs; terms that no source of a tile has are added as one product at the end.

Everything is counted over all documents, in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from decimal import Decimal
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidematch.llm.common import Steps
from tidematch.session import ship_package

#: Bytes of UTF-8 to bytes: capital letters to small ones, what parts terms, all of
#: ASCII but its letters, to spaces, and the rest to itself.
SPLIT = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: Counts that a task holds before it sends them on, and sends at once.
HELD_COUNTS, ROWS_OUT = 500_000, 20_000
#: A language keeps terms in at least so many of its documents.
LEAST_DOCS = 3
#: Chances are in parts of this.
PARTS = 1_000_000_000
#: Ranks of the part ``term``.
TOP = 200
#: Terms that a task holds of one group before it cuts them to their skyband.
HELD_TERMS = 1 << 14
#: Terms compared with the skyband at once.
AT_ONCE = 512
#: Sources in a block; a tile's sums are one matrix of this size squared.
SOURCES = 256
#: Terms laid out as a matrix at once.
TERMS = 128
#: Rows that a task of the pair part gets, about.
ROWS_A_TASK = 1_000_000
LEAST_TASKS = 96


def term_rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term,
    pre-counted by each task before they are shuffled."""
    empty = F.lit("")
    given = docs.select(
        F.coalesce(F.col(lang), empty).alias("lang"),
        F.coalesce(F.col(source), empty).alias("source"),
        F.coalesce(F.col(text), empty).alias("text"),
    )
    table, most = SPLIT, HELD_COUNTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for group, raw in zip(zip(langs, sources), batch.column(2).cast(pa.binary())):
                terms = raw.as_py().translate(table).split()
                if not terms:
                    continue
                if group not in counts:
                    counts[group] = (Counter(), Counter())
                n, in_docs = counts[group]
                before = len(n)
                n.update(terms)
                in_docs.update(set(terms))
                held += len(n) - before
                if held >= most:
                    yield from _count_rows(counts)
                    counts, held = {}, 0
        yield from _count_rows(counts)

    ship_package(docs.sparkSession)
    each = given.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count_rows(counts: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, in_docs) in counts.items():
        terms = list(n)
        for start in range(0, len(terms), ROWS_OUT):
            some = terms[start : start + ROWS_OUT]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some), pa.string()),
                    pa.array([source] * len(some), pa.string()),
                    pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array(list(map(n.__getitem__, some)), pa.int64()),
                    pa.array(list(map(in_docs.__getitem__, some)), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def chance(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (n + 1) / (total + kept)): in longs as far as they reach, in
    decimals beyond."""
    wide = lambda c: c.cast("decimal(20,0)")
    plain = F.call_function("div", (n + 1) * F.lit(PARTS), total + kept)
    top = wide(n + 1) * F.lit(PARTS).cast("decimal(10,0)")
    large = F.call_function("div", top, wide(total + kept)).cast("long")
    return F.when(n < (1 << 62) // PARTS, plain).otherwise(large) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); chances are at most PARTS + 1, so squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


# --- the terms of a group ---------------------------------------------------------


def skyband(n: np.ndarray, m: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows dominated by fewer than ``k`` others: those with at least the row's ``n``,
    at most its ``m`` and an earlier ``place`` by name.

    A row with ``k`` dominators has ``k`` in the skyband too, so in the order of names
    each row is compared with the skyband so far.
    """
    order = np.lexsort((place, m, n))
    same = np.zeros(len(order), np.int64)
    if len(order):
        # Of rows with equal counts only the first k names can stay.
        new = np.r_[True, (n[order][1:] != n[order][:-1]) | (m[order][1:] != m[order][:-1])]
        starts = np.flatnonzero(new)
        same = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    order = order[same < k]
    order = order[np.argsort(place[order], kind="stable")]
    band = np.empty(0, np.int64)
    for start in range(0, len(order), AT_ONCE):
        part = order[start : start + AT_ONCE]
        above = (n[band][None] >= n[part][:, None]) & (m[band][None] <= m[part][:, None])
        before = above.sum(axis=1)
        some, before = part[before < k], before[before < k]
        # Among themselves, those earlier in the part count too.
        within = (n[some][None] >= n[some][:, None]) & (m[some][None] <= m[some][:, None])
        within &= np.tri(len(some), k=-1, dtype=bool)
        band = np.r_[band, some[before + within.sum(axis=1) < k]]
    return band


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of rows (lang, source, term, n, ln), each task's skyband by group.

    A group's terms wait until there are ``HELD_TERMS`` of them; if most are
    undominated they are sent on as they are, so memory is bounded and no term that
    may rank is lost.
    """
    schema = rows.schema
    names = rows.columns
    most = HELD_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        waiting = 0

        def cut(group: tuple) -> list:
            """The skyband of a group's terms."""
            terms = pa.concat_arrays([p[0] for p in held[group]])
            n, m = (np.concatenate([p[i] for p in held[group]]) for i in (1, 2))
            place = np.empty(len(n), np.int64)
            place[pc.sort_indices(terms).to_numpy()] = np.arange(len(n))  # by UTF-8
            band = skyband(n, m, place, k)
            return [terms.take(pa.array(band)), n[band], m[band]]

        def batch_of(group: tuple, part: list) -> pa.RecordBatch:
            terms, n, m = part
            given = [pa.array([name] * len(n), pa.string()) for name in group]
            return pa.RecordBatch.from_arrays([*given, terms, pa.array(n), pa.array(m)], names=names)

        for batch in batches:
            lang, source = (c.dictionary_encode() for c in batch.columns[:2])
            terms, n, m = batch.column(2), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            wide = len(source.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
            order = np.argsort(group, kind="stable")
            ids, starts = np.unique(group[order], return_index=True)
            for number, own in zip(ids.tolist(), np.split(order, starts[1:])):
                key = (lang.dictionary[number // wide].as_py(), source.dictionary[number % wide].as_py())
                parts = held.setdefault(key, [])
                parts.append([terms.take(pa.array(own)), n[own], m[own]])
                waiting += len(own)
                count = sum(len(p[1]) for p in parts)
                if count >= most:
                    band = cut(key)
                    waiting -= count
                    held[key] = []
                    if len(band[1]) > most // 2:
                        yield batch_of(key, band)
                    else:
                        held[key] = [band]
                        waiting += len(band[1])
            if waiting > 32 * most:  # many groups: send all on
                for key in list(held):
                    if held[key]:
                        yield batch_of(key, cut(key))
                held, waiting = {}, 0
        for key in held:
            if held[key]:
                yield batch_of(key, cut(key))

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def top_terms(counted: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(lang, source, part, item, value, rank) of the terms that a group has more
    often than its language, the ``k`` farthest.

    ``counted`` has (lang, source, term, n, ln), dealt out by term, so a large group
    is spread over all tasks.
    """
    facts = groups.select("lang", "source", "total", "lang_total", "kept")

    def judged(rows: DataFrame) -> DataFrame:
        p = chance(F.col("n"), F.col("total"), F.col("kept"))
        q = chance(F.col("ln"), F.col("lang_total"), F.col("kept"))
        met = rows.join(facts, ["lang", "source"]).select(*rows.columns, p.alias("p"), q.alias("q"))
        return met.filter("p > q")

    own = ["lang", "source", "term", "n", "ln"]
    bands = skybands(judged(counted.select(*own)).select(*own), k)
    # Merge: the bands of a group meet in a few tasks, each of which cuts them again.
    few = F.pmod(F.xxhash64("term"), F.lit(LEAST_TASKS))
    merged = skybands(bands.repartition("lang", "source", few), k)
    valued = judged(merged).select(
        "lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value")
    )
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = valued.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


# --- pairs of sources --------------------------------------------------------------


def tile_sums(rows: DataFrame) -> DataFrame:
    """(lang, g, h, value, seen): sums of f over a task's terms, for pairs of sources
    by their places.

    ``rows`` (lang, a, b, spot, term, at) are sorted by tile and spot. ``at`` lists the
    places and chances of the sources of blocks a and b that have the term; a tile's
    part begins with a row without a term, which lists the chances of terms that a
    source lacks.
    """
    schema = "lang string, g int, h int, value decimal(38,0), seen long"
    arrow = pa.schema(
        [("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32())]
        + [("value", pa.decimal128(38)), ("seen", pa.int64())]
    )
    at_once = TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile = None, None
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            ids = [lang.indices.to_numpy(), *(batch.column(c).to_numpy() for c in (1, 2, 3))]
            starts = np.flatnonzero(np.r_[True, np.any([i[1:] != i[:-1] for i in ids], axis=0)])
            ends = [*starts[1:], batch.num_rows]
            for start, end in zip(starts.tolist(), ends):
                key = (lang.dictionary[ids[0][start]].as_py(), *(int(i[start]) for i in ids[1:]))
                part = batch.slice(start, int(end) - start)
                if key != now:
                    if tile is not None:
                        yield tile.out(now[0], arrow)
                    now, tile = key, Tile(key[1], key[2], part.column(5)[0].as_py())
                    part = part.slice(1)
                for first in range(0, part.num_rows, at_once):
                    some = part.column(5).slice(first, at_once)
                    flat = some.flatten()
                    tile.add(
                        np.repeat(np.arange(len(some)), some.value_lengths().to_numpy()),
                        flat.field(0).to_numpy(),
                        flat.field(1).to_numpy(),
                        len(some),
                    )
        if tile is not None:
            yield tile.out(now[0], arrow)

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


class Tile:
    """Sums for the pairs of two blocks of sources, over some of the terms."""

    def __init__(self, a: int, b: int, absent: list[dict]):
        lacking = sorted((r["block"], r["place"], r["p"]) for r in absent)
        self.places = np.array([place for _, place, _ in lacking], np.int64)
        self.base = np.array([p for *_, p in lacking], np.int64)
        # Block a's sources come first; a tile of one block has each pair once.
        self.first = np.flatnonzero([block == a for block, *_ in lacking])
        self.second = np.flatnonzero([block == b for block, *_ in lacking])
        self.one = a == b
        shape = (len(self.first), len(self.second))
        self.sums = [[np.zeros(shape, np.int64) for _ in range(2)] for _ in range(2)]
        self.seen = 0

    def add(self, rows: np.ndarray, places: np.ndarray, p: np.ndarray, count: int) -> None:
        """Add the terms of a matrix: ``p`` at (``rows``, ``places``), else ``base``."""
        laid = np.repeat(self.base[None], count, axis=0)
        laid[rows, np.searchsorted(self.places, places)] = p
        left, right = laid[:, self.first], laid[:, self.second]
        self._pairs(self.sums[0], left, right, False)
        if not self.one:
            self._pairs(self.sums[1], left, right, True)
        self.seen += count

    @staticmethod
    def _pairs(sums: list[np.ndarray], left: np.ndarray, right: np.ndarray, back: bool) -> None:
        """f of left against right, or with ``back`` of right against left."""
        for k in range(left.shape[1]):
            own = left[:, k : k + 1]
            gap = own - right
            f = gap * gap // (own if back else right)
            # A value may come near 10^18: the low and the high half are added apart.
            sums[0][k] += (f & 0xFFFFFFFF).sum(axis=0)
            sums[1][k] += (f >> 32).sum(axis=0)

    def out(self, lang: str, arrow: pa.Schema) -> pa.RecordBatch:
        rows = []
        places = self.places.tolist()
        for back in range(1 if self.one else 2):
            low, high = (s.tolist() for s in self.sums[back])
            for x, g in enumerate(self.first.tolist()):
                for y, h in enumerate(self.second.tolist()):
                    if g != h:
                        pair = (places[h], places[g]) if back else (places[g], places[h])
                        rows.append((lang, *pair, Decimal(low[x][y] + (high[x][y] << 32)), self.seen))
        columns = list(zip(*rows)) or [[] for _ in arrow]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
        )


def pair_values(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for every two sources of a language."""
    size = SOURCES
    own = groups.select(
        "lang", "source", F.col("place").cast("int").alias("place"), "total", "kept",
        F.floor(F.col("place") / size).cast("int").alias("block"),
        chance(F.lit(0).cast("long"), F.col("total"), F.col("kept")).alias("p0"),
    ).filter("kept > 0")
    held = counted.join(own.drop("p0"), ["lang", "source"]).select(
        "lang", "term", "block", "place",
        chance(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
    )
    last = groups.agg(F.max("place")).first()[0]
    blocks = 1 if last is None else last // size + 1
    spots = max(LEAST_TASKS, -(-counted.count() * blocks // ROWS_A_TASK))

    def tiled(rows: DataFrame) -> DataFrame:
        """Rows with the tiles (a, b) that their block is part of, a up to b."""
        others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        rows = rows.withColumn("other", others)
        pair = F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
        at = F.struct("place", "p", "block").alias("at")
        return rows.select("lang", *pair, "spot", "term", at)

    spot = F.pmod(F.xxhash64("term"), F.lit(spots)).cast("int")
    heads = own.select(
        "lang", "block", "place", F.col("p0").alias("p"), F.lit(None).cast("string").alias("term"),
        F.explode(F.sequence(F.lit(0), F.lit(spots - 1))).alias("spot"),
    )
    tile = ["lang", "a", "b", "spot"]
    # A list holds at most the sources of two blocks.
    dealt = tiled(held.withColumn("spot", spot)).unionByName(tiled(heads)).repartition(*tile)
    listed = dealt.groupBy(*tile, "term").agg(F.collect_list("at").alias("at"))
    summed = tile_sums(listed.sortWithinPartitions(*tile, F.asc_nulls_first("term")))
    summed = summed.groupBy("lang", "g", "h").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen")
    )
    sides = groups.select("lang", "place", "source", "kept")
    chances = own.select("lang", "place", "p0")
    sides = sides.join(chances, ["lang", "place"], "left")

    def named(side: str) -> tuple[DataFrame, Column]:
        rows = sides.select([F.col(c).alias(f"{side}_{c}") for c in sides.columns])
        return rows, (F.col("lang") == F.col(f"{side}_lang")) & (F.col(side) == F.col(f"{side}_place"))

    left, on_left = named("g")
    right, on_right = named("h")
    rest = (F.col("g_kept") - F.col("seen")).cast("decimal(20,0)") * apart(F.col("g_p0"), F.col("h_p0"))
    met = summed.join(left, on_left).join(right, on_right)
    valued = met.select(
        "lang", F.col("g_source").alias("source"), F.col("h_source").alias("item"),
        (F.col("value") + rest).cast("long").alias("value"),
    )
    # A language without kept terms: all its values are 0.
    bare = groups.filter("kept = 0").select("lang", "source")
    other = bare.select(F.col("lang").alias("l"), F.col("source").alias("item"))
    zeros = bare.join(other, (F.col("lang") == F.col("l")) & (F.col("source") != F.col("item")))
    zeros = zeros.select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = valued.union(zeros).withColumn("rank", F.row_number().over(rank))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    top: int = TOP,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): for every group of a language and a
    source the other sources of the language (``pair``), and the ``top`` terms that
    it has more often than its language (``term``), by value.

    A null text, language or source is an empty one. Groups without terms count as
    sources; a language in which no term is kept has values of 0. Ties go by the
    item's UTF-8. Repeated rows count each as a document. A single source has no
    pairs. An empty table gives no rows. Other columns are not read. A language
    with many sources has the square of their number as rows.
    """
    steps = Steps(docs.sparkSession, "divergence")
    counts = steps.put(term_rows(docs, text, lang, source), "counts")
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("ln"), F.sum("docs").alias("in_docs"))
        .filter(F.col("in_docs") >= least_docs)
        .drop("in_docs")
    )
    counted = steps.put(counts.join(kept, ["lang", "term"]).drop("docs"), "counted")
    steps.drop("counts")
    empty = F.lit("")
    named = docs.select(
        F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source")
    ).distinct()
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    terms = counted.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("kept"))
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place")
    none = F.lit(0).cast("long")
    groups = (
        named.select("lang", "source", place)
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .join(terms, "lang", "left")
        .select(
            "lang", "source", "place", F.coalesce("total", none).alias("total"),
            F.coalesce("lang_total", none).alias("lang_total"), F.coalesce("kept", none).alias("kept"),
        )
    )
    groups = steps.put(groups, "groups")
    found = top_terms(counted, groups, top).union(pair_values(counted, groups))
    found = steps.put(found, "found")
    steps.drop("counted", "groups")
    return found


def sql(top: int = TOP, least_docs: int = LEAST_DOCS) -> str:
    p = lambda n, total: f"1 + {PARTS} * ({n} + 1) // ({total} + kept)"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'),
      '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS ln FROM t GROUP BY lang, term
  HAVING count(DISTINCT r) >= {least_docs}
), v AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS kept, sum(ln) AS lang_total FROM kept GROUP BY lang
), n AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n, any_value(ln) AS ln
  FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT x.lang, x.source, coalesce(s.total, 0) AS total, coalesce(v.kept, 0) AS kept,
    coalesce(v.lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) x
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source) s USING (lang, source)
  LEFT JOIN v USING (lang)
), c AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, {p("coalesce(n.n, 0)", "total")} AS p,
    {p("k.ln", "lang_total")} AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(s.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM c x JOIN c y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  GROUP BY a.lang, a.source, b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM c WHERE n > 0 AND p > q
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
    ORDER BY value DESC, encode(item)) AS rank FROM ranked
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM numbered WHERE part = 'pair' OR rank <= {top}
"""


SQL = sql()
