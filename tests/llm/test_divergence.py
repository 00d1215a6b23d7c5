import random
import re
from collections import Counter, defaultdict
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import divergence

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_hand(rows, top=200, least=3):
    """rows of (text, lang, source)."""
    docs = [(TERM.findall((t or "").translate(LOWER)), la or "", s or "") for t, la, s in rows]
    in_docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for terms, la, s in docs:
        in_docs[la].update(set(terms))
        counts[la, s].update(terms)
        counts[la].update(terms)
        groups[la].add(s)
    out = set()
    for la, sources in groups.items():
        kept = [t for t, n in in_docs[la].items() if n >= least]

        def chances(of):
            total = sum(counts[of][t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[of][t] + 1) // (total + len(kept)) for t in kept}

        q = chances(la)
        p = {s: chances((la, s)) for s in sources}
        for s in sources:
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s
            ]
            terms = [
                (t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[la, s][t] and p[s][t] > q[t]
            ]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for k, (item, value) in enumerate(items if part == "pair" else items[:top]):
                    out.add((la, s, part, item, value, k + 1))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ["É", "z", "Q", "東", "𝒳y", "a'b "] for b in "abcdefghij"]
    out = []
    for _ in range(150):
        s = rng.randrange(sources)
        text = " ".join(rng.choice(words[s % 7 :: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40)))
        out.append((text, rng.choice(["en", None, "fr"]), f"s{s}" if s else None))
    return out + [("only once", "xx", "lone"), ("", "yy", "a"), (None, "yy", "b")]


@pytest.mark.parametrize("top,blocks", [(200, 256), (3, 2)])
def test_equals_plain_counts(spark, monkeypatch, top, blocks):
    """With one tile and with many, long lists and ones that the skyband cuts."""
    monkeypatch.setattr(divergence, "SOURCES", blocks)
    monkeypatch.setattr(divergence, "TERMS", 5)
    monkeypatch.setattr(divergence, "LEAST_TASKS", 3)
    monkeypatch.setattr(divergence, "HELD_COUNTS", 40)
    rows = made(top, 7)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert rows_of(divergence.audit(docs, top=top)) == by_hand(rows, top=top)


def test_odd_rows(spark, odd_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert len(rows) == len(ODD_TEXTS)
    assert rows_of(divergence.audit(odd_docs)) == by_hand(rows)
    assert rows_of(divergence.audit(odd_docs, least_docs=1)) == by_hand(rows, least=1)
    assert divergence.audit(odd_docs.limit(0)).collect() == []


@pytest.mark.parametrize("k", [1, 4, 30])
def test_the_skyband_equals_counting_dominators(monkeypatch, k):
    monkeypatch.setattr(divergence, "AT_ONCE", 16)
    rng = np.random.default_rng(k)
    n, m = rng.integers(1, 20, 400), rng.integers(1, 20, 400)
    place = rng.permutation(400)
    above = (n[None] >= n[:, None]) & (m[None] <= m[:, None]) & (place[None] < place[:, None])
    wanted = set(np.flatnonzero(above.sum(axis=1) < k))
    band = divergence.skyband(n, m, place, k)
    assert set(band) == wanted and len(band) == len(wanted)


def test_skybands_keep_what_may_rank_when_cut_often(spark, monkeypatch):
    """A few terms held at a time, and terms of which none dominates another."""
    monkeypatch.setattr(divergence, "HELD_TERMS", 8)
    rows = [("en", "a", f"t{500 - i:03d}", i + 1, i + 1) for i in range(100)]
    rows += [("en", "b", f"t{i:03d}", 1, 5) for i in range(100)]
    table = spark.createDataFrame(rows, "lang string, source string, term string, n long, ln long")
    left = divergence.skybands(table.coalesce(1), 3).collect()
    assert sum(r["source"] == "a" for r in left) == 100
    assert {r["term"] for r in left if r["source"] == "b"} >= {"t000", "t001", "t002"}
