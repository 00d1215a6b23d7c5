import random

import numpy as np
from xxhash import xxh64_intdigest

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import simhash


def by_hand(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(gap, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_a_plain_count():
    for text in [t for t in ODD_TEXTS if t is None or len(t) < 1000] + ["a b", "A B c", "ÀB c d e"]:
        assert simhash.fingerprint(text) == by_hand(text)


def near(value, bits, rng):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_two_bits_apart_share_a_key():
    rng = random.Random(1)
    first = [rng.getrandbits(64) for _ in range(2000)]
    second = [near(v, rng.choice([0, 1, 2]), rng) for v in first]
    sets = []
    for values in (first, second):
        rows, keys = simhash.keys_of(np.array([simhash._signed(v) for v in values], np.int64))
        found = [set() for _ in values]
        for r, k in zip(rows.tolist(), keys.tolist()):
            found[r].add(k)
        sets.append(found)
    assert all(a & b for a, b in zip(*sets))
    assert max(map(len, sets[0])) <= 18


def components(values):
    parent = {k: k for k, _ in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(values):
        for b, y in values[:i]:
            if (x ^ y).bit_count() <= 2:
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {k: find(k) for k, _ in values}


def test_groups_equal_all_pairs(spark):
    rng = random.Random(2)
    values = []
    for _ in range(40):  # chains, and many around one centre
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            values.append(value)
            value = near(value, rng.randint(0, 4), rng)
    centre = rng.getrandbits(64)
    values += [near(centre, rng.choice([1, 1, 2]), rng) for _ in range(120)] + [0, 0, 1, 7]
    rng.shuffle(values)
    pairs = list(enumerate(values))
    rows = spark.createDataFrame([(k, simhash._signed(v)) for k, v in pairs], "doc_id long, fp long")
    got = {r["doc_id"]: r["component"] for r in simhash.groups(rows).collect()}
    assert got == components(pairs)


def test_one_of_each_group_stays(odd_docs):
    kept = simhash.first_of_groups(odd_docs)
    assert kept.columns == odd_docs.columns
    # 0, 1 and the row without id have no words; 6 comes twice.
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [0, 3, 4, 5, 6, 8]


def test_rows(odd_docs):
    found = simhash.near_groups(odd_docs).collect()
    assert len(found) == len(ODD_TEXTS)
    assert all(r["component"] == 0 for r in found if r["fp"] == 0)
    assert simhash.near_groups(odd_docs.limit(0)).count() == 0
    assert simhash.first_of_groups(odd_docs.limit(0)).count() == 0
