from collections import Counter

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import mixing


def shares(sizes, share=1.5, weights=(3, 1, 2), cap=2.0):
    """Targets by giving out the excess again and again."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left = dict.fromkeys(order, 0.0), share * sum(sizes.values())
    open_sources = set(order)
    while left > 1e-9 and open_sources:
        total = sum(weight[s] for s in open_sources)
        for s in open_sources:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_sources):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_sources.discard(s)
    return target


def test_targets_and_totals(make_docs):
    texts, sources = [], []
    for k in range(900):
        texts.append("w " * (1 + k * 37 % 91))
        sources.append([None, "b", "a", "c", "big", "big", "big", "d"][k % 8])
    docs = make_docs(texts, sources=sources)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(t.split())
    wanted = shares(sizes)
    taken = Counter()
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].split()) and 0 <= r["copies"] <= 2
        assert abs(r["target"] - wanted[r["source"]]) < 1e-6
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - wanted[s]) <= 91 for s in wanted)
    again = {(r["doc_id"], r["copies"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in rows}


def test_size_counts_words(make_docs):
    docs = make_docs(ODD_TEXTS + [" a\x0bb ", "a b", "\n"])
    for r in mixing.mix(docs).collect():
        text = (ODD_TEXTS + [" a\x0bb ", "a b", "\n"])[r["doc_id"]] or ""
        assert r["size"] == len(text.encode().split())


def test_repeated_rows_and_columns(odd_docs):
    mixed = mixing.repeated(odd_docs)
    assert mixed.columns == odd_docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(odd_docs).collect()}
    got = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert got[5] == copies[5] and max(got.values()) <= 4
    assert mixing.mix(odd_docs).count() == len(ODD_TEXTS)
    assert mixing.mix(odd_docs.limit(0)).count() == 0 == mixing.repeated(odd_docs.limit(0)).count()


def test_texts_without_words(make_docs):
    rows = mixing.mix(make_docs(["", None, " "])).collect()
    assert [(r["size"], r["target"]) for r in rows] == [(0, 0.0)] * 3


def test_inclusion_follows_the_probabilities(make_docs):
    """Many sources of the same sizes, as many draws: a document is taken as often as its
    probability says, and large ones are certain."""
    sizes = [1, 2, 4, 9, 16, 16, 25, 36, 49, 64, 100, 100, 144] * 4
    draws = 100
    texts = [f"w{d} " * n for d in range(draws) for n in sizes]
    sources = [f"s{d:03d}" for d in range(draws) for _ in sizes]
    docs = make_docs(texts, sources=sources)
    total = sum(sizes)
    for share in (0.35, 0.9):
        rest = share * total
        by_size = sorted(sizes)
        sure = []
        while True:
            left = by_size[: len(by_size) - len(sure)]
            scale = (rest - sum(sure)) / sum(n * max(1, int(n**0.5)) for n in left)
            if scale * max(1, int(left[-1] ** 0.5)) <= 1:
                break
            sure.append(left[-1])
        taken, sums = Counter(), Counter()
        for r in mixing.mix(docs, share=share, weights=(1,)).collect():
            taken[r["size"]] += r["copies"]
            sums[r["source"]] += r["copies"] * r["size"]
            assert r["copies"] <= 1 and abs(r["target"] - rest) < 1e-6
        wanted = {n: 1.0 if n in sure else scale * max(1, int(n**0.5)) for n in sizes}
        assert min(wanted.values()) < 0.2 < 0.4 < max(wanted.values())
        assert bool(sure) == (share > 0.5)
        for n, chance in wanted.items():
            assert abs(taken[n] / (draws * sizes.count(n)) - chance) < 0.07, (share, n, chance)
        for n in sure:
            assert taken[n] == draws * sizes.count(n)
        assert all(abs(v - rest) <= 72 for v in sums.values())


def test_chances_add_up_to_the_words_left(spark):
    rows = [("a", n, 0.0) for n in (0, 1, 1, 5, 50, 500)] + [(None, 3, 0.0)] + [("z", 0, 0.0)]
    sizes = spark.createDataFrame(rows, "source string, size long, draw double")
    plan = spark.createDataFrame([("a", 300.0), (None, 1.5), ("z", 0.0)], "source string, rest double")
    found = mixing.chances(sizes, plan).collect()
    scale = {r["source"]: r["scale"] for r in found}
    assert len(found) == 3 and scale["z"] is None

    def chance(s, n):
        return min(1.0, scale[s] * max(1, int(n**0.5)))

    assert abs(sum(n * chance("a", n) for n in (0, 1, 1, 5, 50, 500)) - 300) < 1e-9
    assert abs(3 * chance(None, 3) - 1.5) < 1e-9
