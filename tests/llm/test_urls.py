import numpy as np
import pytest

from tidematch.llm import urls

RULES = [(v, h, p) for v, h, p in urls.RULES]


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), v, h + p)
        for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[:0:-1] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://a.example.com/en/1",
    "https://example.com", "https://example.com/", "http://x.net/es/", "http://x.net/es", "ftp://net/fr/q",
    "http://notnet/es/", "a://b://c.net/fr/", "http://ÀB.com/É", "http://x.org/a?b://c.com/", "http://h.com:80/",
]


def test_rules_equal_a_plain_reading(spark):
    pages = spark.createDataFrame(
        [(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string"
    ).selectExpr("*", "'own' AS host", "'own' AS path", "'own' AS salt", "'own' AS key")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = by_hand(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow")
    assert urls.judge(pages.limit(0)).count() == 0


def pagerank(edges, seeds, rounds=200):
    nodes = sorted({n for e in edges for n in e} | set(seeds))
    start = np.array([seeds.get(n, 0.0) for n in nodes])
    move = np.zeros((len(nodes), len(nodes)))
    for a, b in edges:
        move[nodes.index(b), nodes.index(a)] = 1 / sum(x == a for x, _ in edges)
    score = (1 - urls.DAMPING) * start
    for _ in range(rounds):
        score = (1 - urls.DAMPING) * start + urls.DAMPING * move @ score
    return dict(zip(nodes, score))


def test_propagation_equals_matrix_products(spark, monkeypatch):
    monkeypatch.setattr(urls, "ROUNDS", 60)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("e", "d"), ("f", "e")]
    table = spark.createDataFrame(edges, "src string, dst string")
    start = spark.createDataFrame(
        [("a", "trust", 0.5), ("f", "trust", 0.5), ("d", "distrust", 1.0)],
        "host string, kind string, seed double",
    )
    got = {(r["host"], r["kind"]): r["score"] for r in urls.propagate(table, start).collect()}
    trust = pagerank(edges, {"a": 0.5, "f": 0.5})
    distrust = pagerank([(b, a) for a, b in edges], {"d": 1.0})
    for kind, wanted in (("trust", trust), ("distrust", distrust)):
        for host, score in wanted.items():
            assert got.get((host, kind), 0.0) == pytest.approx(score, abs=1e-4)


def test_a_host_that_points_at_blocked_ones_is_blocked(spark):
    link = lambda h: f'<a href="http://{h}/es/">x</a><A HREF=//{h.upper()}/>'
    rows = [
        (1, "http://bad.net/es/1", ""), (2, "http://bad.net/es/2", ""),
        (3, "http://farm.org/x", link("bad.net")), (3, "http://farm.org/x", link("bad.net")),
        (4, "http://good.com/", link("fine.org")), (5, "http://fine.org/y", '<a href="/local">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_scores_reach_the_end_of_a_long_chain_from_a_small_seed(spark):
    """With the rounds and the limit of production: more than 20 links, and a seed
    as small as among very many."""
    names = [f"h{i}" for i in range(24)]
    edges = list(zip(names[1:], names))  # distrust goes against the links
    edges += [("x", "h0"), ("h0", "x")]
    seed = 1e-9
    start = spark.createDataFrame([("h0", "distrust", seed)], "host string, kind string, seed double")
    table = spark.createDataFrame(edges, "src string, dst string")
    got = {r["host"]: r["score"] for r in urls.propagate(table, start).collect()}
    wanted = pagerank([(b, a) for a, b in edges], {"h0": seed})
    assert got == {h: pytest.approx(v, rel=1e-5) for h, v in wanted.items()}
