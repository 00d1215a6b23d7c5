import numpy as np
from pyspark.sql import functions as F

from tidematch.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, is_query, nearest=10):
    out = {}
    for q, v in rows:
        if is_query(q):
            near = sorted(
                (float(np.sqrt(((np.array(v, float) - np.array(w, float)) ** 2).sum())), i)
                for i, w in rows
                if i != q and len(w) == len(v)
            )
            out[q] = near[:nearest]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def test_recall_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 700)
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(2000, 24)).astype(np.float32)
    points[500:900] = points[500] + rng.normal(scale=0.01, size=(400, 24))  # a dense crowd
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = found(ann.neighbours(df, F.col("vec_id") % 50 == 0))
    wanted = exact(rows, lambda i: i % 50 == 0)
    assert got.keys() == wanted.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted)
    assert hits / (10 * len(wanted)) >= 0.95
    true = {q: dict((i, s) for s, i in exact(rows, lambda i: i == q, 2000)[q]) for q in list(got)[:5]}
    assert all(abs(true[q][i] - s) < 1e-9 for q in true for s, i in got[q])


def test_small_and_odd_tables(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (1, [1.0, 0.0], 1),
        (3, [0.0, 1.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [None, 1.0], 1),
        (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1),
        (9, [1.0, 2.0, 3.0], 1), (10, [], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS id", "'own' AS v")
    got = found(ann.neighbours(df, F.col("vec_id").isin(0, 4, 9)))
    assert got == {0: [(0.0, 1), (0.0, 2), (2**0.5, 3)]}
    assert ann.neighbours(df.limit(0), F.lit(True)).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(300)] + [(300, [5.0, 5.0], 0)]
    got = found(ann.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id").isin(5, 300)))
    assert [i for _, i in got[5]] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert [i for _, i in got[300]] == list(range(10))
