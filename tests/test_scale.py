"""What queries make on the way: rows, copies and state, on rows of their own."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_coupon import random_points
from tidematch.operators import geojoin, joins
from tidematch.plans import coupon, queries


def test_skew_join_makes_no_row_for_every_customer(spark, tmp_path, monkeypatch):
    suppliers = [(k, k % 2) for k in range(40)] + [(7, 1), (None, 0), (50, None)]
    customers = [(k, k % 2, "ab"[k % 3 % 2]) for k in range(600)] + [(601, None, "a"), (602, 1, None)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    spark.createDataFrame(
        customers, "c_custkey long, c_nationkey int, c_mktsegment string"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    made, original = [], joins.salted_join

    def counted(*args, **kwargs):
        made.append(original(*args, **kwargs))
        return made[-1]

    monkeypatch.setattr(joins, "salted_join", counted)
    got = queries.skew_join(spark, str(tmp_path)).collect()
    wanted = Counter(
        (s, segment) for s, n in suppliers for _, m, segment in customers if n is not None and n == m
    )
    assert {(r["s_suppkey"], r["c_mktsegment"]): r["cnt"] for r in got} == wanted
    assert len(got) == len(wanted) and made[0].count() <= len(suppliers) * 3


def points(spark, seed, users, stores):
    rng = random.Random(seed)
    ranges = [1, 30, 120.5, 2000, 50_000, 300_000, 2_000_000, 9_000_000, 30_000_000, "far"]
    people = [
        (str(rng.choice([1, 2])), str(k), str(lat), str(lng))
        for k, (lat, lng) in enumerate(random_points(rng, users))
    ]
    people += [("1", "n", None, "1"), (None, "o", "10.0", "20.0"), ("", "p", "10.0", "20.0")]
    asked = [
        (f"C{k}", str(rng.choice(ranges)), str(lng), str(lat), "5", rng.choice(["1", "2", None]), "S", f"R{k}")
        for k, (lat, lng) in enumerate(random_points(rng, stores))
    ]
    asked += [asked[0], (None, "9000000", "20", "10", None, "1", None, None)]
    names = "coupon_id store_range store_longitude store_latitude user_num type store_id unique_req_id"
    return (
        spark.createDataFrame(asked, ", ".join(f"{n} string" for n in names.split())),
        spark.createDataFrame(people, "cert_type string, cert_nbr string, lat string, lng string"),
    )


@pytest.mark.parametrize("equal", [None, {"type": "cert_type"}])
def test_counts_equal_the_pairs(spark, equal):
    requests, users = points(spark, 11, 200, 30)
    pairs = Counter(
        r["unique_req_id"] for r in geojoin.match_requests(requests, users, equal, True).collect()
    )
    for small in (True, False):
        got = geojoin.count_matches(requests, users, "unique_req_id", equal, small).collect()
        assert {r["unique_req_id"]: r["n"] for r in got} == pairs


@pytest.mark.parametrize("equal", [None, {"type": "cert_type"}])
def test_crowded_cells_are_counted_in_blocks(spark, equal, monkeypatch):
    """The larger cells in blocks of a few rows, beside others."""
    requests, users = points(spark, 13, 160, 30)
    odd = [("1", "i", "Infinity", "3"), ("1", "j", "-Infinity", "NaN")]
    users = users.union(spark.createDataFrame(odd, users.schema))
    requests = requests.union(requests.limit(3).withColumn("store_latitude", F.lit("Infinity")))
    pairs = Counter(
        r["unique_req_id"] for r in geojoin.match_requests(requests, users, equal, True).collect()
    )
    monkeypatch.setattr(geojoin, "LIST_PAIRS", 100)
    monkeypatch.setattr(geojoin, "LIST_ALL", 0)
    monkeypatch.setattr(geojoin, "BLOCK_REQUESTS", 7)
    monkeypatch.setattr(geojoin, "BLOCK_USERS", 40)
    got = geojoin.count_matches(requests, users, "unique_req_id", equal).collect()
    assert {r["unique_req_id"]: r["n"] for r in got} == pairs


def test_coupon_counts_list_no_match(spark, tmp_path, monkeypatch):
    """coupon_top1, coupon_groups and the counts give the rows of the listed matches without
    listing them."""
    spark.range(1, 151).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, 13).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    sf, keys = str(tmp_path), queries.COUNT_KEYS
    listed = Counter(tuple(r[k] for k in keys) for r in queries._matches(spark, sf).collect())
    monkeypatch.setattr(geojoin, "LIST_PAIRS", 0)
    monkeypatch.setattr(geojoin, "LIST_ALL", 0)
    monkeypatch.setattr(geojoin, "match_requests", None)
    monkeypatch.setattr(queries, "_matched", lambda *a, made=queries._matched(spark, sf): made)
    by_key = queries.coupon_count_by_key(spark, sf).collect()
    assert {tuple(r[k] for k in keys): r["cnt"] for r in by_key} == listed
    assert {tuple(r) for r in queries.coupon_groups(spark, sf).collect()} == set(listed)
    assert queries.coupon_count(spark, sf).first()["cnt"] == sum(listed.values())
    best = min(listed, key=lambda k: (-listed[k], k))
    assert tuple(queries.coupon_top1(spark, sf).first()) == (*best[:3], listed[best])


@pytest.mark.parametrize("small", [True, False])
def test_matches_are_framed_without_being_stored_or_moved(spark, small, monkeypatch):
    requests, users = points(spark, 12, 60, 20)
    stored, original = [], coupon.cut_lineage

    def noted(df):
        stored.append(df.columns)
        return original(df)

    monkeypatch.setattr(coupon, "cut_lineage", noted)
    got = coupon.coupon_match(requests, users, small_requests=small)
    assert all("id_number" not in columns for columns in stored)
    kept = coupon.coupon_match(requests, users, small_requests=small, keep_matches=True)
    assert Counter(got.collect()) == Counter(kept.collect()) and got.schema == kept.schema
    items = got.where("message_type = '02'")
    if small:
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "RoundRobin" not in plan
