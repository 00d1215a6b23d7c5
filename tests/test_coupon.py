"""The coupon job on hand-made input and against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from tidematch.functions import geo
from tidematch.operators import geojoin
from tidematch.plans import coupon
from tidematch.sources import layout, partitions


def frames(df):
    rows = df.select("message_type", "coupon_send_num", "id_number").collect()
    return sorted((r[0], r[1], r[2] or "") for r in rows)


def test_day_match(spark):
    records = coupon.coupon_match(
        fixtures.requests(spark, fixtures.request(15.1012, 35.1012)), fixtures.user_location(spark)
    )
    assert frames(records) == [
        ("01", "3", ""),
        ("02", "3", "44444"),
        ("02", "3", "55555"),
        ("02", "3", "66666"),
        ("03", "3", ""),
    ]


@pytest.mark.parametrize("users,matched", [(6, 3), (7, 4)])
def test_night_match(spark, users, matched):
    located = geojoin.one_face(fixtures.user_location_info(spark, users), F.lit("1"))
    records = coupon.coupon_match(
        fixtures.requests(spark, fixtures.request(17.1012, 38.1012)), located
    )
    assert Counter(r[0] for r in frames(records)) == {"01": 1, "02": matched, "03": 1}


def test_no_match_gives_one_zero(spark):
    records = coupon.coupon_match(
        fixtures.requests(spark, fixtures.request(60.0, 60.0)), fixtures.user_location(spark)
    )
    assert frames(records) == [("01", "0", "")]


def test_repeated_and_bad_requests(spark):
    records = coupon.coupon_match(
        fixtures.requests(
            spark,
            fixtures.request(15.1012, 35.1012),
            fixtures.request(15.1012, 35.1012),
            fixtures.request("north", 35.1012, req="R2"),
            fixtures.request(15.1012, 35.1012, store_range="far", req="R3"),
            fixtures.request(15.1012, 35.1012, store_range="0", req="R4"),
            fixtures.request(15.1012, 35.1012, store_range="NaN", req="R5"),
        ),
        fixtures.user_location(spark),
    )
    kinds = Counter((r["unique_req_id"], r["message_type"], r["coupon_send_num"])
                    for r in records.where("message_type <> '02'").collect())
    assert kinds == {
        ("R1", "01", "3"): 1, ("R1", "03", "3"): 1,
        ("R2", "01", "0"): 1, ("R3", "01", "0"): 1, ("R4", "01", "0"): 1, ("R5", "01", "0"): 1,
    }


def test_users_without_identity_are_skipped(spark):
    users = fixtures.user_location(spark).withColumn(
        "cert_type", F.when(F.col("cert_nbr") != "55555", F.col("cert_type")).otherwise(F.lit(""))
    )
    records = coupon.coupon_match(
        fixtures.requests(spark, fixtures.request(15.1012, 35.1012)), users
    )
    assert [r[2] for r in frames(records) if r[0] == "02"] == ["44444", "66666"]


@pytest.mark.parametrize("small", [True, False])
def test_odd_positions_match_nothing(spark, small):
    odd = [("a", "NaN", "1"), ("b", "1", "Infinity"), ("c", None, "1"), ("d", "", "1"),
           ("e", "x", "y"), ("f", "0.0", "0.0")]
    users = spark.createDataFrame(odd, "cert_nbr string, lat string, lng string")
    requests = fixtures.requests(
        spark,
        fixtures.request(0.0, 0.0, "Infinity", "R1"),
        fixtures.request("NaN", 0.0, "500", "R2"),
        fixtures.request("Infinity", 0.0, "Infinity", "R3"),
        fixtures.request(0.0, 0.0, "0.5", "R4"),
        fixtures.request(0.0, 0.0, "-1", "R5"),
    )
    got = geojoin.match_requests(requests, users, small_requests=small)
    assert sorted((r["unique_req_id"], r["cert_nbr"]) for r in got.collect()) == [
        ("R1", "f"), ("R4", "f")
    ]


def test_limit_is_global_and_consistent(spark):
    requests = fixtures.requests(
        spark, *[fixtures.request(15.1012, 35.1012, req=f"R{i}") for i in range(10)]
    )
    rows = coupon.coupon_match(requests, fixtures.user_location(spark), limit=7).collect()
    items = Counter(r["unique_req_id"] for r in rows if r["message_type"] == "02")
    starts = {r["unique_req_id"]: int(r["coupon_send_num"]) for r in rows
              if r["message_type"] == "01"}
    assert sum(items.values()) == 7
    assert starts == {f"R{i}": items.get(f"R{i}", 0) for i in range(10)}


@pytest.mark.parametrize("small", [True, False])
def test_null_request_keys_count_as_equal(spark, small):
    row = list(fixtures.request(15.1012, 35.1012))
    row[4] = None
    records = coupon.coupon_match(
        fixtures.requests(spark, tuple(row)), fixtures.user_location(spark), small_requests=small
    )
    assert Counter(r[0] for r in frames(records)) == {"01": 1, "02": 3, "03": 1}


def test_messages_carry_all_fields(spark):
    records = coupon.with_serial(
        coupon.coupon_match(
            fixtures.requests(spark, fixtures.request(60.0, 60.0)), fixtures.user_location(spark)
        )
    )
    assert coupon.to_messages(records).first()["value"] == (
        '{"COUPON_ID":null,"MESSAGE_TYPE":"01","COUPON_SEND_NUM":"0","SERIAL_NO":null,'
        '"ID_TYPE":null,"ID_NUMBER":null,"STORE_ID":null,"STORE_RANGE":null,"UNIQUE_REQ_ID":"R1"}'
    )


def haversine(lat1, lng1, lat2, lng2):
    p1, p2, l1, l2 = (v * math.pi / 180 for v in (lat1, lat2, lng1, lng2))
    h = math.sin((p1 - p2) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l1 - l2) / 2) ** 2
    metres = geo.EARTH_RADIUS_KM * 2 * math.asin(math.sqrt(h)) * 1000
    return math.floor(metres + 0.5)


def random_points(rng, n):
    """Points everywhere, at the poles, on the date line, out of range, and a
    crowd at one place."""
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    points += [(rng.uniform(89, 90), rng.uniform(-180, 180)) for _ in range(n // 4)]
    points += [(rng.uniform(-1, 1), rng.choice([-180, 180]) + rng.uniform(-1, 1))
               for _ in range(n // 4)]
    points += [(rng.uniform(88, 95), rng.uniform(170, 370)) for _ in range(n // 4)]
    points += [(10 + rng.uniform(0, 1e-3), 20 + rng.uniform(0, 1e-3)) for _ in range(n // 2)]
    return points + [(10.0, 20.0)] * (n // 2)


@pytest.mark.parametrize("small", [True, False])
def test_cells_equal_all_pairs(spark, small, monkeypatch):
    rng = random.Random(7)
    users = [(f"u{i}", lat, lng) for i, (lat, lng) in enumerate(random_points(rng, 120))]
    ranges = [1, 30, 120.5, 2000, 50_000, 300_000, 2_000_000, 9_000_000, 30_000_000]
    stores = [(f"r{i}", lat, lng, rng.choice(ranges))
              for i, (lat, lng) in enumerate(random_points(rng, 40))]
    expected = Counter(
        (r, u) for r, slat, slng, reach in stores for u, lat, lng in users
        if haversine(slat, slng, lat, lng) < reach
    )
    if not small:
        original = geojoin.salted_join
        monkeypatch.setattr(
            geojoin, "salted_join",
            lambda a, b, keys: original(a, b, keys, chunks=16, min_rows=1, min_pairs=1),
        )
    got = geojoin.match_requests(
        spark.createDataFrame(
            [(r, str(lat), str(lng), str(reach)) for r, lat, lng, reach in stores],
            "req string, store_latitude string, store_longitude string, store_range string",
        ),
        spark.createDataFrame(
            [(u, str(lat), str(lng)) for u, lat, lng in users], "nbr string, lat string, lng string"
        ),
        small_requests=small,
    )
    assert Counter((r["req"], r["nbr"]) for r in got.collect()) == expected


def test_plan_keys_by_cell_and_reads_users_once(spark):
    requests = fixtures.requests(spark, fixtures.request(15.1012, 35.1012))
    plan = geojoin.match_requests(requests, fixtures.user_location(spark))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin [_cell" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_many_requests_are_not_broadcast(spark, monkeypatch):
    requests = fixtures.requests(
        spark, *[fixtures.request(15.1012, 35.1012, req=f"R{i}") for i in range(30)]
    )
    assert geojoin.few_requests(requests)
    monkeypatch.setattr(geojoin, "BROADCAST_ROWS", 27 * 10)
    assert not geojoin.few_requests(requests)


def located(spark, count, seed):
    """Users all over the sphere, at its poles and its date line, and without a position."""
    rng = random.Random(seed)
    rows = [("1", str(k), str(rng.uniform(-90, 90)), str(rng.uniform(-180, 180))) for k in range(count)]
    rows += [("1", "p", "90", "0"), ("1", "q", "-90", "12"), ("1", "d", "0", "180"), ("1", "e", "0", "-180")]
    rows += [("1", "n", None, "1"), ("1", "x", "east", "1"), ("1", "i", "NaN", "1")]
    users = spark.createDataFrame(rows, "cert_type string, cert_nbr string, lat string, lng string")
    return users.withColumn("partstart", F.when(F.col("cert_nbr") < "5", "20220207").otherwise("20220210"))


def test_users_by_place_give_the_same_matches(spark, tmp_path):
    """Ranges from metres to the whole sphere, at the poles and across the date line."""
    users = located(spark, 3000, 3)
    layout.write_by_place(users, f"{tmp_path}/users")
    stored = spark.read.parquet(f"{tmp_path}/users").withColumn("partstart", F.col("partstart").cast("string"))
    assert stored.count() == users.count()
    spots = [(90, 0), (-89.9, 77), (0, 180), (0.1, -179.9), (48, 11), (400, -500)]
    for metres in ("300", "90000", "700000", "3000000", "30000000"):
        requests = fixtures.requests(
            spark, *[fixtures.request(a, b, store_range=metres, req=f"R{k}") for k, (a, b) in enumerate(spots)]
        )
        near = layout.near(stored, requests)
        wanted = geojoin.match_requests(requests, users).select("unique_req_id", "cert_nbr").collect()
        got = geojoin.match_requests(requests, near).select("unique_req_id", "cert_nbr").collect()
        assert sorted(got) == sorted(wanted) and (len(got) > 0 or metres == "300")


def test_only_the_files_of_reached_places_are_read(spark, tmp_path):
    users = located(spark, 3000, 4)
    layout.write_by_place(users, f"{tmp_path}/users")
    stored = spark.read.parquet(f"{tmp_path}/users")
    some = users.where("cert_nbr = '7'").first()
    requests = fixtures.requests(spark, fixtures.request(float(some["lat"]), float(some["lng"]), store_range="20000"))
    near = layout.near(stored, requests)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [place" in plan or "PartitionFilters: [isnotnull(place" in plan
    scan = near._jdf.queryExecution().executedPlan()
    near.collect()
    whole = len(stored.inputFiles())
    read = {r[0] for r in near.select(F.input_file_name()).collect()}
    assert 1 <= len(read) <= 8 < whole / 100, scan
    assert layout.near(stored, requests.where("1 = 0")).count() == 0
    bad = fixtures.requests(spark, fixtures.request("north", 1.0, store_range="20000"))
    assert layout.reached_places(bad) == []
    wide = fixtures.requests(spark, fixtures.request(1.0, 1.0, store_range="9000000"))
    assert layout.reached_places(wide) is None


def test_a_partition_and_its_places(spark, tmp_path):
    """The latest partition of a folder stored by place, one partition replaced."""
    users = located(spark, 400, 5)
    path = f"{tmp_path}/users"
    layout.write_by_place(users, path)
    latest = partitions.LatestPartition(path)
    assert latest(spark).count() == users.where("partstart = '20220210'").count()
    assert "place" in latest(spark).columns
