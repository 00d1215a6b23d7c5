"""Operators on hand-made input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from tidematch.functions import jsontext
from tidematch.operators import (
    aggregate,
    changelog,
    correlate,
    joins,
    route,
    shape,
    windows,
)
from tidematch.operators.running import heavy_keys

PEOPLE = [("Fred", 35), ("Wilma", 35), ("Pebbles", 2)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, age int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_filters(people):
    grown = shape.at_least(people, "age", 18)
    assert rows(grown) == [("Fred", 35), ("Wilma", 35)]
    assert rows(shape.starts_with(grown, "name", "F")) == [("Fred", 35)]


def test_containing(spark):
    lines = spark.createDataFrame([("apple pie",), ("pear",), (None,)], "value string")
    assert rows(shape.containing(lines, "apple")) == [("newapple pie",)]


def test_job_parameter(people):
    assert rows(shape.append_parameter(people, "name", "tide").select("name")) == [
        ("Fred-tide",), ("Pebbles-tide",), ("Wilma-tide",)
    ]


def test_low_status_ignores_text(spark):
    records = spark.createDataFrame([("4",), ("5",), ("x",), (None,)], "status_code string")
    assert [r["status_code"] for r in shape.stamp_low_status(records).collect()] == ["4"]


def test_json_field(spark):
    lines = spark.createDataFrame(
        [('{"a":1,"b":[true,null]}',), ("{}",), ('{"processFlag":"old"}',), ("bad",), ("",)],
        "value string",
    )
    got = [r[0] for r in shape.set_json_field(lines, "processFlag", "true").collect()]
    assert got == [
        '{"a":1,"b":[true,null],"processFlag":true}',
        '{"processFlag":true}',
        '{"processFlag":true}',
        None,
        None,
    ]


def test_json_filter_takes_numbers_and_text(spark):
    lines = spark.createDataFrame(
        [('{"statusCode":"0"}',), ('{"statusCode":0}',), ('{"statusCode":"00"}',), ("bad",)],
        "value string",
    )
    assert shape.json_field_equals(lines, "statusCode", "0").count() == 2


def test_side_output(people):
    routed = route.route(people, F.col("name").startswith("W"))
    assert rows(route.taken(routed, route.MAIN)) == [("Wilma", 35)]
    assert rows(route.taken(routed, route.SIDE)) == [("Fred", 35), ("Pebbles", 2)]


def test_split_requests(spark):
    kinds = fixtures.requests(
        spark,
        fixtures.request(0, 0, req="a", kind="01"),
        fixtures.request(0, 0, req="b", kind="02"),
        fixtures.request(0, 0, req="c", kind="03"),
        fixtures.request(0, 0, req="d", kind=None),
    )
    got = rows(route.split_requests(kinds).select("unique_req_id", "route"))
    assert got == [("a", "item"), ("a", "item_copy"), ("b", "count")]


def test_observed_passes_rows(people):
    assert shape.observed(people, "seen").count() == 3


def test_rowwise(people):
    def double(batches):
        for frame in batches:
            yield frame.assign(age=frame["age"] * 2)

    assert rows(shape.rowwise(people, double, "name string, age int"))[0] == ("Fred", 70)


def test_query_view_binds_parameters(people):
    got = shape.query_view(people, "v", "SELECT age FROM v WHERE name = :n", {"n": "Pebbles"})
    assert rows(got) == [(2,)]


def test_equi_join_count(spark):
    messages = spark.createDataFrame([("1", "0"), ("9", "0"), (None, "0")],
                                     "msg_id string, status string")
    got = joins.count_joined(messages, fixtures.group_count(spark), "msg_id", "a",
                             ["msg_id", "status"])
    assert rows(got) == [("1", "0", 6)]


@pytest.mark.parametrize("limit", [10, 0])
def test_attach_rows(spark, people, limit, monkeypatch):
    """The small form and the chunked one give the same product."""
    monkeypatch.setattr(joins, "LOOKUP_ROWS", limit)
    days = spark.createDataFrame([("mon",), ("tue",)], "day string")
    got = joins.attach_rows(people.select("name"), days, chunks=3)
    assert rows(got) == sorted((n, d) for n, _ in PEOPLE for d in ("mon", "tue"))
    assert rows(joins.count_attached(people, days)) == [(6,)]


def test_attach_nothing(spark, people):
    none = spark.createDataFrame([], "day string")
    assert joins.attach_rows(people, none).count() == 0


def test_salted_join_equals_join(spark):
    left = spark.createDataFrame(
        [(1 if i % 3 else i % 11, i) for i in range(900)] + [(None, -1)], "k int, a int"
    ).repartition(5)
    right = spark.createDataFrame(
        [(1 if i % 2 else i % 7, i) for i in range(300)] + [(None, -1)], "k int, b int"
    )
    right = right.unionAll(right.where("b < 20"))
    plain = left.join(right, "k")
    split = joins.salted_join(left, right, ["k"], chunks=8, min_rows=1, min_pairs=1)
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))
    heavy = joins._hot_keys(left.dropna(), right.dropna(), ["k"], 8, 1, 1).where("k = 1").first()
    assert heavy["_left_chunks"] > 1 and heavy["_right_chunks"] > 1


def test_changelog(spark):
    scores = spark.createDataFrame(
        [("Alice", 12, 1), ("Bob", 10, 2), ("Alice", 100, 3), ("Bob", 0, 4)],
        "name string, score long, seq long",
    )
    got = changelog.sum_changelog(scores, ["name"], "score", "seq").orderBy("seq", "is_add")
    assert [tuple(r) for r in got.select("is_add", "name", "total").collect()] == [
        (True, "Alice", 12), (True, "Bob", 10), (False, "Alice", 12), (True, "Alice", 112),
    ]


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_changelog_replays_to_the_sum(spark, block):
    scores = spark.range(300).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 5 as string) end as name",
        "id * 31 % 11 - 5 as score", "id as seq",
    )
    changes = changelog.sum_changelog(scores, ["name"], "score", "seq", block=block, min_rows=50)
    final = changelog.net_result(changes, ["name"])
    assert Counter(map(tuple, final.collect())) == Counter(
        map(tuple, aggregate.sum_by(scores, ["name"], "score").collect())
    )


def test_top_one_is_numeric(spark):
    counts = spark.createDataFrame([("a", "9"), ("b", "10"), ("c", "10")], "id string, n string")
    assert rows(aggregate.top_one(counts, "n", ["id"])) == [("b", "10")]


def test_counts(spark, people):
    assert rows(aggregate.count_all(people)) == [(3,)]
    assert rows(aggregate.count_by(people, ["age"])) == [(2, 1), (35, 2)]
    assert rows(aggregate.groups(people, ["age"])) == [(2,), (35,)]
    assert rows(aggregate.count_of_limited(people, 2)) == [(2,)]
    assert aggregate.first_rows(people, 2).count() == 2


RECORDS = [
    # seq, trade, message, status, second
    (1, "t1", "m1", None, 0.0),
    (2, "t1", None, "7", 2.0),
    (3, "t2", "m2", None, 1.0),
    (4, "t3", None, "8", 1.0),
    (5, "t1", "m3", None, 100.0),
    (6, "t1", None, "9", 110.0),
    (7, "t1", None, "6", 111.0),
]


def test_pairs_by_count_and_last(spark):
    found = windows.tumbling(fixtures.topic(spark, RECORDS), "20 seconds").cache()
    by_count = rows(windows.pair_by_count(found).select("trade_id", "msg_id", "status_code"))
    assert Counter(by_count) == {("t1", "m1", "7"): 1, ("t1", "m3", "9"): 1, ("t2", None, None): 1}
    by_last = rows(
        windows.pair_by_last(found).select(
            "trade_id", F.coalesce("msg_id", F.lit("-")), F.coalesce("status_code", F.lit("-"))
        )
    )
    assert by_last == [
        ("t1", "m1", "7"), ("t1", "m3", "6"), ("t2", "-", "-"), ("t3", "-", "-")
    ]
    texts = {r["value"] for r in windows.pair_by_count(found).collect()}
    assert '{"msgId":"m1","statusCode":"7"}' in texts
    assert any(jsontext.MESSAGE_DELAYED in t for t in texts)


@pytest.mark.parametrize("min_rows", [0, 1000])
def test_sessions_merge_at_the_gap(spark, min_rows):
    """A record exactly one gap after the last still belongs to the session."""
    times = [0.0, 10.0, 19.5, 29.500001, 60.0, 69.999999, 79.999998]
    records = fixtures.topic(spark, [(i, "t", f"m{i}", None, t) for i, t in enumerate(times)])
    counts = windows.sessions(records, 10, aggregates={"records": F.count(F.lit(1))},
                              merges={"records": F.sum}, min_rows=min_rows)
    assert [r["records"] for r in counts.orderBy("window.start").collect()] == [3, 1, 3]
    placed = correlate.with_session(records, 10, min_rows=min_rows)
    per_session = placed.groupBy("session_start", "session_end").count()
    assert Counter(r["count"] for r in per_session.collect()) == {3: 2, 1: 1}


@pytest.mark.parametrize("min_rows", [100, 10**9])
def test_sessions_of_heavy_keys_equal_others(spark, min_rows):
    records = spark.range(600).selectExpr(
        "id as seq",
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 5 as string) end as trade_id",
        "if(id % 2 = 0, 'm' || id, null) as msg_id",
        "if(id % 2 = 0, null, '' || id % 10) as status_code",
        "timestamp_micros(1700000000000000 + (id * 7919 % 1000) * 700000) as create_time",
    ).cache()
    found = windows.sessions(records, 2, min_rows=min_rows)
    native = windows.stream_sessions(records, "2 seconds")
    assert Counter(map(str, found.collect())) == Counter(map(str, native.collect()))
    placed = correlate.with_session(records, 2, min_rows=min_rows)
    bounds = placed.groupBy("trade_id", "session_start", "session_end").count()
    assert Counter(map(tuple, bounds.collect())) == Counter(
        (r["trade_id"], r["window"]["start"], r["window"]["end"], r["records"])
        for r in native.collect()
    )


@pytest.mark.parametrize("min_rows", [1, 1000])
def test_session_join_makes_every_pair(spark, min_rows):
    records = fixtures.topic(
        spark,
        [(1, "t", "m1", None, 0.0), (2, "t", None, "1", 2.0), (3, "t", "m2", None, 4.0),
         (4, "t", None, "2", 6.0), (5, "t", "m3", None, 50.0), (6, "u", None, "3", 0.0)],
    )
    pairs = correlate.session_join(
        records.where("msg_id IS NOT NULL"), records.where("msg_id IS NULL"), 3, min_rows=min_rows
    )
    assert rows(pairs.select("msg_id", "status_code")) == [
        ("m1", "1"), ("m1", "2"), ("m2", "1"), ("m2", "2")
    ]
    failed = windows.pair_or_failure(
        pairs.limit(1).withColumn("msg_id", F.lit(""))
    ).first()["value"]
    assert jsontext.MESSAGE_FAILED in failed


@pytest.mark.parametrize("block_s", [None, 1, 3600])
def test_correlation_within_a_time_to_live(spark, block_s):
    records = fixtures.topic(
        spark,
        [(1, "t", None, "0", 0.0),       # nothing remembered yet
         (2, "t", "m1", None, 1.0), (3, "t", None, "1", 10.9), (4, "t", None, "2", 11.0),
         (5, "t", "m2", None, 12.0), (6, "t", "m3", None, 13.0), (7, "t", None, "3", 22.9),
         (8, "u", None, "4", 13.0)],
    )
    got = correlate.correlate_within(records, 10, block_s=block_s, min_rows=2)
    assert rows(got.select("seq", "msg_id", "status_code")) == [(3, "m1", "1"), (7, "m3", "3")]


def test_state_history_counts_distinct_entries(spark):
    records = spark.createDataFrame(
        [("a", "1", 1), ("a", "1", 2), ("a", "2", 3), ("b", "1", 4), ("a", "1", 5)],
        "msg_id string, status_code string, seq long",
    )
    for block in (1, 100):
        got = correlate.state_history(records, block=block, min_rows=1).orderBy("seq")
        assert [r["entries"] for r in got.collect()] == [1, 1, 2, 1, 2]


def test_heavy_keys_include_null(spark):
    df = spark.range(100).selectExpr("if(id < 60, null, id) as k")
    assert [tuple(r) for r in heavy_keys(df, ["k"], min_rows=10).collect()] == [(None,)]
    assert heavy_keys(df, ["k"], min_rows=60) is None
