"""Streams over several files: sessions, changes, lookups and restarts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import Feed, feed, run_batches  # noqa: F401
from tidematch.functions.timetext import epoch_micros
from tidematch.operators import changelog, correlate
from tidematch.plans import coupon, inputs, rounds
from tidematch.session import streaming_session
from tidematch.sources import lookups
from tidematch.streaming import deltas, jobs, sessions, watermarks

SF = "/root/testdata/sf0.001"


def pairs_of(feed, gap_s, delay):
    records = watermarks.bounded_disorder(feed.stream(), delay)
    return sessions.session_pairs(
        records.where("msg_id IS NOT NULL"), records.where("msg_id IS NULL"), gap_s
    )


def told(rows):
    return sorted((r["msg_id"], r["status_code"], (r["session_end"] - r["session_start"]).total_seconds()) for r in rows)


def test_a_late_record_bridges_two_sessions(feed):  # noqa: F811
    given = run_batches(
        feed, pairs_of(feed, 5, "20 seconds"),
        [
            [(1, "t", "m1", None, 0.0), (2, "t", None, "1", 8.0), (3, "u", "m2", None, 0.0)],
            [(4, "t", "m3", None, 4.0)],          # joins 0 and 8 into one session
            [(5, "t", None, "2", 30.0)],          # watermark 10: that session, till 13, is open
            [(6, "t", None, "3", 33.1)],          # watermark 13.1: over
            [(7, "t", "m4", None, 35.0), (8, "u", None, "9", 5.0)],  # u's record is late
            [(9, "x", "m5", None, 90.0)],         # all but x closes
        ],
    )
    assert [told(rows) for rows in given[:3]] == [[], [], []]
    assert told(given[3]) == [("m1", "1", 13.0), ("m3", "1", 13.0)]
    assert told(given[4]) == []
    assert told(given[5]) == [("m4", "2", 10.0), ("m4", "3", 10.0)]


def test_a_record_exactly_a_gap_later_joins(feed):  # noqa: F811
    given = run_batches(
        feed, pairs_of(feed, 5, "0 seconds"),
        [
            [(1, "t", "m1", None, 0.0)],
            [(2, "t", None, "1", 5.0)],
            [(3, "t", None, "2", 10.0)],
            [(4, "t", None, "3", 15.001)],
            [(5, "x", "m5", None, 90.0)],
        ],
    )
    assert [told(rows) for rows in given] == [[], [], [], [("m1", "1", 15.0), ("m1", "2", 15.0)], []]


def test_pairs_come_in_pieces(monkeypatch):
    monkeypatch.setattr(sessions, "PAIRS_AT_ONCE", 10)
    messages, statuses = [(k, f"m{k}") for k in range(7)], [(k, f"s{k}") for k in range(23)]
    parts = list(sessions.SessionPairs._pairs("t", 0, 9, messages, statuses))
    assert all(len(p) <= 10 for p in parts)
    found = [tuple(r) for p in parts for r in p[["msg_id", "status_code"]].to_numpy()]
    assert len(found) == len(set(found)) == 7 * 23


def test_spans_merge_like_sorted_records():
    rng = random.Random(4)
    for _ in range(200):
        at = [rng.randrange(300) for _ in range(rng.randrange(1, 30))]
        held = []
        rest = list(at)
        while rest:
            some, rest = rest[:4], rest[4:]
            held = sessions.merged(held + sessions.spans_of(np.array(some), 10), 10)
        wanted = []
        for a in sorted(at):
            if wanted and a - wanted[-1][1] <= 10:
                wanted[-1] = (wanted[-1][0], a)
            else:
                wanted.append((a, a))
        assert held == wanted


def test_the_stream_gives_the_batch_form_of_closed_sessions(spark):
    """Over disordered rounds: no closed session lacks a pair or has one too many."""
    stream = rounds.stream_session_join(spark, SF)
    records = inputs.topics(spark, SF)
    batch = correlate.session_join(
        records.where("msg_id IS NOT NULL"), records.where("msg_id IS NULL"), rounds.GAP_S
    )
    whole = batch.select(
        "trade_id", "msg_id", "status_code", epoch_micros(F.col("session_end")).alias("session_end")
    )
    got = {tuple(r) for r in stream.select(*whole.columns).collect()}
    all_pairs = {tuple(r) for r in whole.collect()}
    last_open = min((r[3] for r in all_pairs - got), default=None)
    assert got <= all_pairs and len(got) > 50
    assert last_open is None or all(r[3] <= last_open for r in got)


def test_changes_of_a_join_replay_to_its_counts(spark, tmp_path):
    """Random rows on both sides, repeated keys, null keys, a group of two columns."""
    rng = random.Random(8)
    session = streaming_session(spark)
    left, right = [], []
    kinds = {"l": "k long, g string", "r": "k long"}
    for number in range(5):
        more = {
            "l": [(rng.choice([None, 1, 2, 3]), rng.choice(["a", None])) for _ in range(rng.randrange(6))],
            "r": [(rng.choice([None, 1, 2, 4]),) for _ in range(rng.randrange(6))],
        }
        left += more["l"]
        right += more["r"]
        streams = {}
        for side, rows in more.items():
            spark.createDataFrame(rows, kinds[side]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{side}")
            streams[side] = session.readStream.schema(kinds[side]).parquet(f"{tmp_path}/{side}")
        changes = deltas.join_count_changes(streams["l"], streams["r"], "k", "k", ["k", "g"])
        jobs.run_available(
            jobs.batch_writer(changes, jobs.write_batch(f"{tmp_path}/rows"), f"{tmp_path}/checkpoint")
        )
        wanted = Counter((k, g) for k, g in left for (r,) in right if k is not None and k == r)
        if (tmp_path / "rows").exists():
            net = changelog.net_result(spark.read.parquet(f"{tmp_path}/rows"), ["k", "g"]).collect()
            assert {(r["k"], r["g"]): r["total"] for r in net} == dict(wanted)
        else:
            assert not wanted
    assert wanted


def test_top_list_holds_few_rows(spark, tmp_path):
    """The list's state does not follow the number of names."""
    session = streaming_session(spark)
    rng = random.Random(2)
    seen = Counter()
    for _ in range(3):
        names = [int(rng.paretovariate(0.6)) % 4000 for _ in range(3000)]
        seen.update(names)
        spark.createDataFrame([(n,) for n in names], "n long").write.mode("append").parquet(f"{tmp_path}/in")
        stream = session.readStream.schema("n long").parquet(f"{tmp_path}/in")
        changes = deltas.top_changes(stream, F.col("n"), 5, parts=4)
        query = jobs.run_available(
            jobs.batch_writer(changes, jobs.write_batch(f"{tmp_path}/rows"), f"{tmp_path}/checkpoint")
        )
        net = changelog.net_result(spark.read.parquet(f"{tmp_path}/rows"), ["name", "rank"]).collect()
        best = sorted(((-c, str(n)) for n, c in seen.items()))[:5]
        assert [(r["name"], r["total"]) for r in sorted(net, key=lambda r: r["rank"])] == [
            (n, -c) for c, n in best
        ]
    rows = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
    assert max(rows) >= len(seen) > 400 and min(rows) <= 5


def test_a_failure_changes_nothing(spark):
    broken = rounds.stream_resume_state(spark, SF).collect()
    whole = rounds.stream_resume_state(spark, SF, fail_in=None).collect()
    assert sorted(map(tuple, broken)) == sorted(map(tuple, whole))
    assert {r["place"] for r in broken} == {"given", "held"}


def test_a_lookup_is_read_again_when_its_table_changes(spark, tmp_path):
    path = f"{tmp_path}/people"
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").write.parquet(path)
    lookup = lookups.FreshLookup(path, lambda rows: rows.where("id = 1").select("name"))
    assert [r["name"] for r in lookup(spark).collect()] == ["a"]
    assert [r["name"] for r in lookup(spark).collect()] == ["a"] and lookup.reads == 1
    spark.createDataFrame([(1, "c")], "id long, name string").write.mode("append").parquet(path)
    assert sorted(r["name"] for r in lookup(spark).collect()) == ["a", "c"] and lookup.reads == 2


def test_a_request_sent_again_is_passed_once(spark, tmp_path):
    """In the same file, in a later one after a restart; without an id each passes."""
    session = streaming_session(spark)
    kinds = "unique_req_id string, coupon_id string"
    for some in ([("a", "1"), ("a", "1"), (None, "2")], [("a", "3"), ("b", "4"), (None, "2")]):
        spark.createDataFrame(some, kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = session.readStream.schema(kinds).parquet(f"{tmp_path}/in")
        once = coupon.once_per_request(stream)
        jobs.run_available(jobs.file_writer(once, f"{tmp_path}/rows", f"{tmp_path}/checkpoint"))
    rows = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert sorted((str(r["unique_req_id"]), r["coupon_id"]) for r in rows) == [
        ("None", "2"), ("None", "2"), ("a", "1"), ("b", "4"),
    ]


@pytest.mark.parametrize("name", ["stream_late_rounds", "stream_ttl_lives"])
def test_the_input_has_what_the_query_is_about(spark, name):
    rows = rounds.ROUND_QUERIES[name](spark, SF).collect()
    if name == "stream_late_rounds":
        assert any(r["given"] > 1 for r in rows if r["kind"] == "window")
        assert sum(r["records"] for r in rows if r["kind"] == "late") > 0
    else:
        assert {r["life"] for r in rows} == {"long"}
