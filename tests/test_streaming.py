"""Streams fed file by file: lateness, watermarks, state and restarts."""

import itertools

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from tidematch.functions.jsontext import MESSAGE_INCOMPLETE
from tidematch.operators import correlate, windows
from tidematch.plans import coupon
from tidematch.session import streaming_session
from tidematch.sources import partitions, tables
from tidematch.streaming import jobs, keyed, watermarks


class Feed:
    """A folder stream to which rows are added one file at a time."""

    def __init__(self, spark, folder, session=None):
        self.spark, self.folder = spark, str(folder)
        self.session = session or streaming_session(spark)
        self.numbers = itertools.count()
        (folder / "in").mkdir()

    def add(self, rows):
        df = fixtures.topic(self.spark, rows).coalesce(1)
        df.write.parquet(f"{self.folder}/in/{next(self.numbers)}")

    def stream(self):
        return (
            self.session.readStream.schema(fixtures.topic(self.spark, []).schema)
            .option("recursiveFileLookup", "true")
            .parquet(f"{self.folder}/in")
        )


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def run_batches(feed, df, batches, mode="append"):
    """Rows given out after each batch of input."""
    given = []
    current = []

    def take(batch, batch_id):
        current.extend(batch.collect())

    writer = jobs.batch_writer(df, take, f"{feed.folder}/checkpoint", mode)
    for rows in batches:
        feed.add(rows)
        current.clear()
        jobs.run_available(writer)
        given.append(list(current))
    return given


def test_late_rows_reopen_windows_until_lateness_ends(feed):
    df = windows.tumbling(
        watermarks.with_lateness(feed.stream(), 1, 1), "10 seconds",
        aggregates={"records": F.count(F.lit(1))},
    )
    given = run_batches(
        feed, df,
        [
            [(1, "t", "m1", None, 1.0)],
            [(2, "t", None, "1", 11.5)],  # watermark at 9.5: the window is still open
            [(3, "t", None, "2", 2.0)],   # late, counted again
            [(4, "t", None, "3", 13.0)],  # watermark at 11: the window is closed
            [(5, "t", None, "4", 3.0)],   # too late
        ],
        "update",
    )
    counts = [sorted((r["window"].start.second, r["records"]) for r in rows) for rows in given]
    first = counts[0][0][0]
    assert counts[0] == [(first, 1)]
    assert (first, 2) in counts[2]
    assert counts[4] == []


def test_late_rows_are_dropped_after_the_watermark(feed):
    df = windows.pair_by_last(
        windows.tumbling(watermarks.bounded_disorder(feed.stream()), "10 seconds")
    )
    given = run_batches(
        feed, df,
        [
            [(1, "t", "m1", None, 1.0), (2, "t", None, "1", 2.0)],
            [(3, "t", "m2", None, 25.0)],
            [(4, "t", None, "9", 3.0)],
            [(5, "t", "m3", None, 60.0)],
        ],
    )
    assert [r["value"] for r in given[1]] == ['{"msgId":"m1","statusCode":"1"}']
    assert given[2] == []
    assert [r["status_code"] for r in given[3]] == [None]
    assert MESSAGE_INCOMPLETE in given[3][0]["value"]


def test_only_statuses_move_the_punctuated_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, streaming_session(spark, "max"))
    records = watermarks.punctuated_by_statuses(
        feed.stream().where("msg_id IS NOT NULL"), feed.stream().where("msg_id IS NULL")
    )
    df = windows.pair_by_last(windows.tumbling(records, "10 seconds"))
    given = run_batches(
        feed, df,
        [
            [(1, "t", "m1", None, 1.0), (2, "t", "m2", None, 500.0)],  # messages close nothing
            [(3, "t", None, "1", 2.0)],
            [(4, "t", None, "2", 40.0)],
        ],
    )
    assert given[0] == given[1] == []
    assert [(r["msg_id"], r["status_code"]) for r in given[2]] == [("m1", "1")]


def test_punctuation_needs_its_policy(feed):
    with pytest.raises(ValueError):
        watermarks.punctuated_by_statuses(feed.stream(), feed.stream())


def test_sessions_close_after_the_gap(feed):
    df = windows.pair_by_count(
        windows.stream_sessions(
            watermarks.bounded_disorder(feed.stream(), "0 seconds"), "10 seconds"
        )
    )
    given = run_batches(
        feed, df,
        [
            [(1, "t", "m1", None, 0.0)],
            [(2, "t", None, "1", 9.0)],
            [(3, "u", "m2", None, 100.0)],
        ],
    )
    assert given[0] == given[1] == []
    assert [(r["msg_id"], r["status_code"]) for r in given[2]] == [("m1", "1")]


def test_event_state_lives_over_batches_as_in_batch(spark, feed):
    batches = [
        [(1, "t", None, "0", 0.0), (2, "t", "m1", None, 1.0), (8, "u", "n1", None, 1.0)],
        [(3, "t", None, "1", 10.9), (4, "t", None, "2", 11.0), (9, "u", None, "5", 4.0)],
        [(6, "t", "m3", None, 13.0), (5, "t", "m2", None, 12.0), (7, "t", None, "3", 22.9)],
    ]
    given = run_batches(
        feed, keyed.correlate_by_event_state(feed.stream(), 10_000), batches
    )
    got = sorted((r["seq"], r["msg_id"], r["status_code"]) for rows in given for r in rows)
    batch = correlate.correlate_within(fixtures.topic(spark, sum(batches, [])), 10)
    assert got == sorted(map(tuple, batch.select("seq", "msg_id", "status_code").collect()))
    assert got == [(3, "m1", "1"), (7, "m3", "3"), (9, "n1", "5")]


def test_entry_history_over_batches(feed):
    given = run_batches(
        feed, keyed.entry_history(feed.stream()),
        [
            [(1, "", "a", "1", 0.0), (2, "", "a", "1", 0.0), (3, "", "a", "2", 0.0)],
            [(4, "", "a", "1", 0.0), (5, "", "a", "3", 0.0), (6, "", "b", "1", 0.0)],
        ],
    )
    assert sorted((r["seq"], r["entries"]) for rows in given for r in rows) == [
        (1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 1)
    ]
    assert all(r["update_time"] is not None for rows in given for r in rows)


def test_sum_changes_over_batches(feed):
    scores = feed.stream().selectExpr("trade_id as name", "cast(second(create_time) as bigint) as s",
                                      "cast(status_code as bigint) as score", "seq")
    given = run_batches(
        feed, keyed.sum_changes(scores),
        [
            [(1, "Alice", None, "12", 0.0), (2, "Bob", None, "10", 0.0)],
            [(3, "Alice", None, "100", 0.0), (4, "Bob", None, "0", 0.0)],
        ],
    )
    assert [sorted((r["seq"], r["is_add"], r["name"], r["total"]) for r in rows) for rows in given] == [
        [(1, True, "Alice", 12), (2, True, "Bob", 10)],
        [(3, False, "Alice", 12), (3, True, "Alice", 112)],
    ]


def test_processing_time_state_expires(spark, feed):
    """A message is paired while it lives; with no life at all nothing is."""
    feed.add([(1, "t", "m1", None, 0.0)])
    df = keyed.correlate_by_state(feed.stream(), 600_000)
    writer = jobs.file_writer(df, f"{feed.folder}/out", f"{feed.folder}/checkpoint")
    jobs.run_until_idle(writer)
    feed.add([(2, "t", None, "7", 1.0), (3, "u", None, "8", 1.0)])
    jobs.run_until_idle(writer)
    got = spark.read.schema(df.schema).parquet(f"{feed.folder}/out").collect()
    assert [tuple(r) for r in got] == [("t", "m1", "7")]


def test_short_lived_state_is_forgotten(spark, feed):
    feed.add([(1, "t", "m1", None, 0.0)])
    df = keyed.correlate_by_state(feed.stream(), 1)
    writer = jobs.file_writer(df, f"{feed.folder}/out", f"{feed.folder}/checkpoint")
    jobs.run_until_idle(writer)
    feed.add([(2, "t", None, "7", 1.0)])
    jobs.run_until_idle(writer)
    assert spark.read.schema(df.schema).parquet(f"{feed.folder}/out").count() == 0


@pytest.mark.parametrize("session", [False, True])
def test_processing_time_windows_close_by_themselves(spark, feed, session):
    feed.add([(1, "t", "m1", None, 0.0), (2, "t", None, "7", 1.0), (3, "t", None, "8", 2.0),
              (4, "u", "m2", None, 0.0), (5, "v", None, "9", 0.0)])
    df = keyed.processing_windows(feed.stream(), 2000, session)
    writer = jobs.file_writer(df, f"{feed.folder}/out", f"{feed.folder}/checkpoint")
    jobs.run_until_idle(writer, idle_s=6)
    found = spark.read.schema(df.schema).parquet(f"{feed.folder}/out")
    by_count = windows.pair_by_count(found)
    assert sorted((r["trade_id"], r["msg_id"], r["status_code"]) for r in by_count.collect()) == [
        ("t", "m1", "7"), ("u", None, None)
    ]
    by_last = windows.pair_by_last(found).where("msg_id IS NOT NULL").collect()
    assert [(r["msg_id"], r["status_code"]) for r in by_last] == [("m1", "8")]
    assert {r["records"] for r in found.collect()} == {3, 1}


def test_stream_sees_a_partition_added_between_batches(spark, tmp_path):
    users = f"{tmp_path}/users"
    located = fixtures.user_location(spark)
    tables.write_partitioned(located.withColumn("partstart", F.lit("20220207")), users)
    lines = spark.createDataFrame(
        [('{"COUPON_ID":"C1","STORE_RANGE":"500","STORE_LONGITUDE":"35.1012",'
          '"STORE_LATITUDE":"15.1012","USER_NUM":"1","STORE_ID":"S1","UNIQUE_REQ_ID":"R%d"}' % i,)
         for i in (1, 2)], "value string")
    lines.limit(1).write.text(f"{tmp_path}/in/1")
    session = streaming_session(spark)
    stream = session.readStream.option("recursiveFileLookup", "true").text(f"{tmp_path}/in")
    given = {}
    latest = partitions.LatestPartition(users)

    def write(records, batch_id):
        given[batch_id] = sorted(r["id_number"] for r in records.where("message_type='02'").collect())

    run = coupon.coupon_batch(latest, write)
    writer = jobs.batch_writer(coupon.parse_requests(stream), run, f"{tmp_path}/checkpoint")
    jobs.run_available(writer)
    tables.write_partitioned(
        located.where("cert_nbr = '55555'").withColumn("partstart", F.lit("20220210")), users
    )
    lines.where("value LIKE '%R2%'").write.text(f"{tmp_path}/in/2")
    jobs.run_available(writer)
    assert list(given.values()) == [["44444", "55555", "66666"], ["55555"]]


def test_all_partitions_stream_finds_new_ones(spark, tmp_path):
    path = f"{tmp_path}/users"
    rows = fixtures.user_location(spark).select("cert_nbr")
    tables.write_partitioned(rows.withColumn("partstart", F.lit("20220207")), path)
    stream = partitions.all_partitions_stream(streaming_session(spark), path)
    writer = jobs.file_writer(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    jobs.run_available(writer)
    tables.write_partitioned(rows.limit(2).withColumn("partstart", F.lit("20220210")), path)
    jobs.run_available(writer)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_restart_after_failures(spark, feed):
    feed.add([(i, "t", "m", None, 0.0) for i in range(5)])
    tries = []

    def write(batch, batch_id):
        tries.append(batch_id)
        if len(tries) < 3:
            raise RuntimeError("lost")
        jobs.write_batch(f"{feed.folder}/out")(batch, batch_id)

    def start():
        return jobs.batch_writer(feed.stream(), write, f"{feed.folder}/checkpoint").trigger(
            availableNow=True
        ).start()

    jobs.run_resumable(start, delay_s=0)
    assert len(tries) == 3
    assert spark.read.parquet(f"{feed.folder}/out").count() == 5


def test_restarts_are_limited(feed):
    feed.add([(1, "t", "m", None, 0.0)])

    def write(batch, batch_id):
        raise RuntimeError("lost")

    def start():
        return jobs.batch_writer(feed.stream(), write, f"{feed.folder}/checkpoint").trigger(
            availableNow=True
        ).start()

    with pytest.raises(Exception, match="lost"):
        jobs.run_resumable(start, restarts=1, delay_s=0)


def test_print_writer_names_the_query(feed):
    feed.add([(1, "t", "m", None, 0.0)])
    query = jobs.run_available(
        jobs.print_writer(feed.stream(), "label").option(
            "checkpointLocation", f"{feed.folder}/checkpoint"
        )
    )
    assert query.name == "label"
