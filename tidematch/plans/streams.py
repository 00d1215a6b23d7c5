"""Streaming queries over the driver's tables, run until the input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidematch.functions.timetext import epoch_micros
from tidematch.operators import aggregate, joins, route, shape, windows
from tidematch.plans import coupon, inputs
from tidematch.plans.queries import (
    GAP_S,
    TTL_S,
    WINDOW,
    batch_time,
    entry_records,
    score_records,
)
from tidematch.session import streaming_session, work_dir
from tidematch.sources import files, layout, partitions
from tidematch.streaming import jobs, keyed, watermarks


def _to_files(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run into a file sink and read the result."""
    folder = work_dir(spark, name)
    jobs.run_available(jobs.file_writer(df, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def _window_micros(df: DataFrame) -> DataFrame:
    return df.withColumns({c: epoch_micros(F.col(c)) for c in ("window_start", "window_end")})


def _topics(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.topic_stream(streaming_session(spark), sf)


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    records = watermarks.bounded_disorder(_topics(spark, sf), "0 seconds")
    found = windows.pair_by_last(windows.tumbling(records, WINDOW))
    return _window_micros(_to_files(spark, found, "tumbling"))


def stream_session(spark: SparkSession, sf: str) -> DataFrame:
    records = watermarks.bounded_disorder(_topics(spark, sf), "0 seconds")
    found = windows.pair_by_count(windows.stream_sessions(records, f"{GAP_S} seconds"))
    return _window_micros(_to_files(spark, found, "session"))


def stream_punctuated(spark: SparkSession, sf: str) -> DataFrame:
    """Windows closed by statuses only."""
    session = streaming_session(spark, watermark_policy="max")
    messages = inputs.topic_stream(session, sf).where("msg_id IS NOT NULL")
    statuses = inputs.topic_stream(session, sf).where("msg_id IS NULL")
    records = watermarks.punctuated_by_statuses(messages, statuses)
    found = windows.pair_by_last(windows.tumbling(records, WINDOW))
    return _window_micros(_to_files(spark, found, "punctuated"))


def stream_state_history(spark: SparkSession, sf: str) -> DataFrame:
    events = files.table_stream(streaming_session(spark), sf, "events")
    held = keyed.entry_history(entry_records(events))
    return _to_files(spark, held, "history").drop("update_time")


def stream_event_ttl(spark: SparkSession, sf: str) -> DataFrame:
    records = watermarks.bounded_disorder(_topics(spark, sf), "0 seconds")
    paired = keyed.correlate_by_event_state(records, TTL_S * 1000)
    return _to_files(spark, paired, "event-ttl")


def stream_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Time to live in processing time: the query does not end by itself."""
    paired = keyed.correlate_by_state(_topics(spark, sf), 600_000)
    folder = work_dir(spark, "ttl")
    jobs.run_until_used_up(jobs.file_writer(paired, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.schema(paired.schema).parquet(f"{folder}/rows")


def stream_processing_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions in processing time, closed by a timer; where they begin and end
    depends on the clock, the records they hold together do not."""
    found = keyed.processing_windows(_topics(spark, sf), 1000, session=True)
    folder = work_dir(spark, "processing")
    writer = jobs.file_writer(found, f"{folder}/rows", f"{folder}/checkpoint")
    jobs.run_until_used_up(writer, drain=True)
    rows = spark.read.schema(found.schema).parquet(f"{folder}/rows")
    return rows.groupBy("trade_id").agg(F.sum("records").alias("records"))


def _updates(spark: SparkSession, df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Run in update mode and keep the last row per key."""
    folder = work_dir(spark, name)
    write = jobs.write_batch(f"{folder}/rows")
    jobs.run_available(jobs.batch_writer(df, write, f"{folder}/checkpoint", "update"))
    return jobs.last_updates(spark.read.parquet(f"{folder}/rows"), keys)


def stream_late_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows given out again for late records until the lateness ends."""
    records = watermarks.with_lateness(_topics(spark, sf), 1, 1)
    counts = windows.tumbling(records, WINDOW, aggregates={"records": F.count(F.lit(1))})
    flat = counts.select(
        "trade_id", epoch_micros(F.col("window.start")).alias("window_start"), "records"
    )
    return _updates(spark, flat, ["trade_id", "window_start"], "late")


def stream_sum(spark: SparkSession, sf: str) -> DataFrame:
    scores = score_records(files.table_stream(streaming_session(spark), sf, "orders"))
    return _updates(spark, aggregate.sum_by(scores, ["name"], "score"), ["name"], "sum")


def stream_changelog(spark: SparkSession, sf: str) -> DataFrame:
    scores = score_records(files.table_stream(streaming_session(spark), sf, "orders"))
    return _to_files(spark, keyed.sum_changes(scores), "changelog")


def stream_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams into one."""
    session = streaming_session(spark)
    messages = inputs.topic_stream(session, sf).where("msg_id IS NOT NULL")
    statuses = inputs.topic_stream(session, sf).where("msg_id IS NULL")
    both = _to_files(spark, shape.union_all(messages, statuses), "union")
    return both.groupBy("trade_id").agg(
        F.count("msg_id").alias("messages"), F.count("status_code").alias("statuses")
    )


def stream_join_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stream joined with a table on equality."""
    session = streaming_session(spark)
    joined = joins.equi_join(
        files.table_stream(session, sf, "orders"),
        inputs.table(session, sf, "customer"),
        "o_custkey",
        "c_custkey",
    ).select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")
    return _to_files(spark, joined, "join")


def stream_lookup(spark: SparkSession, sf: str) -> DataFrame:
    session = streaming_session(spark)
    records = inputs.topic_stream(session, sf).select("seq")
    people = inputs.table(session, sf, "nation")
    found = joins.lookup_by_value(records, people, "n_nationkey", 1, ["n_nationkey", "n_name"])
    return _to_files(spark, found, "lookup")


def _coupon_stream(
    spark: SparkSession,
    requests: DataFrame,
    users: Callable,
    equal: dict | None = None,
    near: Callable | None = None,
) -> DataFrame:
    folder = work_dir(spark, "coupon")
    run = coupon.coupon_batch(users, jobs.write_batch(f"{folder}/rows"), equal, near)
    jobs.run_available(jobs.batch_writer(requests, run, f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


def _request_stream(session: SparkSession, sf: str) -> DataFrame:
    suppliers = files.table_stream(session, sf, "supplier")
    return coupon.parse_requests(inputs.request_lines(suppliers))


def stream_coupon(spark: SparkSession, sf: str) -> DataFrame:
    """The coupon job on a stream, users from all partitions; a request is answered
    once however often it is sent."""
    path = inputs.partitioned_users(spark, sf)
    requests = coupon.once_per_request(_request_stream(streaming_session(spark), sf))
    return _coupon_stream(spark, requests, lambda s: partitions.read_table(s, path))


def stream_temporal_join(spark: SparkSession, sf: str) -> DataFrame:
    """The coupon job on a stream, users of the partition that is the latest when
    the micro-batch runs, joined on type as well. Users are stored by place, so a
    micro-batch reads the files of the places that its requests reach."""
    latest = partitions.LatestPartition(inputs.placed_users(spark, sf), interval_s=20)
    requests = _request_stream(streaming_session(spark), sf)
    enriched = shape.enrich_request(requests, "3", batch_time())
    return _coupon_stream(spark, enriched, latest, {"type": "cert_type"}, layout.near)


def stream_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Main and side output of one stream, computed once per micro-batch."""
    parts = files.table_stream(streaming_session(spark), sf, "part")
    named = shape.pick(parts, {"p_partkey": "id", "p_name": "name"})
    routed = route.route(named, F.col("name").startswith("r"))
    folder = work_dir(spark, "routes")
    names = (route.MAIN, route.SIDE)
    write = route.write_routes({n: jobs.write_batch(f"{folder}/{n}") for n in names})
    jobs.run_available(jobs.batch_writer(routed, write, f"{folder}/checkpoint"))
    outputs = [
        spark.read.parquet(f"{folder}/{n}").drop("batch_id").withColumn("route", F.lit(n))
        for n in names
    ]
    return outputs[0].unionByName(outputs[1])


def stream_top1(spark: SparkSession, sf: str) -> DataFrame:
    """The greatest count so far, kept complete."""
    orders = files.table_stream(streaming_session(spark), sf, "orders")
    counts = aggregate.count_by(orders, ["o_custkey"])
    top = aggregate.top_one(counts, "cnt", ["o_custkey"])
    folder = work_dir(spark, "top")
    write = jobs.write_result(f"{folder}/rows")
    jobs.run_available(jobs.batch_writer(top, write, f"{folder}/checkpoint", "complete"))
    return spark.read.parquet(f"{folder}/rows")


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Forward records unchanged, stop, and go on from the checkpoint: nothing is
    lost or taken twice."""
    folder = work_dir(spark, "resume")
    for _ in range(2):
        events = files.table_stream(streaming_session(spark), sf, "events")
        jobs.run_available(jobs.file_writer(events, f"{folder}/rows", f"{folder}/checkpoint"))
    rows = spark.read.schema(events.schema).parquet(f"{folder}/rows")
    return aggregate.count_by(rows, ["event_type"])


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        stream_tumbling,
        stream_session,
        stream_punctuated,
        stream_state_history,
        stream_event_ttl,
        stream_ttl,
        stream_processing_windows,
        stream_late_windows,
        stream_sum,
        stream_changelog,
        stream_union,
        stream_join_table,
        stream_lookup,
        stream_coupon,
        stream_temporal_join,
        stream_routes,
        stream_top1,
        stream_resume,
    )
}
