"""Registered stream queries that use helpers for processing time, routes and event state."""

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tidematch.operators import route
from tidematch.plans import oracle, streams
from tidematch.streaming import jobs, keyed

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["stream_event_ttl", "stream_processing_windows", "stream_routes"])
def test_equals_its_sql(spark, name):
    df = streams.STREAMS[name](spark, SF)
    assert differences(df, connect(SF), oracle.SQL[name]) is None


def test_processing_time_query_ends(spark):
    """Against a plain reading: all of a key's rows come while its message lives."""
    df = streams.stream_ttl(spark, SF)
    assert df.columns == ["trade_id", "msg_id", "status_code"]
    held, wanted = {}, []
    rows = streams.inputs.topics(spark, SF).orderBy("create_time", "seq").collect()
    for r in rows:
        if r["msg_id"]:
            held[r["trade_id"]] = r["msg_id"]
        elif r["trade_id"] in held:
            wanted.append((r["trade_id"], held[r["trade_id"]], r["status_code"]))
    assert sorted(map(tuple, df.collect())) == sorted(wanted)


def test_event_state_has_a_watermark(spark, monkeypatch):
    """Without one no timer ever frees a key."""
    given = []
    real = keyed.correlate_by_event_state
    monkeypatch.setattr(keyed, "correlate_by_event_state", lambda df, ttl: given.append(df) or real(df, ttl))
    streams.stream_event_ttl(spark, SF)
    assert "EventTimeWatermark" in given[0]._jdf.queryExecution().analyzed().toString()


def test_routes_of_a_repeated_batch_count_once(spark, tmp_path):
    names = (route.MAIN, route.SIDE)
    write = route.write_routes({n: jobs.write_batch(f"{tmp_path}/{n}") for n in names})
    marked = route.route(spark.range(10), F.col("id") < 3)
    for _ in range(2):
        write(marked, 0)
    assert [spark.read.parquet(f"{tmp_path}/{n}").count() for n in names] == [3, 7]
