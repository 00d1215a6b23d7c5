"""One query per operator over the driver's tables. All read whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidematch.functions import jsontext, sqludf, timetext
from tidematch.functions.timetext import epoch_micros
from tidematch.operators import (
    aggregate,
    changelog,
    correlate,
    geojoin,
    joins,
    route,
    shape,
    windows,
)
from tidematch.plans import coupon, inputs
from tidematch.plans.inputs import table
from tidematch.schemas import REQUEST_KEYS, USER_LOCATION_INFO
from tidematch.session import work_dir
from tidematch.sources import files, partitions, tables

WINDOW_S = 6 * 3600
GAP_S = 2 * 3600
TTL_S = 4 * 3600
LIMIT = 10_000
WINDOW = f"{WINDOW_S} seconds"
COUNT_KEYS = ["coupon_id", "store_id", "store_range", "user_num"]


def batch_time() -> Column:
    """A fixed batch time, so that results can be compared."""
    return F.lit("2022-02-10 10:00:00").cast("timestamp")


# Coupon job -----------------------------------------------------------------


def coupon_match(spark: SparkSession, sf: str) -> DataFrame:
    return coupon.coupon_match(inputs.requests(spark, sf), inputs.users(spark, sf))


def coupon_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Result records as message text, without the random serial."""
    records = coupon_match(spark, sf).withColumn("serial_no", F.lit(None).cast("string"))
    return coupon.to_messages(records)


def coupon_match_day_night(spark: SparkSession, sf: str) -> DataFrame:
    """Each request's own time picks day or night positions."""
    sqludf.register(spark)
    number = F.expr("cast(substr(unique_req_id, 2) as bigint)")
    timed = inputs.requests(spark, sf).withColumn(
        "date_string", F.format_string("2022-02-10 10:%02d:00", number % 60)
    )
    by_period = timed.withColumn("period", F.expr("lat(date_string)"))
    faces = geojoin.two_faces(inputs.users(spark, sf))
    return geojoin.match_requests(by_period, faces, {"period": "period"}).select(
        "unique_req_id", "period", F.col("cert_nbr").alias("id_number"), "distance_m"
    )


def coupon_match_night(spark: SparkSession, sf: str) -> DataFrame:
    """One period for the whole batch, chosen by the batch time."""
    period = timetext.minute_parity_of_text(F.lit("2022-02-10 10:01:00"))
    users = geojoin.one_face(inputs.users(spark, sf), period)
    return coupon.coupon_match(inputs.requests(spark, sf), users)


def coupon_match_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The form for requests too many to broadcast: both sides shuffled by cell."""
    return geojoin.match_requests(
        inputs.requests(spark, sf), inputs.users(spark, sf), small_requests=False
    ).select("unique_req_id", F.col("cert_nbr").alias("id_number"), "distance_m")


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return coupon.matched_users(inputs.requests(spark, sf), inputs.users(spark, sf))


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    """The requests with a match, each with the number ``n`` of its matches."""
    return coupon.matched_requests(inputs.requests(spark, sf), inputs.users(spark, sf))


def coupon_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_all(_matched(spark, sf), weight="n")


def coupon_count_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by(_matched(spark, sf), COUNT_KEYS, "coupon_id", weight="n")


def coupon_top1(spark: SparkSession, sf: str) -> DataFrame:
    counts = coupon_count_by_key(spark, sf)
    return aggregate.top_one(counts, "cnt", COUNT_KEYS).drop("user_num")


def coupon_limit_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_of_limited(_matches(spark, sf), LIMIT)


def coupon_groups(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.groups(_matched(spark, sf), COUNT_KEYS)


def coupon_split(spark: SparkSession, sf: str) -> DataFrame:
    split = route.split_requests(inputs.requests(spark, sf))
    return split.select("unique_req_id", "message_type", "route")


def request_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed, renamed and enriched with batch time and a constant type."""
    enriched = shape.enrich_request(inputs.requests(spark, sf), "1", batch_time())
    return enriched.select(*REQUEST_KEYS, "store_latitude", "type", "date_string")


# Single records -------------------------------------------------------------


def filter_chain(spark: SparkSession, sf: str) -> DataFrame:
    grown = shape.at_least(table(spark, sf, "part"), "p_size", 18)
    return shape.pick(
        shape.starts_with(grown, "p_name", "r"),
        {"p_partkey": "id", "p_name": "name", "p_size": "age"},
    )


def text_contains(spark: SparkSession, sf: str) -> DataFrame:
    lines = shape.pick(table(spark, sf, "part"), {"p_partkey": "id", "p_name": "value"})
    return shape.containing(lines, "ring")


def side_route(spark: SparkSession, sf: str) -> DataFrame:
    named = shape.pick(table(spark, sf, "part"), {"p_partkey": "id", "p_name": "name"})
    return route.route(named, F.col("name").startswith("r"))


def window_side_output(spark: SparkSession, sf: str) -> DataFrame:
    results = windows.window_info(inputs.topics(spark, sf), WINDOW)
    return route.both(results.select("trade_id", "bounds", "result"))


def json_enrich(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    return shape.set_json_field(records, "processFlag", "true")


def json_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.topic_lines(inputs.topics(spark, sf))
    return shape.json_field_equals(lines, "statusCode", "0")


def json_flatmap(spark: SparkSession, sf: str) -> DataFrame:
    records = shape.stamp_low_status(inputs.topics(spark, sf), batch_time())
    return records.select(
        "seq", "status_code", timetext.format_time(F.col("update_time")).alias("update_time")
    )


def json_types(spark: SparkSession, sf: str) -> DataFrame:
    """Object to map, array to list, and a copy to another record type."""
    events = table(spark, sf, "events").select(
        "event_id",
        "props",
        F.to_json(F.array("event_id", "user_id")).alias("items"),
    )
    record = jsontext.parse_record(F.col("props"), _int_field("k"))
    return events.select(
        "event_id",
        jsontext.parse_map(F.col("props"))["k"].cast("bigint").alias("from_map"),
        jsontext.parse_list(F.col("items"), "bigint")[1].alias("from_list"),
        jsontext.copy_as(record, _int_field("k"))["k"].alias("from_copy"),
    )


def _int_field(name: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType())])


def job_param(spark: SparkSession, sf: str) -> DataFrame:
    names = shape.pick(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name"})
    return shape.append_parameter(names, "name", "tide")


def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """A registered view queried by SQL with a bound parameter."""
    return shape.query_view(
        table(spark, sf, "customer"),
        "people_view",
        "SELECT c_custkey AS id, c_name AS name FROM people_view WHERE c_mktsegment = :segment",
        {"segment": "BUILDING"},
    )


def union_topics(spark: SparkSession, sf: str) -> DataFrame:
    records = inputs.topics(spark, sf)
    messages = records.where("msg_id IS NOT NULL").drop("status_code")
    statuses = records.where("msg_id IS NULL").drop("msg_id")
    both = shape.union_all(messages, statuses)
    return both.groupBy("trade_id").agg(
        F.count("msg_id").alias("messages"), F.count("status_code").alias("statuses")
    )


# Joins ----------------------------------------------------------------------


def table_product(spark: SparkSession, sf: str) -> DataFrame:
    """Every request with every row of a small table."""
    people = shape.pick(table(spark, sf, "region"), {"r_name": "name"})
    return joins.attach_rows(inputs.requests(spark, sf).select("unique_req_id"), people)


def product_count(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "nation").where("n_regionkey = 1")
    return joins.count_attached(inputs.topics(spark, sf), people)


def equi_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.equi_join(
        table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey", "c_custkey"
    )
    return joined.select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


def where_equi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Joined rows counted per group, from counts of either side."""
    return joins.count_joined(
        table(spark, sf, "customer"),
        table(spark, sf, "orders"),
        "c_custkey",
        "o_custkey",
        ["c_custkey", "c_mktsegment"],
    )


def skew_join(spark: SparkSession, sf: str) -> DataFrame:
    """A join on a few heavy keys, split into chunks, counted per pair of groups."""
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("key"), "s_suppkey"
    )
    # Customers alike in key and group meet a supplier as one row with their number,
    # so pairs grow with the suppliers and not with the product of both sides.
    customers = (
        table(spark, sf, "customer")
        .groupBy(F.col("c_nationkey").alias("key"), "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    joined = joins.salted_join(suppliers, customers, ["key"], 16, min_rows=1, min_pairs=1)
    return joined.groupBy("s_suppkey", "c_mktsegment").agg(F.sum("customers").alias("cnt"))


def lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of one key, looked up for every record."""
    records = inputs.topics(spark, sf).select("seq")
    people = table(spark, sf, "nation")
    return joins.lookup_by_value(records, people, "n_nationkey", 1, ["n_nationkey", "n_name"])


# Partitions and tables ------------------------------------------------------


def _summary(users: DataFrame) -> DataFrame:
    return users.groupBy("partstart").agg(
        F.count(F.lit(1)).alias("cnt"), F.max(F.col("cert_nbr").cast("bigint")).alias("last_nbr")
    )


def partition_fixed(spark: SparkSession, sf: str) -> DataFrame:
    users = partitions.read_table(spark, inputs.partitioned_users(spark, sf))
    chosen = partitions.fixed_partition(users, "20220210")
    return _summary(chosen).withColumn("partstart", F.col("partstart").cast("string"))


def partition_latest(spark: SparkSession, sf: str) -> DataFrame:
    users = partitions.latest_partition(spark, inputs.partitioned_users(spark, sf))
    return _summary(users).withColumn("partstart", F.col("partstart").cast("string"))


def partition_all(spark: SparkSession, sf: str) -> DataFrame:
    users = partitions.read_table(spark, inputs.partitioned_users(spark, sf))
    return _summary(users).withColumn("partstart", F.col("partstart").cast("string"))


def temporal_join(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with users of the latest partition, on type and range."""
    users = partitions.latest_partition(spark, inputs.partitioned_users(spark, sf))
    enriched = shape.enrich_request(inputs.requests(spark, sf), "3", batch_time())
    return geojoin.match_requests(enriched, users, {"type": "cert_type"}).select(
        "unique_req_id", "type", F.col("cert_nbr").alias("id_number"), "distance_m"
    )


def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited text into a partitioned table, one partition overwritten, a
    second table filled, emptied and filled again."""
    located = inputs.users(spark, sf)
    day = F.lit(None).cast("date")
    rows = located.withColumn("work_day", day).withColumn("destination", F.col("partstart"))
    folder = work_dir(spark, "roundtrip")
    files.write_delimited(rows.select(*USER_LOCATION_INFO.fieldNames()), f"{folder}/text")
    source = files.delimited(spark, f"{folder}/text", USER_LOCATION_INFO)
    database = "roundtrip_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, database, f"{folder}/tables")
    name = f"{database}.users"
    tables.create_table(spark, name, USER_LOCATION_INFO)
    tables.insert_rows(source.withColumn("partstart", F.col("destination")), name)
    tables.truncate(spark, name)
    tables.insert_rows(source.withColumn("partstart", F.col("destination")), name)
    tables.overwrite_partition(source.where("cert_type = '1'"), name, "20220210")
    return (
        spark.table(name)
        .groupBy("partstart", "cert_type")
        .agg(F.count(F.lit(1)).alias("cnt"), F.count("work_day").alias("days"))
    )


# Sums and changelog ---------------------------------------------------------


def score_records(orders: DataFrame) -> DataFrame:
    """Orders as scores of their customers."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("name"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("score"),
        F.col("o_orderkey").alias("seq"),
    )


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return score_records(table(spark, sf, "orders"))


def sum_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.sum_by(_scores(spark, sf), ["name"], "score")


def sum_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.sum_changelog(_scores(spark, sf), ["name"], "score", "seq")


# Windows and correlation ----------------------------------------------------


def _bounds(df: DataFrame) -> DataFrame:
    """Window bounds as microseconds, which every engine compares alike."""
    bounds = [c for c in df.columns if c.endswith(("_start", "_end"))]
    return df.withColumns({c: epoch_micros(F.col(c)) for c in bounds})


def tumbling_pair(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.tumbling(inputs.topics(spark, sf), WINDOW)
    return _bounds(windows.pair_by_last(found))


def tumbling_pair_by_count(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.tumbling(inputs.topics(spark, sf), WINDOW)
    return _bounds(windows.pair_by_count(found))


def window_label(spark: SparkSession, sf: str) -> DataFrame:
    return windows.window_info(inputs.topics(spark, sf), WINDOW)


def window_members(spark: SparkSession, sf: str) -> DataFrame:
    members = windows.window_members(inputs.topics(spark, sf), WINDOW)
    return members.select("trade_id", "seq", "bounds")


def session_pair(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.sessions(inputs.topics(spark, sf), GAP_S)
    return _bounds(windows.pair_by_count(found))


def session_join(spark: SparkSession, sf: str) -> DataFrame:
    records = inputs.topics(spark, sf)
    pairs = correlate.session_join(
        records.where("msg_id IS NOT NULL"), records.where("msg_id IS NULL"), GAP_S
    )
    texts = windows.pair_or_failure(pairs)
    return _bounds(texts).withColumns(
        {c: epoch_micros(F.col(c)) for c in ("message_time", "status_time")}
    )


def state_ttl_join(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.correlate_within(inputs.topics(spark, sf), TTL_S).drop("create_time")


def entry_records(events: DataFrame) -> DataFrame:
    """Events as records whose message id is the user and status the kind."""
    return events.select(
        F.concat(F.lit("u"), "user_id").alias("msg_id"),
        F.col("event_type").alias("status_code"),
        F.col("event_id").alias("seq"),
    )


def state_history(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.state_history(entry_records(table(spark, sf, "events")))


# Functions ------------------------------------------------------------------


def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("timestamp")
    start, end = F.to_date(ordered), F.lit("2021-03-15").cast("date")
    period = timetext.period_between(start, end)
    text = timetext.format_time(ordered)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.alias("day_text"),
        timetext.format_time(timetext.parse_time(text), timetext.COMPACT_SECONDS).alias("compact"),
        timetext.days_between(
            timetext.format_time(ordered, timetext.COMPACT_DAY), F.lit("20230601")
        ).alias("days"),
        period["years"].alias("part_years"),
        period["months"].alias("part_months"),
        period["days"].alias("part_days"),
    )


def key_text(spark: SparkSession, sf: str) -> DataFrame:
    """Fields joined with '_', null as empty, and the emptiness tests."""
    records = inputs.topics(spark, sf)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
             ("trade_id", "msg_id", "status_code")]
    return records.select(
        "seq",
        F.concat_ws("_", *parts).alias("key_text"),
        jsontext.not_empty(F.col("msg_id")).alias("has_msg"),
        jsontext.is_blank(F.col("status_code")).alias("no_status"),
    )


def error_envelope(spark: SparkSession, sf: str) -> DataFrame:
    records = inputs.topics(spark, sf)
    return records.select(
        "seq",
        F.when(
            F.col("msg_id").isNull(),
            jsontext.error_envelope(jsontext.MESSAGE_INCOMPLETE, value=F.col("status_code")),
        )
        .otherwise(jsontext.success_envelope(F.col("msg_id")))
        .alias("value"),
    )


# Lines, clocks and code of one's own ----------------------------------------


def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Messages written as lines of text and read back."""
    path = work_dir(spark, "lines")
    inputs.topic_lines(inputs.topics(spark, sf)).write.text(path)
    return files.text_lines(spark, path)


def processing_time(spark: SparkSession, sf: str) -> DataFrame:
    """The batch's time on every record; its text, minute and period agree with it,
    whenever the query runs."""
    session = spark.newSession()
    sqludf.register(session)
    timed = shape.with_processing_time(table(session, sf, "orders").select("o_orderkey"))
    moment = F.col("proctime")
    return timed.select(
        "o_orderkey",
        (timetext.now_text() == timetext.format_time(moment)).alias("same_text"),
        (F.expr("curMinute('')") == F.date_format(moment, "mm")).alias("same_minute"),
        (timetext.current_minute() == F.expr("curMinute('any')")).alias("one_minute"),
        (F.expr("udfTimePeriod('')") == timetext.minute_parity(moment)).alias("same_period"),
    )


def named_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Functions without arguments that give a column's name; the name picks the value."""
    session = spark.newSession()
    sqludf.register(session, sqludf.SQL_NAME_FUNCTIONS)
    users = inputs.users(session, sf)
    by_name = F.map_from_arrays(
        F.array(F.lit("lat"), F.lit("lng")), F.array("lat", "lng")
    )
    return users.select(
        "cert_nbr",
        F.element_at(by_name, F.expr("lat()")).cast("double").alias("first"),
        F.element_at(by_name, F.expr("lng()")).cast("double").alias("second"),
    )


def observed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records passed through unchanged and counted on the way."""
    count = Observation("records")
    path = work_dir(spark, "observed")
    shape.observed(table(spark, sf, "events"), count).write.parquet(path)
    kinds = aggregate.count_by(spark.read.parquet(path), ["event_type"])
    return kinds.withColumn("observed", F.lit(count.get["records"]).cast("long"))


def row_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Code of one's own over rows: parse, drop some, give others more than once."""

    def run(frames):
        import json

        for frame in frames:
            rows = []
            for event_id, props in zip(frame["event_id"], frame["props"]):
                k = json.loads(props)["k"]
                rows += [(event_id, k, copy) for copy in range(k % 3)]
            yield pd.DataFrame(rows, columns=["event_id", "k", "copy"])

    events = table(spark, sf, "events").select("event_id", "props")
    return shape.rowwise(events, run, "event_id long, k long, copy int")


def serial_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Item records carry serials of their own, the others none."""
    numbered = coupon.with_serial(coupon_match(spark, sf))
    uuid = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return numbered.groupBy("message_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.countDistinct("serial_no").alias("serials"),
        F.count(F.when(F.col("serial_no").rlike(uuid), 1)).alias("well_formed"),
    )


BATCH: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        coupon_match,
        coupon_messages,
        coupon_match_day_night,
        coupon_match_night,
        coupon_match_grid,
        coupon_count,
        coupon_count_by_key,
        coupon_top1,
        coupon_limit_count,
        coupon_groups,
        coupon_split,
        request_enrich,
        filter_chain,
        text_contains,
        side_route,
        window_side_output,
        json_enrich,
        json_filter,
        json_flatmap,
        json_types,
        job_param,
        sql_view,
        union_topics,
        table_product,
        product_count,
        equi_join,
        where_equi_join,
        skew_join,
        lookup_join,
        partition_fixed,
        partition_latest,
        partition_all,
        temporal_join,
        table_roundtrip,
        sum_by_key,
        sum_changelog,
        tumbling_pair,
        tumbling_pair_by_count,
        window_label,
        window_members,
        session_pair,
        session_join,
        state_ttl_join,
        state_history,
        date_functions,
        key_text,
        error_envelope,
        text_lines,
        processing_time,
        named_columns,
        observed_records,
        row_functions,
        serial_numbers,
    )
}
