"""The coupon job: match requests with users in range and frame the result.

A request with n > 0 matches gives a start record '01', one record '02' per user
and an end record '03', each carrying n. A request without a match gives a
single '01' with "0".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidematch.functions.jsontext import not_empty, to_text
from tidematch.operators import geojoin
from tidematch.operators.sizes import cut_lineage, kept
from tidematch.schemas import (
    COUPON_REQUEST_FIELDS,
    COUPON_REQUEST_JSON,
    COUPON_RESULT_FIELDS,
    REQUEST_KEYS,
)
from tidematch.sources.kafka import decode

START, ITEM, END = "01", "02", "03"


def parse_requests(lines: DataFrame) -> DataFrame:
    """Request messages in column ``value`` to columns."""
    return decode(lines, COUPON_REQUEST_JSON, COUPON_REQUEST_FIELDS)


def once_per_request(
    requests: DataFrame, resent_within: str = "1 day", received: str = "received"
) -> DataFrame:
    """A stream of requests without those whose id came before, in any
    micro-batch, as long as it came within the time given; so the memory of ids
    is bounded. Requests without an id all pass."""
    timed = requests.withColumn(received, F.current_timestamp()).withWatermark(
        received, resent_within
    )
    # Without an id each request counts as its own.
    own = timed.withColumn("_id", F.coalesce("unique_req_id", F.expr("uuid()")))
    return own.dropDuplicatesWithinWatermark(["_id"]).drop("_id", received)


def distinct_requests(requests: DataFrame) -> DataFrame:
    """One row per request; a message sent twice counts once."""
    others = [c for c in requests.columns if c not in REQUEST_KEYS]
    first = F.min(F.struct(*others)).alias("first")
    return requests.groupBy(*REQUEST_KEYS).agg(first).select(*REQUEST_KEYS, "first.*")


def _known(users: DataFrame) -> DataFrame:
    return users.where(not_empty(F.col("cert_type")) & not_empty(F.col("cert_nbr")))


def _request_matches(
    requests: DataFrame,
    users: DataFrame,
    equal: dict[str, str] | None,
    limit: int | None,
    small_requests: bool | None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Column ``request``, the keys as one value, with each matched user; ``keep`` are
    further columns of the requests."""
    keyed = requests.withColumn("request", F.struct(*REQUEST_KEYS))
    matches = geojoin.match_requests(keyed, _known(users), equal, small_requests)
    if limit is not None:
        matches = matches.limit(limit)
    return matches.select(
        "request",
        F.col("cert_type").alias("id_type"),
        F.col("cert_nbr").alias("id_number"),
        *keep,
    )


def _counted_requests(
    requests: DataFrame, users: DataFrame, equal: dict[str, str] | None, small_requests: bool
) -> DataFrame:
    """The requests, stored, with the number ``n`` of their matches."""
    stored = cut_lineage(requests.withColumn("_number", F.monotonically_increasing_id()))
    counts = geojoin.count_matches(stored, _known(users), "_number", equal, small_requests)
    counted = stored.join(counts, "_number", "left").drop("_number")
    return cut_lineage(counted.withColumn("n", F.coalesce("n", F.lit(0))))


def matched_users(
    requests: DataFrame,
    users: DataFrame,
    equal: dict[str, str] | None = None,
    limit: int | None = None,
    small_requests: bool | None = None,
) -> DataFrame:
    """Request keys with ``id_type`` and ``id_number`` of each matched user; users
    without either are left out. ``limit`` is one for all requests together."""
    matches = _request_matches(requests, users, equal, limit, small_requests)
    return matches.select("request.*", "id_type", "id_number")


def matched_requests(
    requests: DataFrame, users: DataFrame, equal: dict[str, str] | None = None
) -> DataFrame:
    """The requests with a match, each with the number ``n`` of its rows in
    ``matched_users``, which are not made."""
    small_requests = geojoin.few_requests(requests)
    return _counted_requests(requests, users, equal, small_requests).where("n > 0")


def _envelope(counted: DataFrame, matches: DataFrame) -> DataFrame:
    """Start, item and end records of every request. ``counted`` holds each request
    once, with ``n``, which the matches carry as well."""
    frames = counted.select(
        F.explode(
            F.when(F.col("n") > 0, F.array(F.lit(START), F.lit(END))).otherwise(
                F.array(F.lit(START))
            )
        ).alias("message_type"),
        F.col("n").cast("string").alias("coupon_send_num"),
        "unique_req_id",
    )
    items = matches.select(
        "request.coupon_id",
        F.lit(ITEM).alias("message_type"),
        F.col("n").cast("string").alias("coupon_send_num"),
        "id_type",
        "id_number",
        "request.store_id",
        "request.store_range",
        "request.unique_req_id",
    )
    return items.unionByName(frames, allowMissingColumns=True)


def coupon_match(
    requests: DataFrame,
    users: DataFrame,
    equal: dict[str, str] | None = None,
    limit: int | None = None,
    small_requests: bool | None = None,
    keep_matches: bool | None = None,
) -> DataFrame:
    """The whole job. Matches are counted per request first; the requests then carry
    their counts through the join, so the matches, of which there can be as many as
    requests times users, are neither stored nor moved. ``keep_matches`` stores them
    in the checkpoint folder instead and reads the users once; by default that is done
    when a limit must pick the same matches for counting and listing."""
    once = distinct_requests(requests)
    if small_requests is None:
        small_requests = geojoin.few_requests(requests)
    if keep_matches is None:
        keep_matches = limit is not None
    if not keep_matches and limit is None:
        counted = _counted_requests(once, users, equal, small_requests)
        found = counted.where("n > 0")
        return _envelope(
            counted, _request_matches(found, users, equal, None, small_requests, ("n",))
        )
    matches = cut_lineage(_request_matches(once, users, equal, limit, small_requests))
    # Keys are compared as one struct, in which null equals null.
    counts = matches.groupBy("request").agg(F.count(F.lit(1)).alias("n"))
    keyed = once.withColumn("request", F.struct(*REQUEST_KEYS))
    counted = keyed.join(counts, "request", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if small_requests:
        counts = F.broadcast(counts)
    return _envelope(counted, matches.join(counts, "request"))


def with_serial(records: DataFrame) -> DataFrame:
    """Give each item record a random serial number."""
    is_item = F.col("message_type") == ITEM
    return records.withColumn("serial_no", F.when(is_item, F.expr("uuid()")))


def to_messages(records: DataFrame) -> DataFrame:
    """Result records as JSON text in column ``value``."""
    fields = [F.col(name).alias(field) for field, name in COUPON_RESULT_FIELDS.items()]
    return records.select(to_text(F.struct(*fields)).alias("value"))


def coupon_batch(
    latest_users: Callable[[SparkSession], DataFrame],
    write: Callable[[DataFrame, int], None],
    equal: dict[str, str] | None = None,
    near: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream of parsed requests: users are
    resolved anew for each micro-batch, so it sees the partition that is the
    latest at its time. ``near(users, requests)`` leaves out users that no request of
    the micro-batch can reach, such as ``layout.near`` for users stored by place."""

    def run(batch: DataFrame, batch_id: int) -> None:
        with kept(batch, "requests") as requests:
            users = latest_users(batch.sparkSession)
            if near is not None:
                users = near(users, requests)
            write(coupon_match(requests, users, equal), batch_id)

    return run
