"""Requests matched with the users inside their range."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.functions import geo
from tidematch.operators.in_range import count_block
from tidematch.operators.joins import CHUNKS, salted_join
from tidematch.operators.sizes import BROADCAST_BYTES, BROADCAST_ROWS, cut_lineage, fits_broadcast
from tidematch.session import ship_package

# A reach spans at most three cells on each of three axes.
CELLS_PER_REQUEST = 27
# Users are repeated for each level in use. Where they are shuffled, every second
# level is left out: fewer copies to move for more candidates to test.
SHUFFLED_LEVEL_STEP = 2
# A cell of more pairs is counted in blocks of at most so many rows of each side.
# Where all requests and users make no more than ``LIST_ALL``, cells are not looked at.
LIST_PAIRS, LIST_ALL = 1_000_000, 100_000_000
BLOCK_REQUESTS, BLOCK_USERS = 100_000, 200_000


def _columns(prefix: str) -> dict[str, Column]:
    return {axis: F.col(f"{prefix}{axis}") for axis in geo.AXES}


def request_cells(requests: DataFrame, step: int = 1) -> DataFrame:
    """One row per request and cell its range can touch, as ``_cell``,
    with the cell's region as ``_gate``. Requests that can match nobody have no row."""
    placed = requests.select(
        "*",
        geo.as_double(F.col("store_latitude")).alias("_store_lat"),
        geo.as_double(F.col("store_longitude")).alias("_store_lng"),
        geo.range_chord(F.col("store_range")).alias("_chord"),
        geo.range_chord(F.col("store_range"), -1).alias("_inner"),
    ).dropna(subset=["_store_lat", "_store_lng", "_chord"])
    vector = geo.unit_vector(F.col("_store_lat"), F.col("_store_lng"))
    level = geo.cell_level(F.col("_chord"), step)
    cells = placed.select(
        "*",
        level.alias("_level"),
        geo.level_scale(level).alias("_scale"),
        *[vector[axis].alias(f"_s{axis}") for axis in geo.AXES],
    )
    store, chord, scale = _columns("_s"), F.col("_chord"), F.col("_scale")
    for axis in geo.AXES:
        span = F.sequence(
            geo.axis_index(store[axis] - chord, scale),
            geo.axis_index(store[axis] + chord, scale),
        )
        cells = cells.select("*", F.explode(span).alias(f"_i{axis}"))
    index = _columns("_i")
    return (
        cells.where(geo.touches_sphere(scale, index))
        .withColumns(
            {
                "_cell": geo.cell_id(F.col("_level"), index),
                "_gate": geo.gate_id(F.col("_level"), index),
            }
        )
        .drop("_level", "_scale", *[f"_i{axis}" for axis in geo.AXES])
    )


def few_requests(requests: DataFrame) -> bool:
    """Whether the requests, repeated for every cell they touch, fit a broadcast."""
    return fits_broadcast(
        requests, BROADCAST_ROWS // CELLS_PER_REQUEST, BROADCAST_BYTES // CELLS_PER_REQUEST
    )


def request_levels(requests: DataFrame, step: int = 1) -> Column:
    """The cell levels in use and their scales, as a scalar subquery of at most 20
    values."""
    chord = geo.range_chord(F.col("store_range"))
    level = F.col("_user_level")
    return (
        requests.select(chord.alias("c"))
        .where("c IS NOT NULL")
        .select(geo.cell_level(F.col("c"), step).alias("_user_level"))
        .agg(F.collect_set(F.struct(level, geo.level_scale(level).alias("_user_scale"))))
        .scalar()
    )


def user_cells(users: DataFrame, levels: Column) -> DataFrame:
    """One row per user and level in use, with the user's cell at that level; the
    cell is null, and meets no request, where the position is."""
    located = users.select(
        "*",
        geo.as_double(F.col("lat")).alias("_lat"),
        geo.as_double(F.col("lng")).alias("_lng"),
    )
    vector = geo.unit_vector(F.col("_lat"), F.col("_lng"))
    by_level = located.select(
        "*", *[vector[axis].alias(f"_u{axis}") for axis in geo.AXES], F.inline(levels)
    )
    point, scale = _columns("_u"), F.col("_user_scale")
    index = {axis: geo.axis_index(point[axis], scale) for axis in geo.AXES}
    return by_level.withColumns(
        {
            "_cell": geo.cell_id(F.col("_user_level"), index),
            "_gate": geo.gate_id(F.col("_user_level"), index),
        }
    ).drop("_user_level", "_user_scale")


def two_faces(users: DataFrame) -> DataFrame:
    """Day and night positions as rows of their own, marked by ``period``."""
    others = [c for c in users.columns if c not in ("lat", "lng", "lat_night", "lng_night")]
    faces = F.array(
        F.struct(F.lit("0").alias("period"), F.col("lat"), F.col("lng")),
        F.struct(
            F.lit("1").alias("period"),
            F.col("lat_night").alias("lat"),
            F.col("lng_night").alias("lng"),
        ),
    )
    return users.select(*others, F.inline(faces))


def one_face(users: DataFrame, period) -> DataFrame:
    """Day or night positions for the whole batch; any period but '0' is night."""
    return users.withColumn(
        "lat", geo.face_coordinate(period, F.col("lat"), F.col("lat_night"))
    ).withColumn("lng", geo.face_coordinate(period, F.col("lng"), F.col("lng_night")))


def match_requests(
    requests: DataFrame,
    users: DataFrame,
    equal: Mapping[str, str] | None = None,
    small_requests: bool | None = None,
) -> DataFrame:
    """Pairs of request and user whose distance is below the request's range.

    ``users`` has text columns ``lat`` and ``lng``; ``equal`` adds equalities,
    request column to user column. Both sides are keyed by cells sized by the
    range and joined on the cell. Straight-line tests settle all but the
    candidates within a metre of the range; the exact distance decides those.
    While the requests' cells fit a checked bound they are broadcast and the users are
    scanned once without a shuffle; beyond it users outside all requested
    regions are dropped first and both sides are shuffled by cell with hot cells
    split. ``small_requests`` overrides the check.
    """
    if small_requests is None:
        small_requests = few_requests(requests)
    step = 1 if small_requests else SHUFFLED_LEVEL_STEP
    stores, located, keys = _by_cell(requests, users, equal, step)
    if small_requests:
        candidates = located.drop("_gate").join(F.broadcast(stores.drop("_gate")), keys)
    else:
        candidates = salted_join(stores.drop("_gate"), _near(stores, located), keys)
    matches = _within(candidates)
    kept = [*requests.columns, *[c for c in users.columns if c not in requests.columns]]
    return matches.select(*kept, "distance_m")


def _by_cell(
    requests: DataFrame, users: DataFrame, equal: Mapping[str, str] | None, step: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Requests and users by cell, and the columns on which they meet."""
    equal = dict(equal or {})
    stores = request_cells(requests, step)
    located = user_cells(users, request_levels(requests, step))
    for request_column, user_column in equal.items():
        located = located.withColumn(f"_eq_{request_column}", F.col(user_column))
        stores = stores.withColumn(f"_eq_{request_column}", F.col(request_column))
    keys = ["_cell", *[f"_eq_{c}" for c in equal]]
    return stores, located.drop(*requests.columns), keys


def _near(stores: DataFrame, located: DataFrame) -> DataFrame:
    """Users of regions with a request; others never reach a shuffle."""
    gates = F.broadcast(stores.select("_gate").distinct())
    return located.join(gates, "_gate", "left_semi").drop("_gate")


def _within(candidates: DataFrame) -> DataFrame:
    """Candidates in range, with their distance."""
    distance = geo.haversine_m(*[F.col(c) for c in ("_store_lat", "_store_lng", "_lat", "_lng")])
    apart = geo.squared_distance(_columns("_s"), _columns("_u"))
    outer = F.col("_chord") * F.col("_chord")
    inner = F.when(F.col("_inner") > 0, F.col("_inner") * F.col("_inner")).otherwise(-1.0)
    exact = geo.within_range(F.col("distance_m"), F.col("store_range"))
    return candidates.withColumn("distance_m", distance).where(
        (apart <= inner) | ((apart <= outer) & exact)
    )


def count_matches(
    requests: DataFrame,
    users: DataFrame,
    by: str,
    equal: Mapping[str, str] | None = None,
    small_requests: bool | None = None,
) -> DataFrame:
    """Number ``n`` of pairs that ``match_requests`` gives, for each value of the request
    column ``by`` that has some.

    Where a cell's requests and users make few pairs these are tested one by one. Those
    of other cells are dealt to blocks of bounded size, in which most users are counted by
    their place in an order (``in_range.count_block``); only users within a metre
    of the range come out of it and are tested by the exact distance. No pair is moved
    or stored.
    """
    if requests.count() * users.count() <= LIST_ALL:
        return _count_listed(requests, users, by, equal, small_requests)
    stores, located, keys = _by_cell(requests, users, equal, SHUFFLED_LEVEL_STEP)
    near = _near(stores, located)
    stores = stores.drop("_gate").dropna(subset=keys)
    near = near.dropna(subset=keys)
    sizes = stores.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l")).join(
        near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys
    )
    # The cells above the bound are few beside the rows, by far less than a hundredth.
    dense = sizes.where(F.col("_l") * F.col("_r") > LIST_PAIRS).select(
        *keys,
        F.ceil(F.col("_l") / BLOCK_REQUESTS).alias("_lefts"),
        F.ceil(F.col("_r") / BLOCK_USERS).alias("_rights"),
    )
    dense = cut_lineage(dense)
    blocks = dense.agg(F.sum(F.col("_lefts") * F.col("_rights"))).first()[0] or 0
    if not blocks:
        return _count_listed(requests, users, by, equal, small_requests)
    hot = F.broadcast(dense)
    sparse = salted_join(
        stores.join(hot, keys, "left_anti"), near.join(hot, keys, "left_anti"), keys
    )
    listed = _within(sparse).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    counted = _count_in_blocks(stores.join(hot, keys), near.join(hot, keys), keys, by, int(blocks))
    sure = counted.where("_lat IS NULL").select(by, "n")
    edge = counted.where("_lat IS NOT NULL").withColumn(
        "distance_m",
        geo.haversine_m(*[F.col(c) for c in ("_store_lat", "_store_lng", "_lat", "_lng")]),
    )
    edge = edge.where(geo.within_range(F.col("distance_m"), F.col("store_range"))).select(by, "n")
    return listed.union(sure).union(edge).groupBy(by).agg(F.sum("n").alias("n"))


def _count_listed(
    requests: DataFrame,
    users: DataFrame,
    by: str,
    equal: Mapping[str, str] | None,
    small_requests: bool | None,
) -> DataFrame:
    pairs = match_requests(requests, users, equal, small_requests)
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def _count_in_blocks(
    stores: DataFrame, near: DataFrame, keys: list[str], by: str, blocks: int
) -> DataFrame:
    """Rows (by, n) with the users of a block that are surely in range of a request, and
    rows with both positions and ``n`` 1 for users that may be."""
    corner = ["_store_lat", "_store_lng", "store_range"]
    # Infinite positions give vectors that are no numbers; nothing is in their range.
    stores = stores.where(~F.isnan(F.col("_sx") + F.col("_sy") + F.col("_sz")))
    near = near.where(~F.isnan(F.col("_ux") + F.col("_uy") + F.col("_uz")))
    lefts = stores.select(*keys, by, *corner, "_chord", "_inner", "_sx", "_sy", "_sz", "_lefts", "_rights")
    rights = near.select(*keys, "_lat", "_lng", "_ux", "_uy", "_uz", "_lefts", "_rights")
    parts = int(stores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, min(blocks, 2 * CHUNKS))
    grid = [*keys, "_left", "_right"]
    lefts = _dealt(lefts, "_left", "_lefts", "_right", "_rights").repartition(parts, *grid)
    rights = _dealt(rights, "_right", "_rights", "_left", "_lefts").repartition(parts, *grid)
    kinds = dict(stores.dtypes)
    schema = ", ".join(
        [f"`{by}` {kinds[by]}", "n long", *[f"{c} {kinds[c]}" for c in corner], "_lat double", "_lng double"]
    )
    ship_package(stores.sparkSession)
    both = lefts.groupBy(*grid).cogroup(rights.groupBy(*grid))
    return both.applyInArrow(lambda one, other: count_block(one, other, by), schema)


def _dealt(df: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
    """Rows dealt in turn to ``count`` parts, and repeated for each of the other side's. The
    order is that of their content, so a recomputed task deals them alike."""
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    turned = df.withColumn("_content", content).sortWithinPartitions("_content")
    turned = turned.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.col(count)))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))
    return turned.withColumn(other, each).drop("_content", "_lefts", "_rights")
