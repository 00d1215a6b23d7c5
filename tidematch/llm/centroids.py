"""Centroid clustering of vectors on whole numbers, by a vantage-point tree.

Every round builds a vantage-point tree over the centroids on the driver and sends
it out with the tasks. A task takes its vectors in blocks: each vector keeps its
own frontier of tree nodes by lower bound and visits the node of the smallest
bound, as long as that bound does not exceed its best distance so far; all vectors
of a block take their next step together. The pruning radius is inclusive, with
slack for rounding, so a centroid as near as the best one is always reached and the
smaller number wins. Distances at leaves and vantage points are exact integers.

New centroids come from exact component sums, pre-aggregated by task and added up
by Spark. What reaches the driver is a row for each centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import Steps
from tidematch.session import ship_package

DIMENSIONS = 64
#: A component x becomes floor(SCALE * x).
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Components are held to +-HELD, far beyond what a distance in a long allows.
HELD = 1 << 62
#: A distance or inertia beyond a long comes out as the largest long.
LONGEST = (1 << 63) - 1
#: Centroids in a leaf of the tree.
LEAF = 4
#: Vectors that take their steps together.
BLOCK = 2048
#: Whole numbers up to here are exact in double precision, sums and products too.
EXACT = 1 << 53


def kept(vectors: DataFrame, key: str, column: str, dimensions: int, scale: int) -> DataFrame:
    """(id, point): vectors of exactly ``dimensions`` finite components, as longs."""
    x = F.col(column)

    def finite(v: Column) -> Column:
        v = v.cast("double")
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    def whole(v: Column) -> Column:
        big = v.cast("double") * scale
        held = F.greatest(F.least(big, F.lit(float(HELD))), F.lit(float(-HELD)))
        return F.floor(held).cast("long")

    given = vectors.filter(x.isNotNull() & (F.size(x) == dimensions) & F.forall(x, finite))
    return given.select(F.col(key).alias("id"), F.transform(x, whole).alias("point"))


def first_centroids(points: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The points with the smallest hashes of ``seed:id``, in the hashes' order;
    equal hashes by the points themselves."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    order = points.select(F.sha2(named, 256).alias("hash"), "point")
    return [list(r["point"]) for r in order.orderBy("hash", "point").limit(clusters).collect()]


@dataclass
class Tree:
    """A vantage-point tree. Node n has the vantage point ``vantage[n]``, the leaf
    members ``members[n]`` and the children ``child[n]``; the distances from the
    vantage point to what lies below child i are within ``low[n, i]``, ``high[n, i]``."""

    points: np.ndarray
    vantage: np.ndarray
    members: list[list[int]]
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of ``a`` and those of ``b``, exactly: in
    doubles where all sums stay exact, else in Python's whole numbers."""
    if a.dtype != object and b.dtype != object:
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]
    wide_a, wide_b = a.astype(object), b.astype(object)
    return np.stack([((wide_a - row) ** 2).sum(axis=1) for row in wide_b], axis=1)


def as_numbers(rows: np.ndarray, largest: int) -> np.ndarray:
    """Rows as exact doubles if no distance between components of that size can
    leave the exact range, else as Python's whole numbers."""
    if rows.shape[1] * (2 * largest) ** 2 < EXACT:
        return rows.astype(np.float64)
    return np.array([[int(v) for v in row] for row in rows], dtype=object).reshape(rows.shape)


def build(points: np.ndarray) -> Tree:
    """A tree over the rows of ``points``. The vantage point of a node is its member
    farthest from the first one; members nearer than the median go inside."""
    vantage, members, child, low, high = [], [], [], [], []

    def node(own: list[int]) -> int:
        n = len(vantage)
        far = squared(points[own], points[own[:1]])[:, 0]
        top = own[int(np.argmax(far.astype(np.float64)))]
        vantage.append(top)
        members.append([])
        for kept_ in (child, low, high):
            kept_.append([-1, -1])
        rest = [k for k in own if k != top]
        if len(rest) <= LEAF:
            members[n] = rest
            return n
        away = np.sqrt(squared(points[rest], points[[top]])[:, 0].astype(np.float64))
        order = np.argsort(away, kind="stable")
        half = len(rest) // 2
        for i, part in enumerate((order[:half], order[half:])):
            low[n][i], high[n][i] = away[part].min(), away[part].max()
            child[n][i] = node([rest[k] for k in part])
        return n

    node(list(range(len(points))))
    return Tree(
        points, np.array(vantage), members, np.array(child),
        np.array(low, np.float64), np.array(high, np.float64),
    )


class Nearest:
    """Finds the nearest centroid of vectors by best-first branch and bound."""

    def __init__(self, centroids: list[list[int]]):
        rows = np.array(centroids, np.int64)
        self.rows, self.largest = rows, int(np.abs(rows).max(initial=0))
        self._trees: dict[bool, Tree] = {}

    def _tree(self, wide: bool) -> Tree:
        if wide not in self._trees:
            size = HELD if wide else self.largest
            self._trees[wide] = build(as_numbers(self.rows, size))
        return self._trees[wide]

    def of(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row."""
        largest = max(self.largest, int(np.abs(block).max(initial=0)))
        vectors = as_numbers(block, largest)
        tree = self._tree(vectors.dtype == object)
        count, nodes = len(vectors), len(tree.vantage)
        bound = np.full((count, nodes), np.inf)
        bound[:, 0] = 0
        best = np.full(count, -1)
        least = np.full(count, np.inf) if vectors.dtype != object else np.array([None] * count)
        radius = np.full(count, np.inf)
        going = np.arange(count)
        while len(going):
            at = bound[going].argmin(axis=1)
            open_ = bound[going, at] <= radius[going]
            going, at = going[open_], at[open_]
            for n in np.unique(at):
                rows = going[at == n]
                bound[rows, n] = np.inf
                top, some = tree.vantage[n], tree.members[n]
                exact = squared(vectors[rows], tree.points[[top, *some]])
                for number, away in zip([top, *some], exact.T):
                    self._better(rows, number, away, best, least, radius)
                if tree.child[n][0] < 0:
                    continue
                away = np.sqrt(exact[:, 0].astype(np.float64))
                for i, below in enumerate(tree.child[n]):
                    slack = 1e-9 * (away + tree.high[n, i] + 1)
                    gap = np.maximum(away - tree.high[n, i], tree.low[n, i] - away) - slack
                    bound[rows, below] = np.maximum(gap, 0)
            going = going[bound[going].min(axis=1) <= radius[going]]
        return best, least

    @staticmethod
    def _better(rows, number, away, best, least, radius) -> None:
        """Where ``away`` is less than the best, or as much with a smaller number."""
        known, held = best[rows], least[rows]
        unset = known < 0
        if away.dtype == object:
            held = np.where(unset, away, held)
        nearer = unset | (away < held) | ((away == held) & (number < known))
        won = rows[nearer.astype(bool)]
        best[won] = number
        least[won] = away[nearer.astype(bool)]
        radius[won] = np.sqrt(least[won].astype(np.float64)) * (1 + 1e-12)


def _blocks(batch: pa.RecordBatch, place: int, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, vectors) of parts of a batch."""
    column = batch.column(place)
    for start in range(0, batch.num_rows, BLOCK):
        part = column.slice(start, BLOCK)
        yield start, part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def sums(points: DataFrame, centroids: list[list[int]], dimensions: int) -> dict:
    """number -> (count, component sums) of the vectors nearest to each centroid."""
    send = points.sparkSession.sparkContext.broadcast(centroids)
    schema = "cluster int, place int, n long, total decimal(38,0)"
    arrow = pa.schema(
        [("cluster", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38))]
    )

    def run(batches):
        nearest = Nearest(send.value)
        count = [0] * len(send.value)
        total = [[0] * dimensions for _ in send.value]
        for batch in batches:
            for _, block in _blocks(batch, 0, dimensions):
                best, _ = nearest.of(block)
                small = int(np.abs(block).max(initial=0)) < HELD // BLOCK
                rows = block if small else block.astype(object)
                for number in np.unique(best):
                    own = rows[best == number]
                    count[number] += len(own)
                    added = own.sum(axis=0)
                    total[number] = [a + int(b) for a, b in zip(total[number], added)]
        found = [
            (k, place, count[k], Decimal(value))
            for k in range(len(count))
            if count[k]
            for place, value in enumerate(total[k])
        ]
        columns = list(zip(*found)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    ship_package(points.sparkSession)
    partial = points.select("point").mapInArrow(run, schema)
    whole = partial.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out: dict = {}
    for row in whole.collect():
        n, values = out.setdefault(row["cluster"], (row["n"], [0] * dimensions))
        values[row["place"]] = int(row["total"])
    return out


def moved(centroids: list[list[int]], found: dict) -> list[list[int]]:
    """Floored means; a centroid without vectors stays."""
    return [
        [value // found[k][0] for value in found[k][1]] if k in found else old
        for k, old in enumerate(centroids)
    ]


def assigned(points: DataFrame, centroids: list[list[int]], dimensions: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    send = points.sparkSession.sparkContext.broadcast(centroids)
    kind = dict(points.dtypes)["id"]

    def run(batches):
        nearest = Nearest(send.value)
        for batch in batches:
            for start, block in _blocks(batch, 1, dimensions):
                best, least = nearest.of(block)
                away = [min(int(v), LONGEST) for v in least]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(block)),
                        pa.array(best.tolist(), pa.int32()),
                        pa.array(away, pa.int64()),
                    ],
                    names=["id", "cluster", "distance"],
                )

    ship_package(points.sparkSession)
    return points.select("id", "point").mapInArrow(run, f"id {kind}, cluster int, distance long")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    vector of the right form.

    A null vector, and one with another number of components or with a null or
    non-finite one, takes no part. With fewer vectors than ``clusters`` each starts
    a cluster; equal vectors may start several, of which the smallest number gets
    all of them and the others stay empty. Repeated rows and null keys count each
    for itself, a null key hashing as an empty one. Components are held to 2^62;
    distances are exact, and one beyond a long comes out as the largest long. An
    empty table gives no rows. Other columns are not read. The vectors are stored
    as whole numbers once and read again every round.
    """
    steps = Steps(vectors.sparkSession, "centroids")
    points = steps.put(kept(vectors, key, column, dimensions, scale), "points")
    centroids = first_centroids(points, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(centroids, sums(points, centroids, dimensions))
    if not centroids:
        rows = points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        rows = steps.put(assigned(points, centroids, dimensions), "assigned")
        steps.drop("points")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")
    inertia = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(exact).collect()}
    whole = min(sum(inertia.values()), LONGEST)
    # One row for each centroid.
    facts = points.sparkSession.createDataFrame(
        [(k, min(d, LONGEST), digest(centroids[k])) for k, d in sorted(inertia.items())],
        "cluster int, cluster_inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(whole).cast("long").alias("inertia"),
        "centroid_sha256",
    )


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same in SQL, with every round written out and all centroids tried."""
    away = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, p) - 1 AS n, p FROM (
    SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, p FROM v ORDER BY h, p LIMIT {clusters})
)"""
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(p) AS p, min((d, n)) AS best FROM (
    SELECT v.r, v.vec_id, v.p, c.n, {away} AS d FROM v CROSS JOIN c{k} c) GROUP BY r
)"""
        )
        if k < rounds:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(m.p, c.p) AS p FROM c{k} c LEFT JOIN (
    SELECT n, list(CAST((s - ((s % cnt) + cnt) % cnt) // cnt AS BIGINT) ORDER BY i) AS p FROM (
      SELECT n, i, sum(x) AS s, count(*) AS cnt FROM (
        SELECT best[2] AS n, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM a{k}) GROUP BY n, i)
    GROUP BY n) m ON c.n = m.n
)"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT a.vec_id, CAST(a.best[2] AS INTEGER) AS cluster, CAST(a.best[1] AS BIGINT) AS distance,
  CAST(sum(a.best[1]) OVER (PARTITION BY a.best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best[2] = c.n
"""
    )


SQL = sql()
