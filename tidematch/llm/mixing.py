"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. Every document of it is taken as often as the
target holds the whole source. For the words that are left each document has an
inclusion probability in proportion to the whole part of its size's square root; where
that would exceed 1 the document is certain, and the others share what is left by the
same rule. Documents are ranked by the odds of a random number divided by the odds of
their probability, certain ones first. The lowest ranks are taken up to the words
wanted, so the sample has a fixed size.

Where the ranking stops is found from counts: the ranks are dealt into buckets,
the bucket that holds the limit into smaller ones, and only the documents of one
such small bucket are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidematch.llm.common import GAP, Steps

#: Words to take, as a share of all there are.
SHARE = 1.5
#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: A source gives at most so many times its own words.
CAP = 2.0
#: No probability is below this.
LEAST_CHANCE = 1e-9
#: Buckets of ranks in each of two steps.
BUCKETS = 4096


def size_of(text: Column) -> Column:
    """Words of a text, 0 for null."""
    given = F.coalesce(text, F.lit(""))
    parts = F.size(F.split(given, GAP))
    # A gap at either end leaves an empty part there.
    inner = parts - given.rlike(f"^{GAP}").cast("int") - given.rlike(f"{GAP}$").cast("int")
    return (
        F.when(given.rlike(r"[^\x20\x09-\x0D]"), inner).otherwise(F.lit(0)).cast("long")
    )


def draw_of(key: Column, text: Column) -> Column:
    """A number in (0, 1) that depends on the row alone: reruns agree."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), text).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / 16.0**12


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(key, source, size, draw) of every row."""
    return docs.select(
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        draw_of(F.col(key), F.col(text)).alias("draw"),
    )


def targets(
    sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, cap: float = CAP
) -> DataFrame:
    """(source, source_size, target) with one row per source.

    The words to take are shared by weight; what a source cannot give goes to
    the others by weight. With sources in order of cap over weight, the level is
    the largest that the uncapped rest reaches at any place. A source without
    words has target 0. The sources are summed before they meet in one task.
    """
    ordered = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    choice = F.array(*[F.lit(float(w)) for w in weights])
    weighted = ordered.withColumn(
        "weight", F.get(choice, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    ).withColumn("most", cap * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    passed = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        share * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("most").over(passed), F.lit(0.0))
    ) / F.sum("weight").over(left)
    return (
        weighted.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            F.least("most", F.col("level") * F.col("weight")).alias("target"),
        )
    )


def measure(size: Column) -> Column:
    """What a document's inclusion probability is in proportion to, a whole number, so
    that sums of it are exact."""
    return F.greatest(F.floor(F.sqrt(size)), F.lit(1)).cast("long")


def chances(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with ``scale``: a document's probability is ``scale * measure``, 1 where
    that is more, and the probabilities times the sizes add up to the words left.

    With documents in order of size the certain ones are the largest. Sizes are counted
    first, so a source is as many rows as it has different sizes.
    """
    counted = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    met = counted.alias("c").join(plan.alias("p"), F.expr("c.source <=> p.source")).select(
        "c.*", "p.rest", measure(F.col("size")).alias("m")
    )
    own = Window.partitionBy("source").orderBy("size")
    larger = F.sum(F.col("n") * F.col("size")).over(own.rowsBetween(1, Window.unboundedFollowing))
    mass = F.sum(F.col("n") * F.col("size") * F.col("m")).over(
        own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    left = F.col("rest") - F.coalesce(larger, F.lit(0))
    met = met.withColumns({"left": left, "mass": mass})
    fits = met.filter((F.col("mass") > 0) & (F.col("left") * F.col("m") <= F.col("mass")))
    scales = fits.groupBy("source").agg(F.max_by(F.col("left") / F.col("mass"), "size").alias("scale"))
    joined = plan.alias("p").join(scales.alias("s"), F.expr("p.source <=> s.source"), "left")
    return joined.select("p.*", "s.scale")


def chance_of(size: Column, scale: Column) -> Column:
    return F.greatest(F.least(scale * measure(size), F.lit(1.0)), F.lit(LEAST_CHANCE))


def with_ranks(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan and their own rank, from 0 to below 1.

    The rank grows with odds(draw) / odds(inclusion) and is 0 for a certain document;
    where nothing is left to sample it is the draw.
    """
    met = (
        rows.alias("r")
        .join(plan.alias("p"), F.expr("r.source <=> p.source"))
        .drop(F.col("p.source"))
    )
    chance = chance_of(F.col("size"), F.col("scale"))
    odds = (F.col("draw") / (1 - F.col("draw"))) * ((1 - chance) / chance)
    rank = F.when((F.col("rest") > 0) & (F.col("source_size") > 0), odds / (1 + odds))
    return met.withColumn("rank", F.coalesce(rank, F.col("draw")))


def copies_plan(totals: DataFrame) -> DataFrame:
    """Whole copies of each source, and the words left to sample."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return totals.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("int")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )


def _bucket(step: int) -> Column:
    scaled = F.col("rank") * float(BUCKETS**step)
    return F.pmod(F.floor(scaled), F.lit(BUCKETS)).cast("int")


def limits(sizes: DataFrame, plan: DataFrame, steps: Steps) -> DataFrame:
    """The plan with ``last``, the highest (rank, key, size) taken of the bucket
    where a source's sample ends, and ``floor``, below which all are taken.

    A document is in when at least half of it lies below the words wanted, in
    order of rank.
    """
    ranked = with_ranks(sizes, plan)
    bound = plan.select("source", F.lit(0).cast("double").alias("base"), "rest")
    cell = ranked.select("source", "key", "size", "rank")
    for step in (1, 2):
        sums = cell.groupBy("source", _bucket(step).alias("bucket")).agg(F.sum("size").alias("n"))
        met = (
            sums.alias("s")
            .join(bound.select("source", "base", "rest").alias("b"), F.expr("s.source <=> b.source"))
            .drop(F.col("b.source"))
        )
        in_order = Window.partitionBy("source").orderBy("bucket")
        before = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
        met = met.withColumn("base", F.col("base") + F.coalesce(before, F.lit(0)))
        bound = steps.put(
            met.filter("base <= rest AND rest < base + n").select("source", "bucket", "base", "rest"),
            f"step{step}",
        )
        cell = (
            cell.withColumn("bucket", _bucket(step))
            .alias("c")
            .join(
                bound.alias("b"),
                F.expr("c.source <=> b.source AND c.bucket = b.bucket"),
                "left_semi",
            )
            .select("source", "key", "size", "rank")
        )
    # The bucket's rows in order, on top of all words in buckets before it.
    order = Window.partitionBy("source").orderBy("rank", F.col("key").asc_nulls_first(), "size")
    met = (
        cell.alias("c")
        .join(bound.alias("b"), F.expr("c.source <=> b.source"))
        .drop(F.col("b.source"))
    )
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = met.withColumn("reach", F.col("base") + running - F.col("size") / 2)
    last = inside.filter(F.col("reach") <= F.col("rest")).groupBy("source").agg(
        F.max(F.struct("rank", "key", "size")).alias("last")
    )
    # Everything below the cell is in.
    first = cell.groupBy("source").agg(F.min("rank").alias("floor"))
    joined = (
        plan.alias("p")
        .join(last.alias("l"), F.expr("p.source <=> l.source"), "left")
        .join(first.alias("f"), F.expr("p.source <=> f.source"), "left")
    )
    return joined.select("p.*", "l.last", "f.floor")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
    weights: tuple = WEIGHTS,
    cap: float = CAP,
) -> DataFrame:
    """(key, source, size, source_size, target, copies) for every row of ``docs``.

    ``copies`` is how often the mix takes the document. Sources come in order of
    their names, null last and as a source of its own. A document without words
    counts as size 0 and may be taken or not. Rows alike in key and text share
    one rank, so they are all in or all out; an empty table gives no rows. Only
    the three named columns are read.
    """
    steps = Steps(docs.sparkSession, "mix")
    sizes = steps.put(sized(docs, key, text, source), "sizes")
    return apply(sizes, plan_for(sizes, steps, share, weights, cap)).withColumnRenamed("key", key)


def plan_for(sizes: DataFrame, steps: Steps, share=SHARE, weights=WEIGHTS, cap=CAP) -> DataFrame:
    """One row per source: sizes, target, whole copies and where sampling stops."""
    plan = steps.put(copies_plan(targets(sizes, share, weights, cap)), "copies")
    plan = steps.put(chances(sizes, plan), "chances")
    plan = steps.put(limits(sizes, plan, steps), "limits")
    steps.drop("copies", "chances", "step1", "step2")
    return plan


def apply(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Copies of every sized row; its other columns stay."""
    ranked = with_ranks(sizes, plan)
    own = F.struct("rank", "key", "size")
    extra = (F.col("rest") > 0) & (
        (F.col("rank") < F.col("floor")) | F.coalesce(own <= F.col("last"), F.lit(False))
    )
    copies = F.col("whole") + F.coalesce(extra, F.lit(False)).cast("int")
    return ranked.withColumn("copies", copies).drop("rank", "draw", "whole", "rest", "scale", "last", "floor")


def repeated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it, with its columns."""
    steps = Steps(docs.sparkSession, "mix")
    plan = plan_for(steps.put(sized(docs, key, text, source), "sizes"), steps)
    steps.drop("sizes")
    whole = docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        draw_of(F.col(key), F.col(text)).alias("draw"),
    )
    taken = apply(whole, plan).filter("copies > 0")
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return taken.select("row", each.alias("copy")).select("row.*")


SQL = f"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, text)), 1, 12))::BIGINT::DOUBLE + 0.5)
      / pow(16, 12) AS draw
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{", ".join(f"{w}.0" for w in WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, ({SHARE} * sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER (
      ORDER BY {CAP} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY {CAP} * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), p AS (
  SELECT source, source_size, least({CAP} * source_size, max(level) OVER () * weight)::DOUBLE AS target FROM l
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM p
), r AS (
  SELECT d.doc_id, d.size, d.draw, c.*, target - whole * source_size AS rest
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
), h AS (
  SELECT r.source, size, count(*) AS n, any_value(rest) AS rest, greatest(floor(sqrt(size)), 1)::BIGINT AS m
  FROM r GROUP BY r.source, size
), w AS (
  SELECT *, rest - coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS words,
    (sum(n * size * m) OVER (PARTITION BY source ORDER BY size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS mass FROM h
), f AS (
  SELECT source, arg_max(words / mass, size) AS scale FROM w WHERE mass > 0 AND words * m <= mass GROUP BY source
), q AS (
  SELECT r.*, greatest(least(scale * greatest(floor(sqrt(size)), 1), 1.0), {LEAST_CHANCE}) AS chance
  FROM r LEFT JOIN f ON r.source IS NOT DISTINCT FROM f.source
), z AS (
  SELECT *, (draw / (1 - draw)) * ((1 - chance) / chance) AS odds FROM q
), k AS (
  SELECT *, CASE WHEN rest > 0 AND source_size > 0 THEN odds / (1 + odds) ELSE draw END AS rank FROM z
), o AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS reach FROM k
)
SELECT doc_id, size, source_size, target,
  ((whole + (rest > 0 AND reach <= rest)::INT) * size)::BIGINT AS taken
FROM o
"""
