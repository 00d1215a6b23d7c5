"""URL filters: rules by host and path, and trust that spreads over links.

Rules decide the pages they fit. For the others the hosts' link graph does:
personalised PageRank carries trust from hosts that the rules mostly allow along
the links, and distrust from hosts that they mostly block against the links, to
those that point at them. A host with more distrust than trust is blocked.
"""

from __future__ import annotations

from itertools import count, islice
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import stored
from tidematch.session import work_dir
from tidematch.sources.files import file_system

#: Share of a score that follows links.
DAMPING = 0.85
#: Rounds at most; None for as many as it takes until the scores settle.
ROUNDS = None
#: Rounds end when no score moves by more than this share of itself. A host that
#: is reached for the first time moves by all of its score.
SETTLED = 1e-6
#: A host is blocked when distrust is more than this share of trust and distrust.
BLOCK_SHARE = 0.5
#: Rules fit by these; a rule is (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rows of one host are spread over so many parts when they meet its verdict.
SALTS = 16

LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z]+:)?//([^/?#"'\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ://."""
    given = F.coalesce(url, F.lit(""))
    at = F.instr(given, "://")
    rest = F.when(at > 0, F.substring(given, at + 3, F.length(given))).otherwise(F.lit(""))
    return (
        lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (size, rule, verdict), or null. Of
    equally long ones a blocking rule wins."""
    fits = F.array(
        *[
            F.when(
                ((host == h) | host.endswith("." + h)) & path.startswith(p),
                F.struct(
                    F.lit(len(h + p)).alias("size"),
                    F.lit(verdict).alias("verdict"),
                    F.lit(h + p).alias("rule"),
                ),
            )
            for verdict, h, p in rules
        ]
    )
    return F.array_max(F.filter(fits, lambda r: r.isNotNull()))


def ruled(pages: DataFrame, key: str, url: str, rules=RULES) -> DataFrame:
    """(key, host, path, fit) of every row."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    return parsed.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))


def link_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst) of different hosts, each pair once. Relative links stay on
    their host and give no edge."""
    host, _ = host_and_path(F.col(url))
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))
    pairs = pages.select(host.alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    pairs = pairs.select("src", lower_ascii(F.col("dst")).alias("dst"))
    return pairs.filter("src <> dst AND src <> '' AND dst <> ''").distinct()


def seeds(rows: DataFrame) -> DataFrame:
    """(host, kind, seed): trust and distrust, each summing to 1. A host is a
    seed when rules of one verdict fit more than half of its pages."""
    share = lambda v: F.avg(F.coalesce(F.col("fit.verdict") == v, F.lit(False)).cast("int"))
    hosts = rows.filter("host <> ''").groupBy("host").agg(
        share("allow").alias("allow"), share("block").alias("block")
    )
    kind = F.when(F.col("allow") > 0.5, "trust").when(F.col("block") > 0.5, "distrust")
    chosen = hosts.select("host", kind.alias("kind")).filter("kind IS NOT NULL")
    counts = chosen.groupBy("kind").agg(F.count("*").alias("n"))
    return chosen.join(counts, "kind").select("host", "kind", (1 / F.col("n")).alias("seed"))


def propagate(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(host, kind, score) after personalised PageRank, trust along the edges and
    distrust against them. Each round is written to the shared folder in place of
    the one before.

    What a round adds to a host follows from what the one before added to its
    neighbours; once no score moves by more than ``SETTLED`` of itself, none ever
    will, and no further host is reached. The size of the graph has no part in it.
    """
    directed = edges.select(F.lit("trust").alias("kind"), "src", "dst").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"))
    )
    degrees = directed.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    directed = stored(directed.join(degrees, ["kind", "src"]), "url-edges")
    base = start.select("host", "kind", ((1 - DAMPING) * F.col("seed")).alias("score"))
    base = stored(base, "url-base")
    spark = edges.sparkSession
    scores, written = base, None
    for _ in islice(count(), ROUNDS):
        moved = (
            directed.join(scores.withColumnRenamed("host", "src"), ["kind", "src"])
            .select(F.col("dst").alias("host"), "kind", (DAMPING * F.col("score") / F.col("degree")).alias("score"))
        )
        new = base.union(moved).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        path = work_dir(spark, "llm/url-round")
        new.write.parquet(path)
        new = spark.read.schema(new.schema).parquet(path)
        change = (
            new.alias("n")
            .join(scores.alias("o"), ["host", "kind"], "left")
            .filter("n.score > 0")
            .agg(F.max((F.col("n.score") - F.coalesce("o.score", F.lit(0.0))) / F.col("n.score")))
            .first()[0]
        )
        if written is not None:
            files, location = file_system(spark, written)
            files.delete(location, True)
        scores, written = new, path
        if not change or change <= SETTLED:
            break
    return scores


def blocked_hosts(scores: DataFrame) -> DataFrame:
    """Hosts whose distrust outweighs their trust."""
    part = lambda k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0))
    both = scores.groupBy("host").agg(part("trust").alias("t"), part("distrust").alias("d"))
    return both.filter(F.col("d") > BLOCK_SHARE * (F.col("t") + F.col("d"))).select("host")


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES
) -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``.

    Without a rule the verdict is ``block`` for a host that the link graph
    distrusts, else ``allow``, also for hosts that no link reaches and for rows
    without a host. A null page has no links. Repeated rows come back as they
    are; an empty table gives no rows; other columns are not read.
    """
    rows = stored(ruled(pages, key, url, rules), "url-rows")
    scores = propagate(link_edges(pages, url, html), seeds(rows))
    bad = blocked_hosts(scores).select(
        "host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("bad")
    )
    salt = F.pmod(F.xxhash64("key", "path"), F.lit(SALTS)).cast("int")
    met = rows.withColumn("salt", salt).join(bad, ["host", "salt"], "left")
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return met.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", method).alias("verdict"),
    )
