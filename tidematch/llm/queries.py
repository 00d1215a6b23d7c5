"""The numbered queries and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidematch.llm import (
    ann,
    bpe,
    centroids,
    divergence,
    html,
    langid,
    linededup,
    mixing,
    pii,
    quality,
    simhash,
    toxicity,
    urls,
)
from tidematch.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, plain and disguised."""
    found = pii.spans(table(spark, sf_dir, "documents"))
    kinds = F.transform("plain", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
        for k in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("plain")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_all"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdicts of the line-first rules."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_removed"
    return judged.select("doc_id", *[f"quality.{n}" for n in names.split()])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest document linked with it."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        simhash.hexadecimal("fp").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours of every hundredth vector among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, F.col("vec_id") % 100 == 0)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without lines that repeat an earlier one."""
    cleaned = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies that a mix by source weights takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html.extract(table(spark, sf_dir, "pages"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, rule and verdict."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens and their decoded text, as digests."""
    coded = bpe.recode(table(spark, sf_dir, "documents"), VOCABULARY)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs)
    return langid.predict(docs, net).select(
        "doc_id",
        F.coalesce(langid.remainder() == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id",
        F.coalesce(toxicity.remainder() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after five rounds on whole numbers."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and its telling terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_ann": op4_ann,
    "op5_lines": op5_lines,
    "op6_mixing": op6_mixing,
    "op7_html": op7_html,
    "op8_urls": op8_urls,
    "op9_bpe": op9_bpe,
    "op10_langid": op10_langid,
    "op11_toxicity": op11_toxicity,
    "op12_centroids": op12_centroids,
    "op13_divergence": op13_divergence,
}
SQL = {
    "op2_quality": quality.SQL,
    "op5_lines": linededup.SQL,
    "op6_mixing": mixing.SQL,
    "op12_centroids": centroids.SQL,
    "op13_divergence": divergence.SQL,
}
