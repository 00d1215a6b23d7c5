import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.test_linededup import by_hand
from tidematch.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    con = connect(SF)
    assert differences(queries.QUERIES[name](spark, SF), con, queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_the_other_queries_give_whole_tables(spark, name):
    df = queries.QUERIES[name](spark, SF)
    table, key = {
        "op4_ann": ("embeddings", "vec_id"), "op7_html": ("pages", "page_id"), "op8_urls": ("pages", "page_id"),
    }.get(name, ("documents", "doc_id"))
    source = spark.read.parquet(f"{SF}/{table}.parquet")
    if name == "op4_ann":
        assert df.count() == 10 * source.filter("vec_id % 100 = 0").count()
    else:
        assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_copies", "mixture", "tokens"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).persist()
        if name != "tokens":
            assert after.columns == columns
        if name == "lines":
            rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
            assert {r["doc_id"]: r["text"] for r in after.collect()} == by_hand(rows)
        if name == "near_copies":
            assert after.count() == after.select("doc_id").distinct().count() <= before.count()
        if name == "tokens":
            texts = {r["doc_id"]: r["text"] for r in before.collect()}
            coder = bpe.Codec(corpus_pipeline.VOCABULARY)
            for r in after.collect():
                assert r["n_tokens"] == len(coder.encode([texts[r["doc_id"]]])[0]) // 4
            assert after.count() == before.count()
        before = after


def test_stages_take_empty_and_odd_tables(spark, odd_docs, tmp_path):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for now in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, "")
            now.count()
