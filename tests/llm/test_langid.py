import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    told = langid.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in told if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in told)


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lied = docs.withColumn("lang", F.when(langid.remainder() == 2, "xx").otherwise(F.col("lang")))
    assert "xx" not in langid.train(lied).langs


def test_joined_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(3)
    net = langid.fit(["abc def ghi " * 9, "über größe " * 9] * 8, ["a", "b"] * 8, epochs=1)
    windows = rng.integers(0, langid.SYMBOLS, (5, langid.WINDOW)).astype(np.int16)
    pooled = []
    for table in net.tables:
        n = langid.WINDOW - len(table) + 1
        pooled.append(sum(table[k][windows[:, k : k + n]] for k in range(len(table))).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    logits = hidden @ net.weights + net.offset
    wanted = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(langid.Predictor(net).shares(windows), wanted, atol=1e-4)


def test_rows(odd_docs):
    net = langid.train(odd_docs)
    rows = langid.predict(odd_docs, net).collect()
    assert len(rows) == len(ODD_TEXTS)
    told = {r["doc_id"]: r for r in rows}
    assert told[0]["lang_pred"] == told[1]["lang_pred"] == langid.UNDETERMINED
    marked = langid.with_language(odd_docs, net, "p", "q")
    assert marked.columns == [*odd_docs.columns, "p", "q"] and marked.count() == len(ODD_TEXTS)
    nothing = langid.train(odd_docs.limit(0))
    assert nothing.langs == [] and langid.predict(odd_docs.limit(0), nothing).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd_docs, nothing).collect()} == {"und"}
