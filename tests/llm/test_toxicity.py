import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ODD_TEXTS
from tidematch.llm import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").collect()
    return [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]


def test_held_out_rows(scored):
    toxic = np.array([r["score"] for r in scored if r["toxic"]])
    clean = np.array([r["score"] for r in scored if not r["toxic"]])
    assert len(toxic) > 80 and len(clean) > 600
    assert (toxic[:, None] > clean[None]).mean() > 0.97
    assert (toxic >= 0.5).mean() > 0.85 and (clean >= 0.5).mean() < 0.01


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lied = labels.withColumn("toxic", F.when(toxicity.remainder() == 0, 1).otherwise(F.col("toxic")))
    seen = toxicity.labelled_sample(docs, lied, "doc_id", "text", "toxic").collect()
    assert seen and all(zlib.crc32(r["k"].encode()) % 5 for r in seen)


def mentions(count, seed):
    """Toxic are texts with an insult and a group, but not with one of them."""
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(count):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}" for _ in range(20)]
        words += ["fools"] * insult + ["martians"] * group
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(int(insult and group))
    return texts, labels


def test_pairs_tell_what_single_words_do_not(spark, make_docs):
    texts, labels = mentions(1500, 1)
    rows = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    machine = toxicity.train(make_docs(texts), rows)
    texts, labels = mentions(500, 2)
    told = np.array(toxicity.Scorer(machine).scores(texts)) >= 0.5
    assert (told == np.array(labels)).mean() > 0.97
    # With the pairs taken out no single weights do as well on insult or group alone.
    only = toxicity.Machine(machine.terms, machine.bias, machine.weights, 0 * machine.factors)
    place = {int(t): k for k, t in enumerate(machine.terms)}
    both = [place[toxicity.hashed(w)] for w in ("fools", "martians")]
    joint = float(machine.factors[both[0]] @ machine.factors[both[1]])
    assert joint > 1
    assert (np.array(toxicity.Scorer(only).scores(texts)) >= 0.5).mean() < np.mean(labels)


def test_scores_equal_all_pairs():
    rng = np.random.default_rng(4)
    words = [f"word{k}" for k in range(30)]
    terms = np.array(sorted({t for w in words for t in toxicity.terms_of_word(w)}))
    machine = toxicity.Machine(
        terms, 0.3, rng.normal(0, 0.1, len(terms)), rng.normal(0, 0.1, (len(terms), toxicity.FACTORS))
    )
    text = " ".join(words[:12])
    some = [k for k, t in enumerate(terms) if t in set(toxicity.terms_of(text))]
    logit = 0.3 + sum(machine.weights[i] for i in some)
    logit += sum(machine.factors[i] @ machine.factors[j] for i in some for j in some if i < j)
    assert toxicity.Scorer(machine).scores([text])[0] == pytest.approx(1 / (1 + np.exp(-logit)))


def test_the_sample_is_bounded_and_without_copies(spark, make_docs):
    texts = [f"text {k // 2}" for k in range(2000)]
    rows = spark.createDataFrame([(k, int(k % 4 < 2)) for k in range(2000)], "doc_id long, toxic int")
    some = toxicity.labelled_sample(make_docs(texts), rows, "doc_id", "text", "toxic", sample=100)
    found = some.collect()
    assert 100 < len(found) < 280 and len({r["text"] for r in found}) == len(found)


def test_odd_rows(spark, odd_docs):
    kinds = "doc_id long, toxic int, text string"
    odd = [(0, 1, "x"), (1, 0, "x"), (None, 1, None), (3, None, "x"), (5, 0, "x"), (6, 1, "x"), (6, 0, "x"), (8, 7, "x")]
    labels = spark.createDataFrame(odd, kinds)
    docs = odd_docs
    machine = toxicity.train(docs, labels)
    rows = toxicity.score(docs, machine)
    assert rows.columns == [*[c for c in docs.columns if c != "score"], "score"]
    found = rows.collect()
    assert len(found) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    by_text = {r["text"]: r["score"] for r in found}
    assert by_text[None] == by_text[""]
    assert LONG in by_text
    # Labels of one kind, or none.
    for some, sure in ((labels.filter("toxic = 1"), 1), (labels.filter("toxic = 0"), 0), (labels.limit(0), 0)):
        machine = toxicity.train(docs, some)
        assert {round(r["score"], 6) for r in toxicity.score(docs, machine).collect()} == {sure}
    assert toxicity.score(docs.limit(0), machine).count() == 0
