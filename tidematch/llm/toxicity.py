"""Toxicity of texts by a factorization machine over hashed terms.

A text's terms are its distinct words, the beginnings of the longer ones, and a
mark for the size of its vocabulary; they are hashed into a space of fixed size.
The machine gives every term a weight and a short vector, and a text the sum of its
terms' weights and of the products of all pairs of their vectors. The pairs are
what linear weights miss: an insult and the mention of a group may each be harmless
and together toxic, and a weak sign means less in a long text than in a short one.

It is trained in numpy on the driver from a bounded sample of labelled rows, on the
terms that are more frequent in toxic texts of the sample than chance explains. The
model is below a megabyte and travels with the tasks; every whole text is scored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import Steps, map_batches, with_columns_of
from tidematch.session import ship_package

#: Labelled rows that training takes of each label, about: the bound of its sample.
SAMPLE = 4000
#: Hashed terms.
SPACE = 1 << 20
#: Terms that the machine has weights for, at most.
TERMS = 4096
#: A term is in at least so many toxic texts of the sample, and in this share of them;
#: their share is so many standard errors above that of the others and so many times it.
LEAST_TEXTS, LEAST_SHARE, LEAST_ERRORS, LEAST_TIMES = 3, 0.005, 3.0, 2.0
#: Numbers in a term's vector.
FACTORS = 8
#: Lengths of words' beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6)
#: Marks for vocabularies of up to 2^k words.
SIZES = 25
EPOCHS, BATCH, STEP = 15, 128, 0.02
#: What a toxic text of the sample counts, beside 1 for another.
TOXIC_WEIGHT = 3.0
SHRINK_WEIGHTS, SHRINK_FACTORS = 1e-4, 1e-3
#: Words that a scorer remembers, and their longest.
REMEMBERED, LONGEST = 200_000, 64

_WORD = re.compile(r"[^\W\d_]+")


def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % SPACE


def terms_of_word(word: str) -> list[int]:
    """The word itself, and each beginning of it that is shorter."""
    return [hashed(word)] + [hashed("^" + word[:k]) for k in BEGINNINGS if len(word) > k]


def size_mark(words: int) -> int:
    return hashed(f"#{min(words.bit_length(), SIZES - 1)}")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def terms_of(text: str | None) -> list[int]:
    """All of a text's hashed terms, in order, each once."""
    words = words_of(text)
    found = {t for w in words for t in terms_of_word(w)}
    found.add(size_mark(len(words)))
    return sorted(found)


@dataclass
class Machine:
    """Weights and vectors of the chosen terms; ``bias`` alone without any."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def answers(x: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
    """(logits, sums of vectors) for rows of zeros and ones."""
    sums = x @ factors
    pairs = 0.5 * ((sums * sums).sum(axis=1) - x @ (factors * factors).sum(axis=1))
    return bias + x @ weights + pairs, sums


def fit(chosen: list[int], rows: list[list[int]], labels: list[int], seed: int = 11) -> Machine:
    """Train on rows of chosen terms. With labels of one kind, or none, the answer
    is always that kind, or 0."""
    terms = np.array(sorted(chosen), np.int64)
    rng = np.random.default_rng(seed)
    bias = np.zeros(1, np.float32)
    weights = np.zeros(len(terms), np.float32)
    factors = rng.normal(0, 0.05, (len(terms), FACTORS)).astype(np.float32)
    y = np.array(labels, np.float32)
    if not 0 < y.sum() < len(y):
        sure = 40.0 if len(y) and y[0] else -40.0
        return Machine(terms, sure, weights, np.zeros_like(factors))
    places = [np.searchsorted(terms, r) for r in rows]
    cost = np.where(y > 0, TOXIC_WEIGHT, 1).astype(np.float32)
    params = [bias, weights, factors]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for start in range(0, len(y), BATCH):
            some = order[start : start + BATCH]
            x = np.zeros((len(some), len(terms)), np.float32)
            for k, i in enumerate(some):
                x[k, places[i]] = 1
            logits, sums = answers(x, float(bias[0]), weights, factors)
            off = ((_sigmoid(logits) - y[some]) * cost[some] / len(some)).astype(np.float32)
            by_term = x.T @ off
            grads = [
                off.sum(keepdims=True),
                by_term + SHRINK_WEIGHTS * weights,
                x.T @ (off[:, None] * sums) - by_term[:, None] * factors + SHRINK_FACTORS * factors,
            ]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, float(bias[0]), weights, factors)


class Scorer:
    """Scores texts, remembering which of the machine's terms a word has."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.place = {int(t): k for k, t in enumerate(machine.terms)}
        self.known: dict[str, tuple] = {}

    def _of_word(self, word: str) -> tuple:
        found = tuple(self.place[t] for t in terms_of_word(word) if t in self.place)
        if len(word) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def active(self, text: str | None) -> list[int]:
        """Places of the machine's terms in a text."""
        words = words_of(text)
        known, found = self.known, set()
        for word in words:
            got = known.get(word)
            if got is None:
                got = self._of_word(word)
            if got:
                found.update(got)
        mark = self.place.get(size_mark(len(words)))
        if mark is not None:
            found.add(mark)
        return sorted(found)

    def scores(self, texts: list[str | None]) -> list[float]:
        m = self.machine
        out = []
        for text in texts:
            some = self.active(text)
            vectors = m.factors[some].astype(np.float64)
            pairs = 0.5 * ((vectors.sum(axis=0) ** 2).sum() - (vectors**2).sum())
            logit = m.bias + m.weights[some].astype(np.float64).sum() + pairs
            out.append(float(_sigmoid(np.float64(logit))))
        return out


def remainder(key: str = "doc_id"):
    """crc32 of the key as text, modulo 5; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE
) -> DataFrame:
    """(key, text, label) of about ``sample`` labelled keys of each label whose
    remainder is not 0, chosen by a hash of the key.

    A key that is labelled both ways is toxic; one with several texts gives the
    greatest. Labels but 0 and 1 say nothing. Of equal texts with equal labels one
    stays, so that copies don't make their words look telling. The chosen keys are
    so few that they are broadcast.
    """
    known = labels.filter(F.col(label).isin(0, 1) & (remainder(key) != 0))
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(label) == value, min(1.0, sample / count)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(5)), F.lit(1_000_000)) / 1_000_000
    few = known.filter(draw < share).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("label"))
    given = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = given.join(F.broadcast(few), "k")
    met = met.groupBy("k").agg(F.max("text").alias("text"), F.max("label").cast("int").alias("label"))
    return met.groupBy("text", "label").agg(F.min(F.col("k").cast("string")).alias("k"))


def chosen_terms(rows: DataFrame, toxic: int, clean: int, terms: int = TERMS) -> list[int]:
    """The terms of rows (label, terms) by how far their share of toxic texts is above
    their share of the others, and the marks of sizes."""
    marks = [size_mark((1 << k) - 1) for k in range(SIZES)]
    each = rows.select("label", F.explode("terms").alias("term"))
    counted = each.groupBy("term").agg(F.sum("label").alias("a"), F.count("*").alias("n"))
    p1 = (F.col("a") + 0.5) / (toxic + 1)
    p0 = (F.col("n") - F.col("a") + 0.5) / (clean + 1)
    both = (F.col("n") + 0.5) / (toxic + clean + 1)
    error = F.sqrt(both * F.greatest(1 - both, F.lit(1e-9)) * (1 / max(1, toxic) + 1 / max(1, clean)))
    told = counted.select("term", "a", ((p1 - p0) / error).alias("z"), (p1 / p0).alias("times"))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    told = told.filter((F.col("a") >= least) & (F.col("z") > LEAST_ERRORS) & (F.col("times") >= LEAST_TIMES))
    best = told.orderBy(F.desc("z"), "term").limit(terms).collect()
    return sorted({r["term"] for r in best} | set(marks))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Machine:
    """A machine learned from labelled texts whose key's remainder is not 0.

    Only the chosen terms of about ``2 * sample`` texts reach the driver.
    """
    ship_package(docs.sparkSession)
    steps = Steps(docs.sparkSession, "toxicity")
    some = labelled_sample(docs, labels, key, text, label, sample)
    listed = map_batches(
        some.select("k", "text", "label"),
        lambda: lambda columns: [(k, n, terms_of(t)) for k, t, n in zip(*columns)],
        "k string, label int, terms array<int>",
    )
    listed = steps.put(listed, "terms")
    counts = {r["label"]: r["count"] for r in listed.groupBy("label").count().collect()}
    chosen = chosen_terms(listed, counts.get(1, 0), counts.get(0, 0))
    own = F.array_sort(F.array_intersect("terms", F.array(*map(F.lit, chosen))))
    rows = sorted((r["k"], r["label"], r["own"]) for r in listed.select("k", "label", own.alias("own")).collect())
    steps.drop("terms")
    return fit(chosen, [r[2] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, machine: Machine, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, higher for texts that are likelier toxic.

    The whole text alone decides. A null text is scored as an empty one. Repeated
    rows and null keys come back as they are, other columns as they come; a column
    of that name is replaced. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop(name)

    def make():
        scorer = Scorer(machine)
        return lambda texts: [(s,) for s in scorer.scores(texts)]

    return with_columns_of(docs, text, make, f"`{name}` double")
