"""Language identification by a small convolutional network over bytes.

A text is lower-cased, its bytes other than letters become one gap symbol, and
the whole of it is cut into windows of a fixed length. Filters of several widths
run over each window, max pooling keeps each filter's strongest answer, and a
softmax gives the languages' shares. A text's scores are the mean over its
windows, weighted by the letters in them.

The network is trained in numpy on the driver from a bounded sample of labelled
texts; it is a few hundred kilobytes and travels with the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import map_batches, with_columns_of
from tidematch.session import ship_package

#: Bytes in a window.
WINDOW = 256
WIDTHS = (2, 3, 4)
#: Filters of each width.
FILTERS = 16
#: Labelled texts that training takes: of each language, of all together, about; and
#: passages of each. Every language is learned; the more there are, the fewer of each.
DOCS_PER_LANG = 1000
DOCS = 20_000
PASSAGES = 2
#: Languages whose chances of being taken are sent to the tasks; more are joined.
BROADCAST_LANGS = 100_000
UNDETERMINED = "und"

#: Symbols: 0 the gap, 1 to 26 the letters a to z, then the bytes from 128 on.
_SYMBOL = np.zeros(256, np.int16)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)
SYMBOLS = 155


@dataclass
class Network:
    """Filter tables by width and offset, and the softmax layer on top."""

    langs: list[str]
    tables: list[np.ndarray]  # width x SYMBOLS x FILTERS each
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pairs(self) -> list[tuple[list[np.ndarray], np.ndarray | None]]:
        """The tables joined for two symbols at once, and the odd one left."""
        out = []
        for table in self.tables:
            joined = [
                (table[k][:, None] + table[k + 1][None]).reshape(-1, FILTERS)
                for k in range(0, len(table) - 1, 2)
            ]
            out.append((joined, table[-1] if len(table) % 2 else None))
        return out


def windows_of(text: str) -> np.ndarray:
    """All windows of a text as symbols, the last one filled with gaps."""
    raw = _SYMBOL[np.frombuffer(text.lower().encode(), np.uint8)]
    count = max(1, -(-len(raw) // WINDOW))
    whole = np.zeros(count * WINDOW, np.int16)
    whole[: len(raw)] = raw
    return whole.reshape(count, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Predictor:
    """Applies a network to windows in blocks of bounded size."""

    BLOCK = 128

    def __init__(self, net: Network):
        self.net = net
        self.pairs = net.pairs()

    def shares(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            self._block(windows[k : k + self.BLOCK]) for k in range(0, len(windows), self.BLOCK)
        ]
        return np.concatenate(parts)

    def _block(self, windows: np.ndarray) -> np.ndarray:
        x = windows.astype(np.int32)
        two = x[:, :-1] * SYMBOLS + x[:, 1:]
        pooled = []
        for table, (joined, odd) in zip(self.net.tables, self.pairs):
            width = len(table)
            n = WINDOW - width + 1
            answer = joined[0][two[:, :n]]
            for k in range(1, len(joined)):
                answer += joined[k][two[:, 2 * k : 2 * k + n]]
            if odd is not None:
                answer += odd[x[:, width - 1 : width - 1 + n]]
            pooled.append(answer.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.net.bias, 0)
        return _softmax(hidden @ self.net.weights + self.net.offset)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share) of each text; ``und`` and 0 without a letter."""
        cut = [windows_of(t) if t and any(map(str.isalpha, t)) else None for t in texts]
        some = [w for w in cut if w is not None]
        if not some or not self.net.langs:
            return [(UNDETERMINED, 0.0)] * len(texts)
        stacked = np.concatenate(some)
        shares = self.shares(stacked)
        weight = (stacked > 0).sum(axis=1) + 1e-3
        firsts = np.cumsum([0, *map(len, some)])[:-1]
        sums = np.add.reduceat(shares * weight[:, None], firsts)
        means = sums / np.add.reduceat(weight, firsts)[:, None]
        best = means.argmax(axis=1)
        found = iter(zip(best.tolist(), means.max(axis=1).tolist()))
        out = []
        for w in cut:
            if w is None:
                out.append((UNDETERMINED, 0.0))
            else:
                k, share = next(found)
                out.append((self.net.langs[k], min(1.0, max(0.0, float(share)))))
        return out


def fit(passages: list[str], labels: list[str], epochs: int = 4, seed: int = 7) -> Network:
    """Train a network; with one language or none it always gives that answer."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    width_total = FILTERS * len(WIDTHS)
    tables = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS]
    params = [
        *tables,
        np.zeros(width_total, np.float32),
        rng.normal(0, 0.2, (width_total, max(1, len(langs)))).astype(np.float32),
        np.zeros(max(1, len(langs)), np.float32),
    ]
    net = Network(langs, tables, *params[len(tables) :])
    if len(langs) < 2:
        return net
    x = np.concatenate([windows_of(p)[:1] for p in passages])
    number = {v: k for k, v in enumerate(langs)}
    y = np.array([number[v] for v in labels])
    share = np.bincount(y, minlength=len(langs)) / len(y)
    cost = (1 / (len(langs) * share))[y]  # every language counts the same
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 64):
            rows = order[start : start + 64]
            step += 1
            for k, grad in enumerate(_gradients(net, x[rows].astype(np.int64), y[rows], cost[rows])):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad * grad
                m = first[k] / (1 - 0.9**step)
                v = second[k] / (1 - 0.99**step)
                params[k] -= 0.02 * m / (np.sqrt(v) + 1e-6)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, cost: np.ndarray):
    """Gradients of the weighted cross entropy, in the order of ``fit``."""
    pooled, winners = [], []
    for table in net.tables:
        n = WINDOW - len(table) + 1
        answer = sum(table[k][x[:, k : k + n]] for k in range(len(table)))
        at = answer.argmax(axis=1)
        winners.append(at)
        pooled.append(np.take_along_axis(answer, at[:, None], axis=1)[:, 0])
    raw = np.concatenate(pooled, axis=1) + net.bias
    hidden = np.maximum(raw, 0)
    shares = _softmax(hidden @ net.weights + net.offset)
    shares[np.arange(len(y)), y] -= 1
    top = (shares * (cost / len(y))[:, None]).astype(np.float32)
    back = (top @ net.weights.T) * (raw > 0)
    filters = np.arange(FILTERS)[None]
    out = []
    for k, (table, at) in enumerate(zip(net.tables, winners)):
        grad = np.zeros_like(table)
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(len(table)):
            seen = np.take_along_axis(x, at + j, axis=1)
            np.add.at(grad[j], (seen, np.broadcast_to(filters, seen.shape)), own)
        out.append(grad)
    return [*out, back.sum(axis=0), hidden.T @ top, top.sum(axis=0)]


def remainder(key: str = "doc_id"):
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def labelled_sample(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(lang, passage) of at most about ``DOCS_PER_LANG`` texts a language and ``DOCS``
    together, chosen by a hash of the key; two passages of each.

    One pass over the labels counts the languages, a second takes the share of
    each that gives the wanted number.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & (remainder(key) != 2))
    labelled = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("lang"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    langs = max(1, counts.count())
    each = min(DOCS_PER_LANG, max(1, DOCS // langs))
    chance = F.least(F.lit(1.0), F.lit(each) / F.col("n")) * min(1.0, DOCS / langs)
    draw = F.pmod(F.xxhash64("k"), F.lit(1_000_000)) / 1_000_000
    chances = counts.select("lang", chance.alias("chance"))
    if langs <= BROADCAST_LANGS:
        chances = F.broadcast(chances)
    met = labelled.filter(F.col("t").isNotNull()).join(chances, "lang")
    some = met.filter(draw < F.col("chance"))
    room = F.greatest(F.length("t") - WINDOW, F.lit(1))
    starts = [F.pmod(F.xxhash64("k", F.lit(k)), room) + 1 for k in range(PASSAGES)]
    cut = F.array(*[F.substring(F.col("t"), s.cast("int"), F.lit(WINDOW)) for s in starts])
    return some.select("lang", F.explode(cut).alias("passage"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network learned from ``docs`` whose key's remainder is not 2.

    About ``DOCS * PASSAGES`` passages of ``WINDOW`` characters at most reach the
    driver, whatever the input's size.
    """
    rows = sorted(
        (r["lang"], r["passage"])
        for r in labelled_sample(docs, key, text, lang).collect()
        if any(map(str.isalpha, r["passage"]))
    )
    return fit([r[1] for r in rows], [r[0] for r in rows])


def predict(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row; whole texts, nothing but the text
    decides. ``und`` and 0 for a null text or one without a letter. Repeated
    rows and null keys come back as they are; other columns are not read."""
    ship_package(docs.sparkSession)

    def make():
        model = Predictor(net)

        def call(columns):
            return [(k, *p) for k, p in zip(columns[0], model.predict(columns[1]))]

        return call

    kind = dict(docs.dtypes)[key]
    return map_batches(docs.select(key, text), make, f"`{key}` {kind}, lang_pred string, score double")


def with_language(
    docs: DataFrame, net: Network, pred: str, score: str, text: str = "text"
) -> DataFrame:
    """``docs`` with two more columns, named ``pred`` and ``score``. The rows pass
    the network as they are, so nothing is joined."""
    ship_package(docs.sparkSession)

    def make():
        model = Predictor(net)
        return lambda texts: [tuple(p) for p in model.predict(texts)]

    return with_columns_of(docs, text, make, f"`{pred}` string, `{score}` double")
