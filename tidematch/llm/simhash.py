"""Near-duplicates by SimHash, found with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits. If two
fingerprints differ in at most two bits, one segment is free of errors, and any
other has at most two. Each segment, filled up to 23 bits, is decoded with the
perfect Golay code: the codewords next to the segment and to those one bit away
are its one to six keys, and two segments that differ in at most two bits share
one, through the word between them. So for each segment an exact value together
with a Golay key of the next one is a key that the two fingerprints share.

Fingerprints that share a key are joined and verified by their differing bits. A
key that many hold is not joined with itself: there each fingerprint is listed
under itself and its 64 neighbours one bit away, and those that meet under one
of them differ in at most two bits. At most 65 can meet, so no group emits all
its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidematch.llm.common import fresh, map_batches, stored, with_columns_of
from tidematch.llm.components import components
from tidematch.session import ship_package

#: Words in a shingle and the seed of its hash.
SHINGLE = 3
SEED = 42
#: Differing bits of linked fingerprints. The keys below are made for two.
MAX_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints under one key up to which they are joined with one another.
SMALL_GROUP = 32
#: A fingerprint with at least this share of all rows is joined apart; there are
#: at most as many of them as the share's inverse.
HOT_SHARE = 1 / 1000

#: Hashes whose bits are counted at once.
_BLOCK = 65_536


def fingerprint(text: str | None) -> int:
    """The fingerprint of a text, 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    width = min(SHINGLE, len(words))
    ends = (starts[width:] - 1).tolist()
    hashes = np.fromiter(
        [xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends)],
        np.uint64,
        len(ends),
    )
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[k : k + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    # Bit 0 of each byte comes last from unpackbits; bytes run from the low one.
    over = (counts.reshape(8, 8)[:, ::-1].reshape(64) * 2 > len(hashes)).astype(np.uint64)
    return int((over << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp long) of every row; ``fp`` holds the 64 bits as a signed number."""
    ship_package(docs.sparkSession)

    def make():
        def call(columns):
            return [(k, _signed(fingerprint(t))) for k, t in zip(*columns)]

        return call

    kind = dict(docs.dtypes)[key]
    return map_batches(docs.select(key, text), make, f"`{key}` {kind}, fp long")


class Golay:
    """The perfect binary code of 23 bits, 12 of them free, that corrects three."""

    GENERATOR = 0b101011100011

    def __init__(self):
        # Each syndrome belongs to exactly one error of at most three bits.
        self.error = np.zeros(1 << 11, np.int64)
        ones = [1 << i for i in range(23)]
        errors = [0, *ones]
        errors += [a | b for a in ones for b in ones if a < b]
        errors += [a | b | c for a in ones for b in ones if a < b for c in ones if b < c]
        words = np.array(errors, np.int64)
        self.error[self.syndrome(words)] = words

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        """The remainder of each word as a polynomial over the generator."""
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest ^= ((rest >> bit) & 1) * (self.GENERATOR << (bit - 11))
        return rest

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 free bits of the codeword next to each word."""
        return (words ^ self.error[self.syndrome(words)]) >> 11


_golay: list[Golay] = []


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) for every key of the fingerprints."""
    if not _golay:
        _golay.append(Golay())
    code = _golay[0]
    bits = prints.astype(np.int64).view(np.uint64)
    parts = [
        ((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for at, width in SEGMENTS
    ]
    rows, keys = [], []
    for k, (_, width) in enumerate(SEGMENTS):
        near = np.stack([parts[k]] + [parts[k] ^ (1 << i) for i in range(width)], axis=1)
        codewords = np.sort(code.index(near.reshape(-1)).reshape(near.shape), axis=1)
        new = np.ones(codewords.shape, bool)
        new[:, 1:] = codewords[:, 1:] != codewords[:, :-1]
        row, at = np.nonzero(new)
        exact = (k - 1) % len(SEGMENTS)
        rows.append(row)
        keys.append((exact << 36) | (parts[exact][row] << 12) | codewords[row, at])
    return np.concatenate(rows), np.concatenate(keys)


def candidate_keys(prints: DataFrame) -> DataFrame:
    """(key, fp) rows for a table of distinct ``fp``."""
    ship_package(prints.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(start, 4096).to_numpy(zero_copy_only=False)
                rows, keys = keys_of(fp)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], schema=schema)

    return prints.select("fp").mapInArrow(run, "key long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """(a, b) pairs that connect all of the distinct ``fp`` that differ in at
    most two bits, through others where a key is held by many."""
    keyed = stored(candidate_keys(prints), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = stored(keyed.join(sizes, "key"), "simhash-met")
    few = met.filter(F.col("n") <= SMALL_GROUP).select("key", "fp")
    pairs = (
        few.alias("x")
        .join(few.alias("y"), F.expr("x.key = y.key AND x.fp < y.fp"))
        .filter(F.expr(f"bit_count(x.fp ^ y.fp) <= {MAX_BITS}"))
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    many = (
        met.filter(F.col("n") > SMALL_GROUP)
        .select("key", "fp", F.explode(flips).alias("flip"))
        .select("key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    )
    star = many.withColumn("b", F.min("fp").over(Window.partitionBy("key", "middle")))
    stars = star.filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def groups(rows: DataFrame, key: str = "doc_id", of_root: bool = False) -> DataFrame:
    """(key, fp, component) for rows of (key, fp): the smallest key that can be
    reached over linked fingerprints, the row's own included.

    With ``of_root`` the result is (fp, root, k): for each fingerprint the one
    that names its group, and its own smallest key.

    Null keys do not count as smallest; a group of nothing else has a null
    component. ``rows`` is read twice and should be a stored table.
    """
    base = stored(
        rows.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("n")), "simhash-base"
    )
    roots = components(links(base), "simhash")
    owned = base.alias("p").join(roots.alias("r"), F.expr("p.fp = r.node"), "left")
    owned = owned.select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    owned = stored(owned, "simhash-owned")
    if of_root:
        return owned.select("fp", "root", F.col("first").alias("k"))
    least = owned.groupBy("root").agg(F.min("first").alias("component"))
    named = owned.join(least, "root").select("fp", "component", "n")
    named = stored(named, "simhash-named")
    total = named.agg(F.sum("n")).first()[0] or 0
    hot = named.filter(F.col("n") >= max(2, total * HOT_SHARE)).select("fp", "component")
    cold = named.filter(F.col("n") < max(2, total * HOT_SHARE)).select("fp", "component")
    # The hot ones are few by their definition, so they may go to every task.
    apart = rows.join(F.broadcast(hot.withColumnRenamed("component", "of_hot")), "fp", "left")
    return (
        apart.filter("of_hot IS NULL")
        .drop("of_hot")
        .join(cold, "fp", "left")
        .union(apart.filter("of_hot IS NOT NULL"))
        .select(key, "fp", "component")
    )


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component) for every row of ``docs``.

    A null text, an empty one and one without words share the fingerprint 0. A
    text of fewer than three words is one shingle. Rows that repeat belong to
    one group; an empty table gives no rows; other columns are not read.
    """
    return groups(stored(fingerprints(docs, key, text), "simhash-prints"), key)


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: that with the smallest key.

    Keys that are null come last. Of rows with that key and its smallest
    fingerprint one stays. The columns are those of ``docs``.
    """
    ship_package(docs.sparkSession)
    fp = fresh(docs, "fp")

    def make():
        return lambda texts: [(_signed(fingerprint(t)),) for t in texts]

    marked = stored(with_columns_of(docs, text, make, f"`{fp}` long"), "simhash-marked")
    found = groups(marked.select(F.col(key).alias("k"), F.col(fp).alias("fp")), "k", of_root=True)
    order = F.struct(F.col("k").isNull().alias("none"), "k", "fp")
    winners = found.groupBy("root").agg(F.min(order).alias("w")).select("w.k", "w.fp")
    same = (F.col(f"m.{fp}") == F.col("w.fp")) & F.col(f"m.{key}").eqNullSafe(F.col("w.k"))
    kept = marked.alias("m").join(winners.alias("w"), same, "left_semi")
    # Repeated rows of a winner: these two columns are already together.
    return kept.dropDuplicates([fp, key]).drop(fp)


def hexadecimal(fp):
    """The 64 bits as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
