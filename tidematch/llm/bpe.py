"""Byte-pair encoding and decoding with a public vocabulary.

The vocabulary, its normaliser and its word splitter come from a tokenizer
file; the merges are made here. The new words of a partition are laid out in one
array of symbols. An index maps each mergeable pair to all its positions in that
array, a heap holds the ranks that occur, and the ranks are applied in ascending
order, each to all its positions at once; a merge enters the pairs that it makes
into the index.

White space never lies inside a word of such a tokenizer, so a text is cut at
ASCII white space and each piece is encoded once per worker while it stays in a
bounded memory of pieces.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidematch.llm.common import map_batches
from tidematch.session import ship_package

#: Pieces in each of two memories of a worker, and bytes of pieces learned for
#: one; beyond either the older memory goes.
REMEMBERED = 250_000
REMEMBERED_BYTES = 16 << 20
#: Bytes of texts, about, whose pieces are looked up, and so pass one pair index, at once.
SLAB = 1 << 21
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: The byte alphabet spells bytes as characters below this code.
LETTERS = 512
PRINTABLE = re.compile(r"[!-~]+")


class PairIndex:
    """Merges words by rank over an index of pair positions."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.size = len(vocab) + 1
        self.inner = np.full(LETTERS, -1, np.int64)
        self.final = np.full(LETTERS, -1, np.int64)
        for token, number in vocab.items():
            if len(token) == 1:
                self.inner[ord(token)] = number
            if suffix and token.endswith(suffix) and len(token) == len(suffix) + 1:
                self.final[ord(token[0])] = number
        if not suffix:
            self.final = self.inner
        self.made = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64)
        keys = self.made[:, 0] * self.size + self.made[:, 1]
        self.keys, self.ranks = np.unique(keys, return_index=True)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of these pairs, -1 where the pair does not merge."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' token ids in a row, and where each word starts in it.

        Characters outside the vocabulary vanish.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        symbol = self.inner[chars]
        symbol[ends - 1] = self.final[chars[ends - 1]]
        word, symbol = word[symbol >= 0], symbol[symbol >= 0]
        total = len(symbol)
        place = np.arange(total)
        same = word[1:] == word[:-1] if total else np.zeros(0, bool)
        after = np.append(np.where(same, place[1:], -1), -1)
        before = np.append(-1, np.where(same, place[:-1], -1))[:total]
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            """Put the places of mergeable pairs into the index."""
            merges = ranks >= 0
            ranks, places = ranks[merges], places[merges]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = [0, *cuts.tolist(), len(ranks)]
            for k, r in enumerate(ranks[firsts[:-1]].tolist()):
                part = places[firsts[k] : firsts[k + 1]]
                if r in where:
                    where[r].append(part)
                else:
                    where[r] = [part]
                    heapq.heappush(active, r)

        first = np.flatnonzero(after[:total] >= 0)
        enter(self._rank(symbol[first], symbol[after[first]]), first)
        while active:
            r = heapq.heappop(active)
            found = where.pop(r)
            left, right, new = self.made[r]
            places = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            places = places[symbol[places] == left]
            nexts = after[places]
            fits = (nexts >= 0) & (symbol[nexts] == right)  # else an earlier merge took one
            places, nexts = places[fits], nexts[fits]
            if left == right:  # of overlapping pairs the first wins
                taken: set[int] = set()
                keep = []
                for p, q in zip(places.tolist(), nexts.tolist()):
                    keep.append(p not in taken)
                    if keep[-1]:
                        taken.add(q)
                places, nexts = places[keep], nexts[keep]
            if not len(places):
                continue
            symbol[places] = new
            symbol[nexts] = -1
            beyond = after[nexts]
            after[places] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = places[inside]
            earlier = before[places]
            started = earlier >= 0
            heads = np.concatenate([places[inside], earlier[started]])
            if len(heads):
                enter(self._rank(symbol[heads], symbol[after[heads]]), heads)
        kept = symbol >= 0
        counts = np.bincount(word[kept], minlength=len(words)) if total else np.zeros(len(words), int)
        return symbol[kept].astype("<u4"), np.append(0, np.cumsum(counts))


class Memory(dict):
    """Packed ids by piece, with an older memory from which what is met again
    moves over."""

    def __init__(self, old: dict):
        super().__init__()
        self.old = dict(old)

    def __missing__(self, piece: bytes) -> bytes:
        ids = self[piece] = self.old[piece]
        return ids


class Codec:
    """Texts to ids and back for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.index = PairIndex(model["vocab"], merges, model["end_of_word_suffix"] or "")
        tokenizer = Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.simple = _printable_splitter(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.known = Memory({})
        self.known_bytes = 0
        self.words: dict[str, bytes] = {}

    def _words(self, piece: str) -> list[str]:
        """Words of a text without special tokens, as the vocabulary spells them."""
        if self.simple and PRINTABLE.fullmatch(piece):
            return self.simple.findall(piece.lower())
        return [w for w, _ in self.split(self.normalize(piece)) if w]

    def _learn(self, pieces: list[bytes]) -> None:
        """Enter the ids of these pieces, packed, into the memory."""
        parts: list[list[str | bytes]] = []
        new: dict[str, None] = {}
        for piece in pieces:
            text = piece.decode()
            if "<" in text and self.special:
                found: list[str | bytes] = []
                for part in self.at_special.split(text):
                    if part in self.special:
                        found.append(np.array([self.special[part]], "<u4").tobytes())
                    elif part:
                        found += self._words(part)
            else:
                found = self._words(text)
            for word in found:
                if isinstance(word, str) and word not in self.words:
                    new[word] = None
            parts.append(found)
        if new:
            fresh = list(new)
            ids, starts = self.index.encode(fresh)
            packed, at = ids.tobytes(), (starts * 4).tolist()
            for k, word in enumerate(fresh):
                self.words[word] = packed[at[k] : at[k + 1]]
        words = self.words
        for piece, found in zip(pieces, parts):
            if len(found) == 1 and isinstance(found[0], str):
                self.known[piece] = words[found[0]]
            else:
                self.known[piece] = b"".join([words[w] if isinstance(w, str) else w for w in found])

    def _ids(self, pieces: list[bytes]) -> bytes:
        """Packed ids of these pieces in order."""
        lacking = set(pieces) - self.known.keys() - self.known.old.keys()
        if lacking:
            more = sum(map(len, lacking))
            if len(self.known) + len(lacking) > REMEMBERED or self.known_bytes + more > REMEMBERED_BYTES:
                self.known = Memory(self.known)
                self.known_bytes = 0
                self.words.clear()
                lacking = set(pieces) - self.known.old.keys()
                more = sum(map(len, lacking))
            self.known_bytes += more
            self._learn(list(lacking))
        return b"".join(map(self.known.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for run in _runs(texts):
            if len(run) == 1:
                out.append(b"".join([self._ids(slab.split()) for slab in _slabs(run[0])]))
            else:
                cut = [t.split() for t in run]  # bytes part at ASCII white space
                self._ids([p for pieces in cut for p in pieces])
                out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        return out


class Decoder:
    """Ids to text for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        names |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def decode(self, packed: bytes) -> str:
        """The tokens' strings with a space between, as a tokenizer without a decoder."""
        return " ".join(map(self.names.__getitem__, array("I", packed)))


def _printable_splitter(spec: dict) -> re.Pattern | None:
    """A pattern that gives the words of printable ASCII text in lower case,
    where the file splits by letters, digits and the rest; else None.

    The byte alphabet spells such characters as they are.
    """
    steps = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or len(splits) != 2:
        return None
    pattern = splits[0].get("pattern", {}).get("Regex", "")
    if "\\p{L}" not in pattern or "\\p{N}" not in pattern or splits[1]["use_regex"]:
        return None
    for name, plain in (("[^\\s\\p{L}\\p{N}]", "[^a-z0-9]"), ("\\p{L}", "a-z"), ("\\p{N}", "0-9")):
        pattern = pattern.replace(name, plain)
    return None if "\\" in pattern else re.compile(pattern)


def _runs(texts: list[str | None]):
    """Runs of texts in UTF-8, about ``SLAB`` bytes together; a longer one alone."""
    run: list[bytes] = []
    held = 0
    for text in texts:
        raw = (text or "").encode()
        if run and held + len(raw) > SLAB:
            yield run
            run, held = [], 0
        run.append(raw)
        held += len(raw)
    if run:
        yield run


def _slabs(raw: bytes):
    """A text in parts of about ``SLAB`` bytes that end before white space."""
    start = 0
    while start < len(raw):
        end = start + SLAB
        space = SPACE.search(raw, end) if end < len(raw) else None
        end = space.start() if space else len(raw)
        yield raw[start:end]
        start = end


_built: dict[tuple[type, str], Codec | Decoder] = {}


def built(kind: type, path: str):
    """This worker's codec or decoder for a file."""
    if (kind, path) not in _built:
        _built[kind, path] = kind(path)
    return _built[kind, path]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens long, ids binary) for every row of ``docs``.

    ``ids`` are packed as little-endian unsigned 32-bit integers. A null or
    empty text has no tokens. Rows are independent: repeated rows and null keys
    come back as they are; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def make():
        coder = built(Codec, path)

        def call(columns):
            packed = coder.encode(columns[1])
            return [(k, len(p) // 4, p) for k, p in zip(columns[0], packed)]

        return call

    kind = dict(docs.dtypes)[key]
    return map_batches(
        docs.select(F.col(key), F.col(text)),
        make,
        f"`{key}` {kind}, n_tokens long, ids binary",
    )


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids, decoded string) for rows that ``encode`` gave."""
    ship_package(encoded.sparkSession)

    def make():
        coder = built(Decoder, path)

        def call(columns):
            return [(k, n, p, coder.decode(p)) for k, n, p in zip(*columns)]

        return call

    kind = dict(encoded.dtypes)[key]
    return map_batches(
        encoded.select(key, "n_tokens", "ids"),
        make,
        f"`{key}` {kind}, n_tokens long, ids binary, decoded string",
    )


def recode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``decode`` gives for the rows of ``encode``, in one pass through one
    worker: (key, n_tokens, ids, decoded) for every row of ``docs``."""
    ship_package(docs.sparkSession)

    def make():
        coder, decoder = built(Codec, path), built(Decoder, path)

        def call(columns):
            packed = coder.encode(columns[1])
            return [(k, len(p) // 4, p, decoder.decode(p)) for k, p in zip(columns[0], packed)]

        return call

    kind = dict(docs.dtypes)[key]
    return map_batches(
        docs.select(F.col(key), F.col(text)),
        make,
        f"`{key}` {kind}, n_tokens long, ids binary, decoded string",
    )
