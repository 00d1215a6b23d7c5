"""Personal data in texts, also where it is disguised.

Identifiers are first looked for in the text as it stands. Then transducers
rewrite disguises one after the other: look-alike characters, letters between
digits, bracketed and spelled at and dot, spelled digits. Each of them gives the
rewritten text together with an alignment to its input. Identifiers found in the
last text are mapped back through the alignments to source characters; those
that touch a rewritten place are added, unless they cut into one found before.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame

from tidematch.llm.common import map_batches
from tidematch.llm.toplevel import TOP_LEVEL
from tidematch.session import ship_package

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# An address starts at the first digit of a run, as the leftmost match does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def find_plain(text: str) -> list[Span]:
    """(start, end, kind) of identifiers as they stand, per kind leftmost first
    and without overlap, in order of start and then of ``KINDS``."""
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done, "email"))
        at = text.find("@", at + 1)
    if not _ANY_DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


class Alignment:
    """Where a rewritten text's characters come from in its source."""

    def __init__(self, edits: list[tuple[int, int, str]]):
        self.new_starts: list[int] = []
        self.new_ends: list[int] = []
        self.edits = edits
        shift = 0
        for start, end, put in edits:
            self.new_starts.append(start + shift)
            self.new_ends.append(start + shift + len(put))
            shift += len(put) - (end - start)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a rewritten one; a span that enters a rewritten
        place takes the whole of it."""
        return self._point(start, False), self._point(end, True)

    def _point(self, at: int, is_end: bool) -> int:
        k = bisect_right(self.new_starts, at - is_end) - 1
        if k < 0:
            return at
        start, end, _ = self.edits[k]
        if at - is_end < self.new_ends[k]:
            return end if is_end else start
        return end + at - self.new_ends[k]


def rewrite(text: str, edits: list[tuple[int, int, str]]) -> tuple[str, Alignment]:
    """Apply edits that are in order and do not overlap."""
    parts, at = [], 0
    for start, end, put in edits:
        parts += (text[at:start], put)
        at = end
    parts.append(text[at:])
    return "".join(parts), Alignment(edits)


# ---- Fixed values: what look-alike characters stand for.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
    "ј": "j", "ԁ": "d", "һ": "h", "ɡ": "g", "ο": "o", "α": "a", "ν": "v", "ρ": "p", "ι": "i",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "Ο": "O", "․": ".", "。": ".", "•": ".", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
INVISIBLE = "­​‌‍⁠﻿"
AT_WORDS = ("at", "arroba", "arobase", "ät")
DOT_WORDS = ("dot", "punto", "punkt", "point")
#: A host that is spelled out must end in one of these.
HOST_ENDS = TOP_LEVEL | {"example", "test"}
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
# ---- End of fixed values.

_ODD = re.compile(
    f"[{''.join(map(re.escape, LOOK_ALIKES))}{INVISIBLE}"
    "٠-٩۰-۹०-९！-～\U0001d400-\U0001d7ff]"
)
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
_LETTER_IN_DIGITS = re.compile(
    r"(?<=[0-9])(?:[ ().-]?[OolI|]{1,2}(?=[ ().-]{0,2}[0-9])|[OolI|]{1,2}(?!\w))"
)
# White space outside the brackets is added by place: looked for from every blank of a
# long row of them, it would be read again and again.
_BRACKETED = re.compile(
    rf"[\[({{<]\s*(?:(@|{'|'.join(AT_WORDS)})|(\.|{'|'.join(DOT_WORDS)}))\s*[\])}}>]", re.I
)
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
# Names of any number of parts. One that no at follows is passed as a whole, so a
# long row of parts is read once; a match with group 1 is an address.
_SPELLED_MAIL = re.compile(
    rf"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9_%+-]*+(?:(?:\.|\s+(?:{_DOT})\s+)[A-Za-z0-9_%+-]++)*+"
    rf"((?:\s+(?:{_AT})\s+|\s*@\s*)[A-Za-z0-9-]+(?:(?:\.|\s+(?:{_DOT})\s+)[A-Za-z0-9-]+)+(?!\w))?",
    re.I,
)
_DOT_WORD = re.compile(rf"\s(?:{_DOT})\s", re.I)
_WORD_SIGN = re.compile(rf"\s+(?:({_AT})|({_DOT}))\s+|\s*(@)\s*", re.I)
_SPELLED_HOST = re.compile(rf"(?<![\w.])[0-9]{{1,3}}(?:(?:\s+(?:{_DOT})\s+|\.)[0-9]{{1,3}}){{3}}(?!\w|\.\w)", re.I)
_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED_DIGITS = re.compile(rf"(?<!\w)(?:{_DIGIT})(?:[ .,-]{{1,2}}(?:{_DIGIT}|[0-9]+)(?!\w)){{3,}}", re.I)
_SHORT = rf"(?:{_DIGIT}|[0-9]{{1,3}})(?:[ -](?:{_DIGIT}|[0-9])){{0,2}}"
_SPELLED_ADDRESS = re.compile(
    rf"(?<![\w.]){_SHORT}(?!\w)(?:(?:\s+(?:{_DOT})\s+|\.){_SHORT}(?!\w)){{3}}(?!\.\w|\s+(?:{_DOT})\s)", re.I
)
_ADDRESS_PART = re.compile(rf"\s+(?:{_DOT})\s+|({_DIGIT})(?!\w)|[ -](?=[0-9])|[ -](?=(?:{_DIGIT})(?!\w))", re.I)
_ONE_DIGIT = re.compile(rf"({_DIGIT})([ .,-]*)", re.I)
_PLUS_WORD = re.compile(rf"(?<!\w)plus\s+(?=[0-9]|(?:{_DIGIT})(?!\w))", re.I)


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    """Characters of other scripts and widths that pass for ASCII; invisible
    ones are taken out."""
    out: list[tuple[int, int, str]] = []
    if text.isascii():
        return out
    if not ("\xa0" in text or "\xad" in text or _BEYOND_LATIN.search(text)):
        return out
    for m in _ODD.finditer(text):
        c = m[0]
        put = "" if c in INVISIBLE else LOOK_ALIKES.get(c)
        if put is None:
            put = unicodedata.normalize("NFKC", c)
            if not put.isascii():
                put = str(unicodedata.digit(c, "")) or c
        out.append((m.start(), m.end(), put))
    return out


def letters_as_digits(text: str) -> list[tuple[int, int, str]]:
    """O and l between digits."""
    out: list[tuple[int, int, str]] = []
    if not _ANY_DIGIT.search(text):
        return out
    for m in _LETTER_IN_DIGITS.finditer(text):
        put = "".join("0" if c in "Oo" else "1" if c in "lI|" else c for c in m[0])
        out.append((m.start(), m.end(), put))
    return out


def bracketed_signs(text: str) -> list[tuple[int, int, str]]:
    """(at), [dot] and the like, with the white space around."""
    if not any(c in text for c in "[({<"):
        return []
    out: list[tuple[int, int, str]] = []
    for m in _BRACKETED.finditer(text):
        start, end = m.span()
        least = out[-1][1] if out else 0
        while start > least and text[start - 1].isspace():
            start -= 1
        while end < len(text) and text[end].isspace():
            end += 1
        out.append((start, end, "@" if m[1] else "."))
    return out


def spelled_signs(text: str) -> list[tuple[int, int, str]]:
    """at and dot as words, only inside what is an address or a host with a dot
    spelled out after its at."""
    out: list[tuple[int, int, str]] = []
    if not _DOT_WORD.search(text):
        return out
    for shape in (_SPELLED_MAIL, _SPELLED_HOST):
        for m in shape.finditer(text):
            if shape is _SPELLED_MAIL and not m[1]:
                continue
            signs = list(_WORD_SIGN.finditer(m[0]))
            if not signs or not signs[-1][2]:
                continue  # what follows the at is written plainly: prose
            if shape is _SPELLED_MAIL and m[0][signs[-1].end() :].lower() not in HOST_ENDS:
                continue
            for s in _WORD_SIGN.finditer(text, m.start(), m.end()):
                put = "." if s[2] else "@"
                if s[0] != put:
                    out.append((s.start(), s.end(), put))
    return _in_order(out)


def spelled_addresses(text: str) -> list[tuple[int, int, str]]:
    """Four short groups of digits, some as words, with dots between them as words."""
    out: list[tuple[int, int, str]] = []
    if not _DOT_WORD.search(text):
        return out
    for m in _SPELLED_ADDRESS.finditer(text):
        for p in _ADDRESS_PART.finditer(text, m.start(), m.end()):
            put = DIGIT_WORDS[p[1].lower()] if p[1] else "." if p[0].strip(" -") else ""
            out.append((p.start(), p.end(), put))
    return out


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of four or more digits, of which the first is a word; and plus before digits."""
    out = [(m.start(), m.end(), "+") for m in _PLUS_WORD.finditer(text)]
    for m in _SPELLED_DIGITS.finditer(text):
        at = m.start()
        while at < m.end():
            d = _ONE_DIGIT.match(text, at, m.end())
            if d:
                out.append((d.start(), d.end(2) if d.end(2) < m.end() else d.end(1), DIGIT_WORDS[d[1].lower()]))
                at = out[-1][1]
            else:
                at += 1
    return _in_order(out)


def _in_order(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    kept: list[tuple[int, int, str]] = []
    for e in sorted(edits):
        if not kept or e[0] >= kept[-1][1]:
            kept.append(e)
    return kept


TRANSDUCERS = (
    look_alikes,
    bracketed_signs,
    spelled_addresses,
    spelled_signs,
    spelled_digits,
    letters_as_digits,
)


def find_disguised(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that show after rewriting, as spans of ``text``."""
    now, alignments = text, []
    for transducer in TRANSDUCERS:
        edits = transducer(now)
        if edits:
            now, alignment = rewrite(now, edits)
            alignments.append(alignment)
    if not alignments:
        return []
    # Places of the last text that were rewritten, by its own offsets.
    added: list[Span] = []
    for start, end, kind in find_plain(now):
        touched = False
        a, b = start, end
        for alignment in reversed(alignments):
            k = bisect_right(alignment.new_starts, b - 1) - 1
            touched = touched or (k >= 0 and alignment.new_ends[k] >= a)
            a, b = alignment.back(a, b)
        if touched and a < b and not _overlaps(plain, a, b, kind):
            added.append((a, b, kind))
    return added


def _overlaps(plain: list[Span], start: int, end: int, kind: str) -> bool:
    """Whether a plain span takes part of this one. A plain span of its own kind
    wholly inside is the visible rest of a longer identifier, and doesn't."""
    return any(
        s < end and start < e and not (k == kind and start <= s and e <= end and (start, end) != (s, e))
        for s, e, k in plain
    )


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(spans as they stand, all spans) of a text, each in order of start."""
    if not text:
        return [], []
    plain = find_plain(text)
    more = find_disguised(text, plain)
    if not more:
        return plain, plain
    return plain, sorted(plain + more, key=lambda s: (s[0], KINDS.index(s[2])))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, plain, found) for every row: arrays of (start, end, kind) in code
    points, ends exclusive; ``plain`` as they stand, ``found`` with disguised ones.

    A null or empty text has none. Two kinds may overlap, for instance a card
    inside a phone number. Repeated rows and null keys come back as they are;
    other columns are not read.
    """
    ship_package(docs.sparkSession)

    def make():
        def call(columns):
            out = []
            for k, t in zip(*columns):
                plain, found = find(t)
                out.append((k, _records(plain), _records(found)))
            return out

        return call

    kind = dict(docs.dtypes)[key]
    span = "array<struct<start:bigint,end:bigint,kind:string>>"
    return map_batches(docs.select(key, text), make, f"`{key}` {kind}, plain {span}, found {span}")


def _records(found: list[Span]) -> list[dict]:
    return [{"start": s, "end": e, "kind": k} for s, e, k in found]
