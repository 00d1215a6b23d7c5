import random
import re
import time

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_patterns(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_plain_spans_equal_the_patterns():
    rng = random.Random(5)
    bits = ["1", "23", "256", "4", "@", "a", ".", "..", "-", " ", "+", "(", ")", "x.y", "\n", "5555", "00", "é"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert pii.find_plain(text) == by_patterns(text), text


def added(text):
    plain, found = pii.find(text)
    assert set(plain) <= set(found)
    return [(kind, text[s:e]) for s, e, kind in found if (s, e, kind) not in plain]


def test_disguises_map_back_to_the_source():
    for text, kind, source in [
        ("write john.doe (at) example [dot] com now", "email", "john.doe (at) example [dot] com"),
        ("mail jane at example dot co dot uk please", "email", "jane at example dot co dot uk"),
        ("host 10[.]20[.]30[.]40 up", "ip", "10[.]20[.]30[.]40"),
        ("is 10 dot 1 dot 2 dot 3.", "ip", "10 dot 1 dot 2 dot 3"),
        ("see １９２．１６８．１．１ there", "ip", "１９２．１６８．１．１"),
        ("+1 (4l5) 555-2O1O x", "phone", "+1 (4l5) 555-2O1O"),
        ("plus one four one five five five five two six seven one now", "phone",
         "plus one four one five five five five two six seven one"),
        ("card ４１１１１１１１１１１１１１１１ ok", "card", "４１１１１１１１１１１１１１１１"),
        ("j​ohn@exa​mple.com", "email", "j​ohn@exa​mple.com"),
    ]:
        assert (kind, source) in added(text), text


def test_prose_stays_clean():
    for text in [
        "see you at example.com tomorrow",
        "meet me at the dot on the map",
        "one two three four five, five at three",
        "Élève à Zürich, naïve – 3 · 4",
        "",
    ]:
        assert added(text) == []


def test_long_texts_take_linear_time():
    pii.find("a" * 300_000 + "1" * 300_000 + "@" * 1000 + "<" * 100_000)


def test_rows(odd_docs):
    rows = pii.spans(odd_docs).collect()
    assert len(rows) == len(ODD_TEXTS) and all(r["found"] == [] for r in rows)
    assert pii.spans(odd_docs.limit(0)).count() == 0


def test_spelled_addresses_of_any_end_and_length():
    names = [f"jane at firm dot {end}" for end in ("kr", "gr", "tr", "za", "online", "me", "museum", "COM")]
    names.append("a dot b dot c dot d dot e dot f dot g at firm dot com")
    names.append("jane at a dot b dot c dot d dot e dot f dot g dot h dot com")
    for name in names:
        assert ("email", name) in added(f"write {name}, please"), name
    assert added("look at this dot nowhere") == []


def test_long_rows_of_spelled_parts_take_linear_time():
    for part in ("x dot ", "x.", "x at ", "x at y dot "):
        pii.find("say dot on " + part * 30_000)


def test_spelled_network_addresses():
    for text in (
        "one nine two dot one six eight dot zero dot one",
        "192 dot one six eight dot 0 dot 1",
        "one-nine-two dot 168 dot 0.one",
    ):
        assert added(f"host {text}, up") == [("ip", text)], text
    for text in ("one dot two dot three", "three dot nine nine nine dot one dot two"):
        assert all(kind != "ip" for kind, _ in added(text)), text


def test_long_white_space_takes_linear_time():
    began = time.time()
    for text in ("[x " + " " * 80_000, "[ " * 40_000, "a" + " " * 80_000 + "[at] b", "one" + " " * 80_000 + "dot two",
                 "joe" + " " * 80_000 + "at" + " " * 80_000 + "b dot com", "[" + " " * 80_000 + "at" + " " * 80_000):
        pii.find(text)
    assert time.time() - began < 3
