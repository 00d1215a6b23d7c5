import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tidematch.llm import quality

PROSE = "Some words that make a sentence of prose here. "


def by_hand(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(words) < 50 or 100 * len(inside) > 50 * len(words),
    }


TEXTS = ODD_TEXTS + [
    "a b c a b c a b c\na b c\n\na b c",
    "x y x y x y x y",
    " lead  and\ttail \x0b\x0c\r mixed # | <x> % ",
    "a b c d a b c d e a b c",
]


def test_measures_equal_a_plain_count(make_docs):
    docs = make_docs(TEXTS, extra=True)
    rows = quality.judge(docs).select("doc_id", "quality.*").collect()
    for r in rows:
        wanted = by_hand(TEXTS[r["doc_id"]])
        assert {k: r[k] for k in wanted} == wanted, TEXTS[r["doc_id"]]


@pytest.mark.parametrize(
    ("line", "passes"),
    [
        (PROSE, True),
        ("He said “stop!”", True),
        ("no end of a sentence", False),
        ("Home | About | News | Contact.", False),
        ("All rights reserved.", False),
        ("#%$& #%$& word.", False),
    ],
)
def test_lines(spark, line, passes):
    row = spark.createDataFrame([(line,)], "x string").select(quality.line_passes(F.col("x"))).first()
    assert row[0] is passes


def test_lines_go_before_the_document_is_judged(make_docs):
    different = "\n".join(f"Sentence number {i} has words like {i * 7} and {i * 11}." for i in range(12))
    menu = "\n".join(f"Home {i} | About {i} | News {i} | Shop {i}" for i in range(9))
    texts = [different, different + "\n" + menu, different + "\n" + menu * 4]
    rows = quality.judge(make_docs(texts)).select("doc_id", "quality.*").orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [True, True, False]
    assert rows[1]["clean"] == different and rows[1]["n_removed"] == 9


def test_empty_table_and_repeated_rows(odd_docs):
    assert quality.judge(odd_docs.limit(0)).count() == 0
    assert quality.judge(odd_docs).count() == len(ODD_TEXTS)
    again = quality.judge(quality.judge(odd_docs))
    assert again.columns.count("quality") == 1
