"""Quality rules that clean line by line and then judge what is left.

Everything is column expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import GAP, let

#: Least words of a document, and most of its words in repeated 3-word windows.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document goes when its removed lines hold more than this share of its characters.
MAX_LOST = 0.5
#: Separators that make a line a menu when there are so many of them.
MENU_SIGNS = 3
#: A line in which symbols are more than one character in ten is not prose.
SYMBOL_SHARE = 0.1

# ---- Fixed values: marks that end a sentence, menu separators, stock phrases.
# A sentence may be closed by quotes and brackets, and by blanks after them.
SENTENCE_ENDS = ".!?…。！？؟।:;"
CLOSING = "\"'”’»)]"
BLANK = " \t\n\x0b\f\r"
MENU = r"[|»›•·>]"
SYMBOL = r"[#*$%&|<>]"
SIGN = r"[#*$%&|<>»›•·]"
STOCK_PHRASES = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "accept cookies",
    "use of cookies",
    "enable javascript",
    "lorem ipsum",
    "skip to content",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "click here",
    "read more",
    "share this",
    "follow us",
    "powered by",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "tous droits réservés",
    "politique de confidentialité",
    "todos los derechos reservados",
    "política de privacidad",
)
# ---- End of fixed values.


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by a 64-bit hash. Where no two are equal, as in most texts,
    that is all. Else they are sorted, so that equal ones stand side by side; the
    places of those are sorted again, and each covers three words or as many as lie
    before the next place.
    """

    def windows(codes: Column) -> Column:
        return F.transform(
            F.slice(codes, F.lit(1), F.size(codes) - 2),
            lambda c, i: F.xxhash64(c, F.get(codes, i + 1), F.get(codes, i + 2)),
        )

    def places(found: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        kept = F.filter(
            found, lambda x, k: same(x, F.get(found, k - 1)) | same(x, F.get(found, k + 1))
        )
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(
                at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))
            ),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        )

    def counted(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            let(let(F.sort_array(placed), places), covered),
        ).otherwise(F.lit(0).cast("long"))

    def count(codes: Column) -> Column:
        return F.when(F.size(codes) > 3, let(windows(codes), counted)).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def removed_characters(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match a pattern of single characters."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def line_passes(line: Column) -> Column:
    """A line of prose: ends a sentence, is no menu, has no stock phrase, is not
    mostly symbols. The dearer tests come last."""
    last = F.right(F.rtrim(F.rtrim(line, F.lit(BLANK)), F.lit(CLOSING)), F.lit(1))

    def few_signs(length: Column) -> Column:
        menu_signs = length - F.length(F.regexp_replace(line, MENU, ""))
        symbols = length - F.length(F.regexp_replace(line, SYMBOL, ""))
        return (menu_signs < MENU_SIGNS) & (symbols <= length * SYMBOL_SHARE)

    def no_stock(low: Column) -> Column:
        stock = F.lit(False)
        for phrase in STOCK_PHRASES:
            stock = stock | F.contains(low, F.lit(phrase))
        return ~stock

    return (
        F.contains(F.lit(SENTENCE_ENDS), last)
        & (last != "")
        & (~line.rlike(SIGN) | few_signs(F.length(line)))
        & let(F.lower(line), no_stock)
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with measures and verdicts in the struct column ``quality``.

    Its fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_lines (those with a word), n_removed, lost (share of the
    lines' characters that the removed ones hold), clean (the text of the kept
    lines) and kept.

    A null or empty text, or one without a word, has zeros, no clean text and
    fails by its word count. The other columns are kept whatever their names,
    except one named ``quality``, which is replaced; repeated rows and ties need
    no rule, as each row stands alone.
    """
    given = F.coalesce(F.col(text), F.lit(""))

    def measures(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            removed_characters(given, SYMBOL + "+").alias("n_symbols"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    def cleaning(lines: Column) -> Column:
        def result(kept: Column) -> Column:
            chars = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.length(x))
            return F.struct(
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                (F.size(lines) - F.size(kept)).cast("long").alias("n_removed"),
                F.when(F.size(lines) == 0, F.lit(0.0))
                .otherwise(1 - chars(kept) / chars(lines))
                .alias("lost"),
                F.array_join(kept, "\n").alias("clean"),
            )

        return let(F.filter(lines, line_passes), result)

    inner = F.btrim(given, F.lit(BLANK))
    words = F.when(inner != "", F.split(inner, GAP)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(given, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = F.struct(
        let(words, measures).alias("m"), let(lines, cleaning).alias("c")
    )

    def verdict(x: Column) -> Column:
        m, c = x["m"], x["c"]
        failed = (m["n_words"] < MIN_WORDS) | (
            100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"]
        )
        return F.struct(
            m["n_words"].alias("n_words"),
            m["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            c["n_dup_lines"].alias("n_dup_lines"),
            m["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            c["n_lines"].alias("n_lines"),
            c["n_removed"].alias("n_removed"),
            c["lost"].alias("lost"),
            c["clean"].alias("clean"),
            (~failed & (c["lost"] <= MAX_LOST)).alias("kept"),
        )

    return docs.withColumn("quality", let(parts, verdict))


SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), tokens AS (
  SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w
), triples AS (
  SELECT doc_id, i, a, lead(a, 1) OVER s AS b, lead(a, 2) OVER s AS c
  FROM tokens WINDOW s AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM triples WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lined AS (
  SELECT doc_id, unnest(ls) AS l FROM w
), judged AS (
  SELECT doc_id, l,
    regexp_matches(l, '[.!?…。！？؟।:;]["''”’»)\]]*[\x20\x09-\x0D]*$')
    AND length(l) - length(regexp_replace(l, '[|»›•·>]', '', 'g')) < {MENU_SIGNS}
    AND length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g')) <= length(l) * {SYMBOL_SHARE}
    AND NOT ({" OR ".join(f"contains(lower(l), '{p}')" for p in STOCK_PHRASES)}) AS ok
  FROM lined
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (NOT ok) AS gone,
    1 - coalesce(sum(length(l)) FILTER (ok), 0)::DOUBLE / sum(length(l)) AS lost
  FROM judged GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lines.gone, 0)::BIGINT AS n_removed, coalesce(lines.lost, 0) AS lost
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
    AND lost <= {MAX_LOST} AS kept,
  n_removed
FROM m
"""
