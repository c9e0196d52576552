"""Rows that the tests of this folder share."""

import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, digest int, tie string, node int, score string, `a.b` string, "
          "row string, kind string, value int, spans string, ids int, runs int, host string")


def make(spark, rows):
    """Documents from (doc_id, text) with extra columns whose names clash with those the operators use."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x", 1, "t", 2, "s", "ab", "r", "k", 3, "sp", 4, 5, "h") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [(1, "a b  c d e f"), (2, "a b c d\te f"), (3, None), (4, ""), (None, "a b c d e f"), (5, "x"), (5, "x"), (6, "long " * 30_000),
       (7, "É ñ 漢字 　 z"), (8, " \n\t "), (9, "A b c d e f g"), (10, "y" * 50_000), (11, None), (12, "\U0001f600 ok \x00 end")]


def words(text):
    """Lower-cased words as the contract takes them."""
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
