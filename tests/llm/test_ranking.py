"""Ranked search against the plain formula."""

import math
import random
import re

import pytest
from llm_rows import ODD, make

from tidemill.llm import ranking


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, top=20):
    docs = [(i, terms(t)) for i, t in docs]
    full = [t for _, t in docs if t]
    n, length = len(full), sum(map(len, full))
    df = {}
    for t in full:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for ident, t in docs:
            if t:
                m = 100 - 25 + (25 * len(t) * n) // length
                tf = {}
                for x in t:
                    tf[x] = tf.get(x, 0) + 1
                scores.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10 ** 9 * tf[x]) // (1000 * tf[x] + 12 * m)) for x in terms(text) if x in tf), ident))
        scores = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1]))
        out += [(item, k, ident, score) for k, (score, ident) in enumerate(scores[:top], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, top=20, parts=4):
    table = make(spark, items).withColumnRenamed("doc_id", "item_id")
    return sorted((tuple(r) for r in ranking.search(make(spark, docs).repartition(parts), table, top).collect()), key=str)


@pytest.mark.parametrize("top", [1, 20])
def test_odd_rows(spark, top):
    items = [(1, "a b c"), (1, "a b c"), (None, "X x LONG"), (3, None), (4, ""), (5, "É 漢字 ok y"), (6, "absent"), (7, "... !"), (8, "long " * 5000 + "a")]
    assert found(spark, ODD, items, top) == plain(ODD, items, top)


def test_no_rows(spark, none):
    assert ranking.search(none, make(spark, [(1, "a")]).withColumnRenamed("doc_id", "item_id")).count() == 0
    assert ranking.search(make(spark, ODD), none.withColumnRenamed("doc_id", "item_id")).count() == 0


@pytest.mark.parametrize("blocks", [1, 4])
def test_against_the_formula(spark, monkeypatch, blocks):
    """Frequent and rare words, many copies of one text, passages in long texts, and scores that tie."""
    monkeypatch.setattr(ranking, "QUERIES", -(-24 // blocks))
    monkeypatch.setattr(ranking, "HEAD", 16)
    monkeypatch.setattr(ranking, "GROWTH", 4)
    rng = random.Random(11)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(24)]
    docs = [(i, " ".join(word() for _ in range(int(rng.paretovariate(1.0) * 10) % 900))) for i in range(1500)]
    docs += [(2000 + i, items[3][1]) for i in range(300)]
    docs += [(3000 + i, docs[i][1] + " " + items[i % 24][1]) for i in range(60)]
    rng.shuffle(docs)
    assert found(spark, docs, items) == plain(docs, items)
