"""Ranked search against a plain scorer in Python integers."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from duelist.llm import blocked_search as bs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score), documents as (doc_id, text) and items as (item_id, text)."""
    texts = [(d, Counter(plain_terms(t))) for d, t in docs]
    texts = [(d, c, sum(c.values())) for d, c in texts if c]
    n_docs, total = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    queries: dict = {}
    for i, t in dict.fromkeys(items):
        queries.setdefault(i, Counter()).update(plain_terms(t))
    out = []
    for i, wanted in queries.items():
        found = []
        for d, c, n in texts:
            m = 100 - 75 + 75 * n * n_docs // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in wanted.items() if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms():
    text = "Ab-cD_9Éé x\x7fZ{\U0001f600}\x00q\tq~"
    assert [t.decode() for t in bs.terms(text.encode())] == plain_terms(text)
    assert bs.terms(None) == [] == bs.terms(b" .,")


def corpus(rng, n):
    words = [f"w{k}" for k in range(60)] + ["the"] * 40 + ["Éa", "日本"]
    return [(k, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for k in range(n)]


@pytest.mark.parametrize("block", [7, 100_000])
def test_against_brute_force(spark, block):
    rng = random.Random(5)
    docs = corpus(rng, 400)
    docs += [(d + 1000, t) for d, t in docs[:50]] + docs[:20]  # ties and repeated rows
    docs += [(None, docs[3][1]), (None, docs[4][1]), (7, "w1 w2 other"), (5000, None), (5001, ""), (5002, ".,;"), (5003, "w1 " * 20_000)]
    items = [(k, " ".join(rng.choices([f"w{j}" for j in range(80)] + ["Éa"], k=rng.randint(1, 12)))) for k in range(30)]
    items += [(40, "the the THE w1"), (40, "the the THE w1"), (41, "w2"), (41, "w3 w2"), (None, "w5 w6"), (42, None), (43, ""), (44, "absent")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS ids", "3 AS item", "4 AS score").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS times", "3 AS doc_id", "4 AS rank")
    assert result(bs.search(d, i, block_entries=block)) == brute(docs, items)
    assert result(bs.search(d, i, k=3, block_entries=block)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("text IS NULL"), items)):
        found = bs.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    assert result(bs.search(docs, items)) == brute([(1, "a b")], [(1, "a")])


def test_tiles_add_up_whatever_their_size():
    """Items with more terms than a tile holds, and weights that reach the bound of exact sums."""
    rng = random.Random(2)
    entries = [(i, t, rng.choice([1, 5, 40, 1 << 34])) for i in range(9) for t in rng.sample(range(50), rng.randint(1, 50))]
    want = np.zeros((9, 50), object)
    for i, t, w in entries:
        want[i, t] += w
    for tiles in (bs.item_tiles(entries, 50, 4, 8, 100_000_000), bs.item_tiles(entries, 50), bs.item_tiles(entries, 50, 2, 1000, 1 << 33)):
        got, done = np.zeros((9, 50), object), []
        for tile in tiles:
            for t in range(50):
                if tile.column[t] >= 0:
                    got[tile.items, t] += tile.weights[:, tile.column[t]].astype(np.int64)
            done += list(tile.items) if tile.last else []
        assert (got == want).all() and sorted(done) == list(range(9))
    assert max(t.weights.sum(axis=1).max() for t in bs.item_tiles(entries, 50)) * bs.MAX_IMPACT < 2**53


def test_best_keeps_ties_until_ids_are_compared():
    best = bs._Best(1, 2)
    best.offer(np.array([0]), np.array([[5, 5, 5]]), np.array([9, 8, 7]), np.array([False] * 3))
    best.offer(np.array([0]), np.array([[5, 5, 4]]), np.array([1, 0, 0]), np.array([False, True, False]))
    assert best.doc.tolist() == [1, 7] and best.score.tolist() == [5, 5]
