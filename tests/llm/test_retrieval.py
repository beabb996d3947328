"""Ranked search against a plain count, with small blocks and tiles, and its defined results."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strataloom.llm import retrieval

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    holders = Counter(t for _, c in counted for t in c)
    out = []
    for name, text in items:
        scored = []
        for i, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(name, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def small(spark, monkeypatch):
    for name, value in {"BLOCK_TERMS": 40, "TILE_TERMS": 7, "TILE_ITEMS": 3, "TILE_DOCS": 4, "MERGED_TILES": 2, "MERGED_PARTS": 2}.items():
        monkeypatch.setattr(retrieval, name, value)


@pytest.mark.parametrize("tiles", ["small", "production"])
def test_search_equals_plain_counts(spark, monkeypatch, tiles):
    if tiles == "small":
        small(spark, monkeypatch)
    r = random.Random(3)
    vocabulary = ["the", "The", "été", "ÉTÉ", "x1", "9", "日本", "a_b", "naïve", *(f"w{k}" for k in range(60))]
    docs = [(r.randint(0, 60), " ,\t-".join(r.choices(vocabulary, k=r.randint(0, 40)))) for _ in range(80)]
    docs += [(100 + i, "w1 w2 w3") for i in range(20)] + [(7, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w9"), (8, None), (9, ""), (10, " .;\x00 ")]
    docs += [(11, "w5 " * 5000)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.randint(1, 12)))) for k in range(12)]
    items += [(3, "w1 w2"), (40, None), (41, "..."), (42, "unheard of"), (43, " ".join(vocabulary)), (None, "w1 W1 w1")]
    a = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, n long, terms string").repartition(6)
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int")
    got = sorted((tuple(x) for x in retrieval.search(a, b, k=9).collect()), key=str)
    assert got == brute(docs, items, 9)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one"), (2, "two")], "item_id long, text string")
    assert retrieval.search(docs, items.limit(0)).count() == 0
    assert retrieval.search(docs.limit(0), items).count() == 0
    assert [x["item_id"] for x in retrieval.search(docs, items).collect()] == [1]


def test_partial_sums_stay_exact():
    weights = np.full(5000, 43_000)
    tiles = retrieval._tiles([np.arange(5000), np.array([3, 7])], weights)
    assert all(10**6 * int(weights.max()) * len(part) < retrieval.EXACT for _, part in tiles)
    assert sorted(np.concatenate([p for own, p in tiles if 0 in own]).tolist()) == list(range(5000))
    heavy = retrieval._tiles([np.arange(10)], np.full(10, 4 * 10**9))
    assert all(len(part) * 4 * 10**15 < retrieval.EXACT for _, part in heavy)


def test_impacts_do_not_overflow():
    lengths = np.array([1, 10**7])
    got = retrieval.impacts(np.array([1, 5]), lengths, 10**12, 10**15)
    want = [10**9 * c // (1000 * c + 20 * (50 + 50 * int(n) * 10**12 // 10**15)) for c, n in zip((1, 5), lengths)]
    assert got.tolist() == want
