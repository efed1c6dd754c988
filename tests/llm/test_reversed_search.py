"""Ranked search against a plain computation over all pairs of documents and items."""

import math
import re
from collections import Counter

import numpy as np

from posterion.llm import queries, reversed_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) by the definitions alone, in Python integers."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for d, b, size in bags:
            m = 100 - 90 + (90 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10 ** 9 * b[w]) // (1000 * b[w] + 8 * m)) for w in set(terms(text)) if w in b)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_against_all_pairs(spark, data):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{data}/{n}.parquet").select(i, "text").collect()] for n, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows(queries.QUERIES["op13_reversed_search"](spark, data)) == brute(docs, items)


def test_blocks_of_items_change_nothing(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("documents", "benchmark"))
    few = items.limit(7).cache()
    assert rows(reversed_search.ranked(docs, few, 3, index_bytes=6000)) == rows(reversed_search.ranked(docs, few, 3))


def test_odd_rows(spark):
    texts = [(1, "a b a"), (1, "a b a"), (None, "a b a"), (3, None), (4, ""), (5, "...\x00"), (6, "ẞ İx A_b"), (7, "b " * 50_000), (8, "c"), (2, "a b a")]
    wanted = [(1, "A"), (1, "A"), (None, "b, c! ẞ"), (3, None), (4, " "), (5, "nowhere"), (6, "İx " * 3), (7, "a " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, score int")
    items = spark.createDataFrame([(i, t, 1) for i, t in wanted], "item_id long, text string, rank int")
    assert rows(reversed_search.ranked(docs, items, 3)) == brute(texts, wanted, 3)
    assert reversed_search.ranked(docs.filter("false"), items).count() == 0
    assert reversed_search.ranked(docs, items.filter("false")).count() == 0
    assert reversed_search.ranked(docs.filter("doc_id in (3, 4)"), items).count() == 0


def test_heaps_keep_the_best_of_many_pushes():
    r = np.random.default_rng(5)
    heaps, every = reversed_search.Heaps(4, 3), []
    for step in range(30):
        item, score, doc = r.integers(0, 4, 20), r.integers(1, 9, 20), np.arange(20) + 20 * step
        every += list(zip(item, score, doc))
        live = score >= heaps.floor[item]
        heaps.push(item[live], score[live], doc[live], np.zeros(live.sum(), bool))
    got = sorted(zip(*(a.tolist() for a in heaps.rows[:3])))
    assert got == sorted((i, s, d) for k in range(4) for i, s, d in sorted((e for e in every if e[0] == k), key=lambda e: (-e[1], e[2]))[:3])
