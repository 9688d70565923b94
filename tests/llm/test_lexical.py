"""Ranked search against scores of all pairs."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from clinloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id long, text string"


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    docs = [(i, words(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    N, L = len(docs), sum(len(t) for _, t in docs)
    out = []
    for item_id, text in set(items):
        terms = set(words(text))
        scores = []
        for i, t in docs:
            m = 100 - 90 + (90 * len(t) * N) // L
            score = 0
            for x in terms & set(t):
                df = sum(x in u for _, u in docs)
                score += math.floor(1000 * math.log((2 * N + 2) / (2 * df + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item_id, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=120):
    r = random.Random(seed)
    bag = ["The", "the", "of", "École", "a1", "x-y", "ÀB", "日本", "z", "Q", "rare" + str(seed)] + [f"w{i}" for i in range(60)]
    make = lambda most: r.choice([" ", ", ", "\n", "\x00"]).join(r.choices(bag, k=r.randint(1, most)))
    docs = [(i, make(40)) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, " .,;"), (None, "the of w1 w2"), (n + 3, "w3 " * 30_000)]
    docs += [(n + 10 + i, docs[3][1]) for i in range(30)] + [docs[4]] * 2  # ties and repeated rows
    items = [(i, make(12)) for i in range(40)] + [(40, None), (41, "..."), (42, "unseen"), (1, "w1 w2"), (2, docs[3][1])]
    items += [items[0]] + [(50 + i, docs[i][1]) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, None), (2, 60)])
def test_same_as_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(lexical, "BATCH_ROWS", 32)
    if block:
        monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    docs, items = corpus(seed)
    left = spark.createDataFrame([(*d, 1, "x") for d in docs], COLUMNS + ", score long, item string").repartition(5)
    right = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    got = sorted(map(tuple, lexical.op12(left, right).collect()), key=repr)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], COLUMNS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.op12(docs.limit(0), items).collect() == []
    assert lexical.op12(docs, items.limit(0)).collect() == []
    assert lexical.op12(docs.where("false").union(spark.createDataFrame([(2, None)], COLUMNS)), items).collect() == []


def test_bounds_prune_whole_batches():
    r = np.random.default_rng(5)
    weights = r.integers(500, 9000, 400)
    items = [(i, sorted(r.choice(400, 20, replace=False).tolist())) for i in range(64)]
    search = lexical.Search(lexical.plant_items(items, weights), 3)
    all_docs = []
    for batch in range(12):
        docs = [items[int(j)][1] if r.random() < 0.4 else r.choice(400, 20).tolist() for j in r.integers(0, 64, 64)]
        owner = np.repeat(np.arange(64), [len(set(d)) for d in docs])
        term = np.array([t for d in docs for t in sorted(set(d))])
        made = r.integers(1, 10**6 if batch < 3 else 10**4, len(term))  # later ones are poor
        search.add([batch * 64 + i for i in range(64)], owner, term, made)
        for i in range(64):
            all_docs.append((batch * 64 + i, dict(zip(term[owner == i].tolist(), made[owner == i].tolist(), strict=True))))
    for key, terms in items:
        scores = sorted((-sum(int(weights[t]) * d.get(t, 0) for t in terms), i) for i, d in all_docs)[:3]
        assert sorted((-s, i) for k, i, s in search.found() if k == key) == [(s, i) for s, i in scores]
    assert search.pairs < 0.4 * 64 * len(all_docs)  # all bounds and scores together are fewer than the pairs
