"""Admission of votes: rounds against the fold, and against a plain loop."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from clinloom.operators import governance


def plain(votes, key_of):
    places, actors, out = Counter(), set(), {}
    for review, decision, actor, _, day in sorted(votes, key=lambda v: (v[4], v[0])):
        key = key_of[decision]
        if places[key, decision] >= 2:
            out[review] = "TWO_REVIEWS_EXIST"
        elif (key, actor) in actors:
            out[review] = "SAME_PERSON"
        else:
            places[key, decision] += 1
            if actor is not None:
                actors.add((key, actor))
            out[review] = None
    return out


@pytest.mark.parametrize("seed,decisions,actors,n", [(1, 12, 9, 400), (2, 60, 200, 500), (3, 3, 3, 60), (4, 1, 40, 80)])
def test_rounds_give_what_the_fold_gives(spark, seed, decisions, actors, n):
    r = random.Random(seed)
    key_of = {d: r.choice(["hot", "hot", "a", "b"]) for d in range(decisions)}
    votes = [(i, r.randrange(decisions), r.choice([None] + list(range(actors))), r.choice(["APPROVE", "REJECT"]), date(2020, 1, 1) + timedelta(r.randint(0, 30))) for i in r.sample(range(10 * n), n)]
    d = spark.createDataFrame([(k, v, 9_999, "PENDING", True) for k, v in key_of.items()], "decision_id long, semantic_key string, proposer long, status string, eligible boolean")
    v = spark.createDataFrame(votes, "review_id long, decision_id long, actor long, verdict string, submitted_at date").repartition(5)
    want = plain(votes, key_of)
    for folded in (governance.FOLDED_VOTES, 40, 0):
        kept, refused = governance.admit_reviews(d, v, folded)
        got = {x.review_id: None for x in kept.collect()} | {x.review_id: x.reason for x in refused.collect()}
        assert got == want


def test_a_chain_of_votes_ends(spark):
    """Each vote conflicts with the next, by actor and by decision in turns."""
    votes = [(i, (i + 1) // 2, i // 2, "APPROVE", date(2020, 1, 1) + timedelta(i)) for i in range(24)]
    key_of = dict.fromkeys(range(20), "hot")
    d = spark.createDataFrame([(k, v, 9_999, "PENDING", True) for k, v in key_of.items()], "decision_id long, semantic_key string, proposer long, status string, eligible boolean")
    v = spark.createDataFrame(votes, "review_id long, decision_id long, actor long, verdict string, submitted_at date")
    kept, refused = governance.admit_reviews(d, v, 0)
    got = {x.review_id: None for x in kept.collect()} | {x.review_id: x.reason for x in refused.collect()}
    assert got == plain(votes, key_of)
    none = governance.admit_reviews(d, v.limit(0), 0)
    assert none[0].collect() == none[1].collect() == []
