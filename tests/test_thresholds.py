"""Threshold curves against a loop over cases and thresholds."""

from __future__ import annotations

import random

from clinloom.operators import scoring

KIND = "case_id long, domain string, expected_decision string, expected_id long, raw_decision string, raw_id long, decision string, concept_id long, score double"


def test_curves_of_random_cases(spark):
    r = random.Random(5)
    grid = [0.9, 0.0, 0.5, 0.5, 0.75, 1.0]
    rows = []
    for i in range(300):
        raw, own = r.choice(["MAP", "MAP", "ABSTAIN"]), r.choice(["MAP", "ABSTAIN"])
        rows.append((i, r.choice(["a", "b", "c"]), r.choice(["MAP", "ABSTAIN"]), r.choice([1, 2, None]), raw, r.choice([1, 2, None]), own, r.choice([1, 2]), r.choice([None, 0.0, 0.5, 0.74, 0.75, 0.9, 1.0, 1.5])))
    df = spark.createDataFrame(rows, KIND)
    want = {}
    for domain in ("a", "b", "c"):
        for t in set(grid):
            own = [x for x in rows if x[1] == domain]
            took = [x[4] == "MAP" and (x[8] or 0.0) >= t for x in own]
            right = [x[5] is not None and x[5] == x[3] for x in own]
            yes = [x[2] == "MAP" for x in own]
            want[domain, t] = (len(own), sum(took), sum(y and a and z for y, a, z in zip(yes, took, right)), sum(not y and a for y, a in zip(yes, took)), sum(not y and not a for y, a in zip(yes, took)), sum(y and not a for y, a in zip(yes, took)))
    got = {(x.domain, x.threshold): (x.total, x.accepted, x.correct_map, x.false_map, x.correct_abstain, x.missed_map) for x in scoring.threshold_curve(df, grid, "domain").collect()}
    assert got == want
    for x in scoring.threshold_analysis(df, grid).collect():
        took = [y for y in rows if y[6] == "MAP" and (y[8] or 0.0) >= x.threshold]
        assert (x.admitted, x.correct) == (len(took), sum(y[7] == y[3] for y in took)) and x.incorrect == x.admitted - x.correct
    assert scoring.threshold_curve(df.limit(0), grid, "domain").collect() == []
