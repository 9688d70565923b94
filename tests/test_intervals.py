"""Interval joins and eras against plain loops, with a person that has most of the rows."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from clinloom.operators import derive, intervals, linkage, quality

DAY = date(2019, 11, 20)


def spans(r, n, reach, persons=(1, 1, 1, 1, 2, 3, None)):
    for i in range(n):
        start = r.choice([None] + [DAY + timedelta(r.randint(0, 900)) for _ in range(20)])
        end = r.choice([None, start, start and start - timedelta(3)] + [start and start + timedelta(r.randint(0, reach))] * 6)
        yield i, r.choice(persons), start, end


@pytest.mark.parametrize("seed", [1, 2])
def test_visits_that_cover_a_day(spark, seed):
    r = random.Random(seed)
    visits = list(spans(r, 60, 45)) + [(900, 1, DAY, DAY + timedelta(700)), (901, 2, DAY, DAY)]
    events = [(i, p, d, r.choice([None, None, None, 5, 900, 12345])) for i, p, d, _ in spans(r, 400, 0)]
    v = spark.createDataFrame(visits, "visit_id long, person_id long, start_date date, end_date date")
    e = spark.createDataFrame([(*x, 1, "x") for x in events], "event_id long, person_id long, start_date date, encounter_ref long, candidates int, only string")
    got = {x.event_id: x for x in linkage.link_visits(e, v).collect()}
    assert len(got) == len(events)
    for i, person, day, ref in events:
        if ref is None:
            cover = [x[0] for x in visits if person is not None and x[1] == person and day and x[2] and x[3] and x[2] <= day <= x[3]]
            reason = None if len(cover) == 1 else "AMBIGUOUS" if cover else "NO_COVERING_VISIT"
            assert (got[i].candidates, got[i].visit_id, got[i].reason) == (len(cover), cover[0] if len(cover) == 1 else None, reason)
    (out,) = quality.outside_period(e, v, "event").collect()
    assert out.n_violations == sum(not any(p is not None and x[1] == p and d and x[2] and x[3] and x[2] <= d <= x[3] for x in visits) for _, p, d, _ in events)


def eras_of(rows, gap):
    """By days: what a row covers, and eras where more than ``gap`` days in a row are free."""
    rows = sorted((s, max(s, e or s)) for s, e in rows)
    out = []
    for s, e in rows:
        if out and s <= out[-1][1] + timedelta(gap):
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] += 1
        else:
            out.append([s, e, 1, set()])
        out[-1][3].update(s + timedelta(k) for k in range((e - s).days + 1))
    return [(s, e, n, (e - s).days + 1 - len(days)) for s, e, n, days in out]


@pytest.mark.parametrize("seed,gap,reach", [(1, 30, 20), (2, 1, 3), (3, 0, 2), (4, 30, 500), (5, 400, 30)])
def test_eras_of_random_dates(spark, seed, gap, reach):
    r = random.Random(seed)
    rows = [(i, p, c, s, e) for (i, p, s, e), c in ((x, r.choice([7, 7, 8])) for x in spans(r, 300, reach, (1, 1, 1, 2))) if s]
    df = spark.createDataFrame(rows, "event_id long, person_id long, concept_id long, start_date date, end_date date").repartition(5)
    want = sorted((p, c, *era) for p in (1, 2) for c in (7, 8) for era in eras_of([(s, e) for _, q, k, s, e in rows if (q, k) == (p, c)], gap))
    eras = derive.condition_era(df, gap)
    assert sorted(tuple(x)[1:] for x in eras.collect()) == [x[:5] for x in want]
    ingredient = spark.createDataFrame([(7, "Ingredient"), (8, "Ingredient")], "concept_id long, concept_class_id string")
    same = spark.createDataFrame([(7, 7), (8, 8)], "ancestor_id long, descendant_id long")
    drugs = derive.drug_era(df, same, ingredient, gap)
    assert sorted(tuple(x)[1:] for x in drugs.collect()) == want
    found = {x.check_name: x.n for x in derive.drug_era_violations(df, drugs, same, ingredient).collect()}
    assert set(found.values()) == {0}
    # without the eras of one concept its rows are uncovered
    lost = {x.check_name: x.n for x in derive.era_violations(df, eras.where("concept_id <> 8")).collect()}
    assert lost["uncovered_event"] == sum(x[2] == 8 for x in rows)


def test_rows_inside_no_span(spark):
    r = random.Random(9)
    rows, wide = list(spans(r, 200, 60)), list(spans(r, 40, 200))
    kind = "event_id long, person_id long, start_date date, end_date date"
    got = intervals.inside_none(spark.createDataFrame(rows, kind), spark.createDataFrame(wide, kind), ["person_id"])
    want = [i for i, p, s, e in rows if not any(p is not None and p == q and s and e and a and b and a <= s and e <= b for _, q, a, b in wide)]
    assert sorted(x.event_id for x in got.collect()) == want
