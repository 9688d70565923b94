"""Registered queries: standardisation, linkage, eras, periods and cohorts over the clinical views."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinloom.operators import derive, linkage, standardise
from clinloom.plans.binding import Clinic, oracle
from clinloom.plans.registry import query

_SHARED = "event_id", "concept_id", "source_concept_id"


@query("c1", oracle("select event_id, concept_id, source_concept_id from condition", "condition"))
def c1(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.map_conditions(c.event, c.concept, c.relationship).select(*_SHARED)


@query("c2", oracle("select event_id, concept_id, source_concept_id from drug", "drug"))
def c2(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.map_drugs(c.event, c.concept, c.relationship).select(*_SHARED)


C3 = """
select m.event_id, coalesce(m.target_id, 0) as concept_id, coalesce(m.source_concept_id, 0) as source_concept_id,
  case when m.unit_code is not null then coalesce(u.concept_id, 0) end as unit_concept_id,
  case when m.value_code is not null then coalesce(x.to_id, 0) end as value_as_concept_id
from (select * from mapped_any where target_domain = 'Measurement' or target_id is null
      qualify row_number() over (partition by event_id order by case when target_domain = 'Measurement' then 0 else 1 end, target_id nulls last) = 1) m
left join concept u on u.vocabulary_id = 'UCUM' and u.concept_code = m.unit_code and u.standard_concept = 'S' and u.invalid_reason is null
left join concept v on v.vocabulary_id = 'PART' and v.concept_code = m.value_code
left join (select concept_id_1, min(concept_id_2) as to_id from relationship where relationship_id = 'Maps to' and invalid_reason is null group by 1) x on x.concept_id_1 = v.concept_id
"""


@query("c3", oracle(C3, "mapped_any"))
def c3(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.map_measurements(c.event, c.concept, c.relationship).select(*_SHARED, "unit_concept_id", "value_as_concept_id")


C4 = """
select event_id, coalesce(target_id, 0) as concept_id from mapped_any
where target_domain = 'Observation' or (target_id is null and resource_type = 'Observation'  and line_number = 1)
qualify row_number() over (partition by event_id order by case when target_domain = 'Observation' then 0 else 1 end, target_id nulls last) = 1
"""


@query("c4", oracle(C4, "mapped_any"))
def c4(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    # first lines carry no number here
    stg = c.event.withColumn("value", F.when(F.col("line_number") != 1, F.col("value")))
    return standardise.map_observations(stg, c.concept, c.relationship).select("event_id", "concept_id")


ROUTED = """select event_id, coalesce(target_id, 0) as concept_id, case when target_id is null then 'procedure_occurrence' when target_domain = 'Procedure' then 'procedure_occurrence'
 when target_domain = 'Measurement' then 'measurement' when target_domain = 'Observation' then 'observation' when target_domain = 'Device' then 'device_exposure' end as target_table from mapped_any"""


@query("c5", oracle(f"select * from ({ROUTED}) where target_table is not null", "mapped_any"))
def c5(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.route_procedures(c.event, c.concept, c.relationship).select("event_id", "concept_id", "target_table")


@query("c6", oracle("select event_id, count(distinct target_id) as n_targets from mapped_any where target_id is not null group by 1 having count(distinct target_id) > 1", "mapped_any"))
def c6(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.ambiguous_targets(c.event, c.concept, c.relationship)


C7 = """select resource_type, event_id, target_id, target_domain from mapped_any where target_id is not null and target_domain not in ('Condition', 'Observation', 'Measurement', 'Procedure')
qualify row_number() over (partition by resource_type, event_id order by target_id) = 1"""


@query("c7", oracle(C7, "mapped_any"))
def c7(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.unsupported_routes(c.event, c.concept, c.relationship, ("Condition", "Observation", "Measurement", "Procedure"))


C8 = "select e.event_id, e.unit_code, r.unit as expected_unit from event e join (select cast(p_partkey as varchar) as code, case when p_partkey % 4 = 0 then null else 'mg/dL' end as unit from part where p_partkey % 2 = 0) r on r.code = e.code where e.unit_code is distinct from r.unit"


def _rules(c):
    return c.raw("part").where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("code"), F.when(F.col("p_partkey") % 4 != 0, "mg/dL").alias("unit"))


@query("c8", oracle(C8, "event"))
def c8(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return standardise.unit_mismatch(c.event, _rules(c)).select("event_id", "unit_code", "expected_unit")


C9 = f"""with routed as ({ROUTED})
select distinct event_id from routed where target_table = 'measurement' and event_id in (select event_id from event where line_number <= 2)
 and event_id not in (select event_id from event where line_number = 2)"""


@query("c9", oracle(C9, "mapped_any"))
def c9(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    routed = standardise.route_procedures(c.event, c.concept, c.relationship).where("target_table = 'measurement'")
    return standardise.routing_collisions(c.event.where("line_number <= 2"), routed, c.event.where("line_number = 2"))


@query("c10", oracle("select event_id, vocabulary_id, code from event where event_id in (select event_id from condition where concept_id <> 0)", "condition"))
def c10(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    published = standardise.map_conditions(c.event, c.concept, c.relationship).where("concept_id <> 0")
    return standardise.source_codings(c.event, published)


C11 = "select c.event_id, c.concept_id, e.vocabulary_id, e.code, 'VOCABULARY' as mapping_method, 'run-1' as run_id from condition c join event e using (event_id) where c.concept_id <> 0"


@query("c11", oracle(C11, "condition"))
def c11(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    mapped = standardise.map_conditions(c.event, c.concept, c.relationship)
    return standardise.provenance(mapped, standardise.source_codings(c.event, mapped), "run-1")


C12 = """with by_event as (select event_id, min(c.concept_id) as a from condition d join concept c on c.concept_id = 2000000 + (d.person_id % 25 + 1) * 10 where d.person_id % 5 = 0 and c.standard_concept = 'S' and c.domain_id = 'Condition' group by 1),
by_term as (select code, min(c.concept_id) as a from (select distinct cast(p_partkey as varchar) as code, 2000000 + (p_partkey % 25 + 1) * 10 as approved from part) t join concept c on c.concept_id = t.approved where c.standard_concept = 'S' and c.domain_id = 'Condition' group by 1)
select d.event_id, case when d.concept_id = 0 then coalesce(e.a, t.a, 0) else d.concept_id end as concept_id from condition d left join by_event e using (event_id) left join by_term t using (code)"""


@query("c12", oracle(C12, "condition"))
def c12(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    events = standardise.map_conditions(c.event, c.concept, c.relationship).select("event_id", "person_id", "vocabulary_id", "code", "concept_id")
    by_event = events.where("person_id % 5 = 0").select("event_id", (2000000 + (F.col("person_id") % 25 + 1) * 10).alias("approved"))
    by_term = c.raw("part").select(F.lit("PART").alias("vocabulary_id"), F.col("p_partkey").cast("string").alias("code"), (2000000 + (F.col("p_partkey") % 25 + 1) * 10).alias("approved"))
    return standardise.apply_approved(events, by_term, by_event, c.concept, "Condition").select("event_id", "concept_id")


LINKED = """select event_id, visit_id, link_method, reason, candidates, case when reason is null then 'LINKED' else 'QUARANTINED' end as status from (
 select e.event_id, 'REFERENCE' as link_method, case when v.visit_id is null then 'REFERENCE_NOT_FOUND' when v.person_id <> e.person_id then 'REFERENCE_OTHER_PERSON'
   when not (e.start_date between v.start_date and v.end_date) then 'REFERENCE_OUTSIDE_DATE' end as reason, case when reason is null then v.visit_id end as visit_id, cast(case when reason is null then 1 else 0 end as bigint) as candidates
 from event e left join visit v on v.visit_id = e.encounter_ref where e.encounter_ref is not null
 union all by name
 select e.event_id, 'TEMPORAL' as link_method, case when t.n is null then 'NO_COVERING_VISIT' when t.n > 1 then 'AMBIGUOUS' end as reason, case when t.n = 1 then t.one end as visit_id, coalesce(t.n, 0) as candidates
 from event e left join (select e.event_id, count(*) as n, min(v.visit_id) as one from event e join visit v on v.person_id = e.person_id and e.start_date between v.start_date and v.end_date where e.encounter_ref is null group by 1) t using (event_id) where e.encounter_ref is null)"""


def _linked(c):
    return linkage.link_visits(c.event, c.visit)


@query("c13", oracle(LINKED, "event", "visit"))
def c13(spark, sf_dir):
    return _linked(Clinic(spark, sf_dir))


C14 = f"""with d as ({LINKED}), cur as (select event_id, 'OLD' as reason from event where line_number = 1)
select coalesce(n.event_id, cur.event_id) as event_id, coalesce(n.reason, cur.reason) as reason, n.event_id is not null as active from cur full join (select * from d where status = 'QUARANTINED') n on n.event_id = cur.event_id"""


@query("c14", oracle(C14, "event", "visit"))
def c14(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return linkage.linkage_quarantine(_linked(c), c.event.where("line_number = 1").select("event_id", F.lit("OLD").alias("reason")))


@query("c14_counts", oracle(f"select link_method, status, reason, count(*) as n from ({LINKED}) group by 1, 2, 3", "event", "visit"))
def c14_counts(spark, sf_dir):
    return linkage.linkage_counts(_linked(Clinic(spark, sf_dir)))


C16 = "select event_id, concept_id from condition where concept_id in (select descendant_id from ancestor where ancestor_id = 3000007)"


@query("c16", oracle(C16, "condition", "ancestor"))
def c16(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return derive.expand(standardise.map_conditions(c.event, c.concept, c.relationship), c.ancestor, 3000007).select("event_id", "concept_id")


_ERAS = """select person_id, {key}, start_date, greatest(start_date, end_date) as end_date, event_id,
   max(greatest(start_date, end_date)) over (partition by person_id, {key} order by start_date, greatest(start_date, end_date), event_id rows between unbounded preceding and 1 preceding) as reach from {rows}"""
_NUMBERED = "select *, sum(case when start_date > reach + 30 then 1 else 0 end) over (partition by person_id, {key} order by start_date, end_date, event_id rows unbounded preceding) as era from ({eras})"
_ID = "cast('0x' || substr(sha256('{name}|' || person_id || '|' || {key} || '|' || start_date), 1, 15) as bigint)"


def _numbered(key, rows):
    return _NUMBERED.format(key=key, eras=_ERAS.format(key=key, rows=rows))


CONDITION_ERAS = (
    f"select {_ID.format(name='condition', key='concept_id')} as era_id, * from (select person_id, concept_id, min(start_date) as start_date, max(end_date) as end_date, count(*) as occurrences"
    f" from ({_numbered('concept_id', '(select * from condition where concept_id <> 0)')}) group by person_id, concept_id, era)"
)


def _conditions(c):
    return standardise.map_conditions(c.event, c.concept, c.relationship)


@query("d1", oracle(CONDITION_ERAS, "condition"))
def d1(spark, sf_dir):
    return derive.condition_era(_conditions(Clinic(spark, sf_dir)))


_EXPOSED = "(select d.person_id, d.event_id, d.start_date, d.end_date, a.ancestor_id as ingredient_id from drug d join (select distinct ancestor_id, descendant_id from ancestor where ancestor_id in (select concept_id from concept where concept_class_id = 'Ingredient')) a on a.descendant_id = d.concept_id where d.concept_id <> 0)"
D2 = (
    f"select {_ID.format(name='drug', key='ingredient_id')} as era_id, * from (select person_id, ingredient_id, min(start_date) as start_date, max(end_date) as end_date, count(*) as exposures,"
    " cast(sum(case when reach is null or start_date > reach + 30 then 0 else greatest(date_diff('day', reach, start_date) - 1, 0) end) as bigint) as gap_days"
    f" from ({_numbered('ingredient_id', _EXPOSED)}) group by person_id, ingredient_id, era)"
)


@query("d2", oracle(D2, "drug", "ancestor", "concept"))
def d2(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return derive.drug_era(standardise.map_drugs(c.event, c.concept, c.relationship), c.ancestor, c.concept)


D3 = f"""with eras as ({CONDITION_ERAS})
select 'invalid_range' as check_name, count(*) filter (end_date < start_date) as n from eras union all select 'duplicate_id', count(era_id) - count(distinct era_id) from eras
union all select 'uncovered_event', count(*) from condition o where concept_id <> 0 and not exists (select 1 from eras e where e.person_id = o.person_id and e.concept_id = o.concept_id and o.start_date between e.start_date and e.end_date)"""


@query("d3", oracle(D3, "condition"))
def d3(spark, sf_dir):
    mapped = _conditions(Clinic(spark, sf_dir))
    return derive.era_violations(mapped, derive.condition_era(mapped))


# eras as D2 makes them, some left out, turned or doubled, and ancestors without some ingredients
D3D = f"""with eras as (select era_id, person_id, ingredient_id, start_date, case when person_id % 11 = 0 then start_date - 1 else end_date end as end_date, case when person_id % 17 = 0 then -1 else gap_days end as gap_days from ({D2}) d, (select unnest([0, 1]) as again) where ingredient_id % 5 <> 0 and (again = 0 or person_id % 13 = 0)),
anc as (select * from ancestor where ancestor_id % 7 <> 0), pairs as (select * from {_EXPOSED.replace("from ancestor where", "from anc where")})
select 'invalid_range' as check_name, count(*) filter (end_date < start_date or gap_days < 0) as n from eras union all select 'duplicate_id', count(era_id) - count(distinct era_id) from eras
union all select 'no_ingredient', count(*) from drug where concept_id <> 0 and event_id not in (select event_id from pairs)
union all select 'uncovered_pair', count(*) from pairs p where not exists (select 1 from eras e where e.person_id = p.person_id and e.ingredient_id = p.ingredient_id and p.start_date >= e.start_date and greatest(p.start_date, coalesce(p.end_date, p.start_date)) <= e.end_date)"""


@query("d3_drug", oracle(D3D, "drug", "ancestor", "concept"))
def d3_drug(spark, sf_dir):
    c, person = Clinic(spark, sf_dir), F.col("person_id")
    drugs = standardise.map_drugs(c.event, c.concept, c.relationship)
    eras = derive.drug_era(drugs, c.ancestor, c.concept).where("ingredient_id % 5 <> 0")
    eras = eras.withColumns({"end_date": F.when(person % 11 == 0, F.date_sub("start_date", 1)).otherwise(F.col("end_date")), "gap_days": F.when(person % 17 == 0, -1).otherwise(F.col("gap_days"))})
    return derive.drug_era_violations(drugs, eras.unionByName(eras.where("person_id % 13 = 0")), c.ancestor.where("ancestor_id % 7 <> 0"), c.concept)


D4 = """select coalesce(v.person_id, e.person_id) as person_id, least(v.s, e.s) as start_date, greatest(v.f, e.f) as end_date,
 case when e.s is null then 'FHIR_ENCOUNTER_COVERAGE' when v.s is null then 'CLINICAL_EVENT_ENVELOPE' else 'ENCOUNTER_PLUS_EVENT_ENVELOPE' end as method
from (select person_id, min(start_date) as s, max(end_date) as f from visit where person_id % 5 <> 0 group by 1) v
full join (select person_id, min(s) as s, max(f) as f from (select person_id, start_date as s, end_date as f from condition union all select person_id, start_date, end_date from drug where concept_id <> 0
 union all select person_id, start_date, start_date from mapped_any where target_id is null or target_domain in ('Measurement', 'Observation', 'Procedure', 'Device')) where person_id % 7 <> 0 group by 1) e on v.person_id = e.person_id"""


def six_tables(c):
    """The events of every domain's table, as one standardisation gives them."""
    stg = c.event.withColumn("value", F.when(F.col("line_number") != 1, F.col("value")))
    routed = standardise.route_procedures(c.event, c.concept, c.relationship)
    return {
        "condition": _conditions(c),
        "drug": standardise.map_drugs(c.event, c.concept, c.relationship),
        "measurement": standardise.map_measurements(c.event, c.concept, c.relationship),
        "observation": standardise.map_observations(stg, c.concept, c.relationship),
        "procedure": routed.where("target_table = 'procedure_occurrence'"),
        "device": routed.where("target_table = 'device_exposure'"),
    }


def _periods(c):
    """Periods over all six tables; some persons are left without events, some without visits, so that each method occurs."""
    t = six_tables(c)
    spans = [t["condition"], t["drug"].where("concept_id <> 0")]
    points = [t[name].withColumn("end_date", F.col("start_date")) for name in ("measurement", "observation", "procedure", "device")]
    return derive.observation_period(c.visit.where("person_id % 5 <> 0"), [df.where("person_id % 7 <> 0") for df in spans + points])


_PERIOD_VIEWS = ("condition", "drug", "mapped_any", "visit")


@query("d4", oracle(D4, *_PERIOD_VIEWS))
def d4(spark, sf_dir):
    return _periods(Clinic(spark, sf_dir))


@query("d5", oracle(f"select round(avg(days) / 365.25, 6) as mean_years from (select person_id, sum(date_diff('day', start_date, end_date) + 1) as days from ({D4}) group by 1)", *_PERIOD_VIEWS))
def d5(spark, sf_dir):
    return derive.average_observation_years(_periods(Clinic(spark, sf_dir)))


@query("d6", oracle("select c.concept_id, c.n, concept_name from (select concept_id, count(*) as n from condition where concept_id <> 0 group by 1) c join concept using (concept_id) order by n desc, concept_id limit 5", "condition", "concept"))
def d6(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return derive.top_concepts(_conditions(c), c.concept)


D7 = "select a.ancestor_id as group_id, count(distinct c.person_id) as persons from condition c join (select distinct * from ancestor) a on a.descendant_id = c.concept_id where a.ancestor_id >= 3000000 group by 1"


@query("d7", oracle(D7, "condition", "ancestor"))
def d7(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    groups = c.concept.where("concept_class_id = 'Ingredient'").select(F.col("concept_id").alias("group_id"))
    return derive.phenotype_counts(_conditions(c), c.ancestor, groups)


D8 = """select count(*) as persons, count(*) filter (t.person_id is not null) as treated, round(cast(treated as double) / nullif(persons, 0), 6) as share
from (select distinct person_id from condition where concept_id in (select descendant_id from ancestor where ancestor_id = 3000002)) h
left join (select distinct person_id from drug where concept_id in (select descendant_id from ancestor where ancestor_id in (3000003, 3000004, 3000005))) t using (person_id)"""


@query("d8", oracle(D8, "condition", "drug", "ancestor"))
def d8(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return derive.cascade(_conditions(c), standardise.map_drugs(c.event, c.concept, c.relationship), c.ancestor, 3000002, [3000003, 3000004, 3000005])

