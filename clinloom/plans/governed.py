"""Registered queries: governance. Decisions are orders, votes are their lines."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clinloom.operators import governance
from clinloom.plans.binding import Clinic
from clinloom.plans.registry import query

DEC = """dec as (select o_orderkey as decision_id, lower(o_orderpriority) || '-' || (o_custkey % 400) || '-' || (o_orderkey % 5) as semantic_key, case o_orderkey % 2 when 0 then 'condition' else 'drug' end as target_table, o_orderpriority as source_value,
 3000000 + o_orderkey % 30 as concept_id, 'run-' || (o_orderkey % 7) as run_id, o_custkey % 50 as proposer, case o_orderstatus when 'P' then 'PENDING' when 'O' then 'LOW_CONFIDENCE' else 'REJECTED' end as status, o_orderkey % 11 <> 0 as eligible, cast(o_orderdate as date) as proposed_at from orders)"""
REV = """rev as (select cast('0x' || substr(sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 15) as bigint) as review_id, l_orderkey as decision_id, l_suppkey % 40 as actor, case when l_returnflag = 'R' then 'REJECT' else 'APPROVE' end as verdict, cast(l_shipdate as date) as submitted_at
 from lineitem where l_linenumber <= 3)"""


def _sql(body):
    return f"with {DEC}, {REV}{body if body.startswith(',') else ' ' + body}"


def _decisions(c):
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return c.raw("orders").select(
        key.alias("decision_id"),
        F.concat_ws("-", F.lower("o_orderpriority"), (F.col("o_custkey") % 400).cast("string"), (key % 5).cast("string")).alias("semantic_key"),
        F.when(key % 2 == 0, "condition").otherwise("drug").alias("target_table"),
        F.col("o_orderpriority").alias("source_value"),
        (3000000 + key % 30).alias("concept_id"),
        F.concat(F.lit("run-"), (key % 7).cast("string")).alias("run_id"),
        (F.col("o_custkey") % 50).alias("proposer"),
        F.when(status == "P", "PENDING").when(status == "O", "LOW_CONFIDENCE").otherwise("REJECTED").alias("status"),
        (key % 11 != 0).alias("eligible"),
        F.to_date("o_orderdate").alias("proposed_at"),
    )


def _reviews(c):
    verdict = F.when(F.col("l_returnflag") == "R", "REJECT").otherwise("APPROVE")
    from clinloom.functions.ids import hash_id

    rid = hash_id(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return c.raw("lineitem").where("l_linenumber <= 3").select(rid.alias("review_id"), F.col("l_orderkey").alias("decision_id"), (F.col("l_suppkey") % 40).alias("actor"), verdict.alias("verdict"), F.to_date("l_shipdate").alias("submitted_at"))


# votes in order, each key's next one judged by what it has admitted so far
ADMITTED = """, known as (select review_id, decision_id, actor, verdict, submitted_at, d.semantic_key, case when d.semantic_key is null then 'UNKNOWN_DECISION' when not eligible then 'NOT_PUBLISHABLE' when status not in ('PENDING', 'LOW_CONFIDENCE') then 'NOT_REVIEWABLE' when proposer = actor then 'OWN_PROPOSAL' end as early
 from rev left join dec d using (decision_id)),
numbered as (select *, row_number() over (partition by semantic_key order by submitted_at, review_id) as n from known where early is null),
steps as (select semantic_key, n, review_id, case when true then null::varchar end as reason, [decision_id] as decisions, [actor] as actors from numbered where n = 1
 union all select v.semantic_key, v.n, v.review_id, case when len(list_filter(s.decisions, lambda x: x = v.decision_id)) >= 2 then 'TWO_REVIEWS_EXIST' when list_contains(s.actors, v.actor) then 'SAME_PERSON' end as why,
 case when why is null then list_append(s.decisions, v.decision_id) else s.decisions end, case when why is null then list_append(s.actors, v.actor) else s.actors end from steps s join numbered v on v.semantic_key = s.semantic_key and v.n = s.n + 1)"""


def _recursive(body):
    return _sql(ADMITTED + " " + body).replace("with ", "with recursive ", 1)


@query("f1", _recursive("select k.review_id, k.decision_id, k.actor, k.verdict, k.submitted_at from known k join steps s using (review_id) where s.reason is null"))
def f1(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.admit_reviews(_decisions(c), _reviews(c))[0]


@query("f1_rejected", _recursive("select coalesce(k.early, s.reason) as reason, count(*) as n from known k left join steps s using (review_id) where coalesce(k.early, s.reason) is not null group by 1"))
def f1_rejected(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.admit_reviews(_decisions(c), _reviews(c))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("f2", _sql("select review_id, row_number() over (partition by actor, semantic_key order by submitted_at, review_id) = 1 as active from rev join dec using (decision_id)"))
def f2(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.dedupe_votes(_reviews(c), _decisions(c))


_CANON = "(select *, row_number() over (partition by semantic_key order by n_reviews desc, proposed_at, decision_id) as rk from (select d.*, coalesce(r.n, 0) as n_reviews from dec d left join (select decision_id, count(distinct review_id) as n from rev group by 1) r using (decision_id) where status = 'PENDING' and eligible{more}) qualify rk = 1)"
F3 = f"""select decision_id, run_id, source_value, concept_id, n_reviews from {_CANON.format(more=" and run_id = 'run-3'")} d where n_reviews < 2 and proposer <> 7 and semantic_key not in (select semantic_key from rev join dec using (decision_id) where actor = 7)
 and not exists (select 1 from dec p where p.semantic_key = d.semantic_key and p.run_id <> d.run_id and (p.proposed_at < d.proposed_at or (p.proposed_at = d.proposed_at and p.decision_id < d.decision_id)))"""


@query("f3", _sql(F3))
def f3(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.review_queue(_decisions(c), _reviews(c), 7, "run-3", True)


@query("f4", _sql(f"select count(*) filter (n_reviews < 2) as ready, count(*) filter (n_reviews >= 2) as ready_to_adjudicate, (select count(distinct semantic_key) from dec where status = 'LOW_CONFIDENCE' and eligible) as low_confidence from {_CANON.format(more='')}"))
def f4(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.queue_metrics(_decisions(c), _reviews(c))


@query("f5", _sql(f"select decision_id, concept_id, n_reviews from {_CANON.format(more='')} where n_reviews >= 2 and proposer <> 7 and decision_id not in (select decision_id from rev where actor = 7)"))
def f5(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.adjudication_queue(_decisions(c), _reviews(c), 7)


@query("f6", _sql("select run_id, max(proposed_at) as last_proposed, count(*) as n from dec where status = 'PENDING' and eligible group by 1"))
def f6(spark, sf_dir):
    return governance.reviewable_runs(_decisions(Clinic(spark, sf_dir)))


F7 = """, two as (select decision_id, max(case when k = 1 then verdict end) as a, max(case when k = 2 then verdict end) as b from (select *, row_number() over (partition by decision_id order by submitted_at, review_id) as k from rev) where k <= 2 group by 1),
pairs as (select a, b, unnest(['ALL', target_table]) as domain from two join dec using (decision_id) where b is not null),
s as (select domain, count(*) as n, count(*) filter (a = b) as same, count(*) filter (a = 'APPROVE') as ya, count(*) filter (b = 'APPROVE') as yb from pairs group by 1)
select domain, n as pairs, round(same / n, 6) as raw_agreement, round((same / n - (ya * yb + (n - ya) * (n - yb)) / (n * n)) / nullif(1 - (ya * yb + (n - ya) * (n - yb)) / (n * n), 0), 6) as kappa, ya + yb as approve_votes, 2 * n - ya - yb as reject_votes from s"""


@query("f7", _sql(F7))
def f7(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    return governance.agreement(_reviews(c), _decisions(c))


_CUR = "(select distinct 3000000 + cast(substr(p_brand, 7) as bigint) as concept_id from part)"
ADJ = f"""acts as (select o_orderkey as action_id, o_orderkey as decision_id, o_custkey % 60 as actor, case when o_orderkey % 3 = 0 then 'REJECT' else 'APPROVE' end as verdict from orders),
judged as (select a.*, d.semantic_key, d.concept_id, case when d.proposer = a.actor then 'OWN_PROPOSAL' when coalesce(len(v.who), 0) <> 2 or v.n <> 2 then 'NEEDS_TWO_REVIEWS' when list_contains(v.who, a.actor) then 'NOT_DISTINCT'
  when d.status = 'REJECTED' then 'NOT_PENDING' when a.verdict = 'APPROVE' and d.concept_id not in (select concept_id from {_CUR}) then 'CONCEPT_NOT_CURRENT' end as reason
 from acts a join dec d using (decision_id) left join (select decision_id, list(distinct actor) as who, count(*) as n from rev group by 1) v using (decision_id)),
settled as (select *, row_number() over (partition by semantic_key order by action_id) as k from judged where reason is null),
accepted as (select action_id, decision_id, semantic_key, concept_id, case verdict when 'APPROVE' then 'APPROVED' else 'REJECTED' end as status from settled where k = 1)"""


def _adjudicated(c):
    key = F.col("o_orderkey")
    actions = c.raw("orders").select(key.alias("action_id"), key.alias("decision_id"), (F.col("o_custkey") % 60).alias("actor"), F.when(key % 3 == 0, "REJECT").otherwise("APPROVE").alias("verdict"))
    return governance.adjudicate(_decisions(c), _reviews(c), actions, c.concept)


@query("f8", _sql(f", {ADJ} select * from accepted"))
def f8(spark, sf_dir):
    return _adjudicated(Clinic(spark, sf_dir))[0]


@query("f8_rejected", _sql(f", {ADJ} select action_id, decision_id, reason from judged where reason is not null union all select action_id, decision_id, 'ALREADY_SETTLED' from settled where k > 1"))
def f8_rejected(spark, sf_dir):
    return _adjudicated(Clinic(spark, sf_dir))[1]


def _published(c):
    decisions = _decisions(c)
    code_map = decisions.where("decision_id % 4 = 0").groupBy("semantic_key").agg(F.min("concept_id").alias("concept_id"))
    return governance.publish_decisions(_adjudicated(c)[0], decisions, code_map)


@query("f9", _sql(f", {ADJ} select d.decision_id, coalesce(a.status, case when (d.semantic_key, d.concept_id) in (select (semantic_key, concept_id) from accepted) and d.status in ('PENDING', 'LOW_CONFIDENCE') then 'SUPERSEDED' end, d.status) as status from dec d left join accepted a using (decision_id)"))
def f9(spark, sf_dir):
    return _published(Clinic(spark, sf_dir))[0].select("decision_id", "status")


F9M = f""", {ADJ}, old as (select semantic_key, min(concept_id) as concept_id from dec where decision_id % 4 = 0 group by 1)
select semantic_key, concept_id from accepted where status = 'APPROVED' union all select * from old where semantic_key not in (select semantic_key from accepted where status = 'APPROVED') and not exists (select 1 from accepted a where a.status = 'REJECTED' and a.semantic_key = old.semantic_key and a.concept_id = old.concept_id)"""


@query("f9_map", _sql(F9M))
def f9_map(spark, sf_dir):
    return _published(Clinic(spark, sf_dir))[1]


_APPROVED = "oldset as (select semantic_key, max(concept_id) as concept_id, max(decision_id) as decision_id, true as active from dec where decision_id % 3 = 0 group by 1), oldpol as (select distinct semantic_key, concept_id, true as active from dec where decision_id % 4 <> 1)"


def _policies(c):
    d, on = _decisions(c), F.lit(True).alias("active")
    approved = d.where("decision_id % 3 = 0").groupBy("semantic_key").agg(F.max("concept_id").alias("concept_id"), F.max("decision_id").alias("decision_id")).select("*", on)
    return governance.publish_policies(_adjudicated(c)[0], approved, d.where("decision_id % 4 <> 1").select("semantic_key", "concept_id").distinct().select("*", on))


F9A = f""", {ADJ}, {_APPROVED} select semantic_key, concept_id, decision_id, not exists (select 1 from accepted a where a.status = 'REJECTED' and a.semantic_key = oldset.semantic_key and a.concept_id = oldset.concept_id) as active
 from oldset where semantic_key not in (select semantic_key from accepted where status = 'APPROVED') union all select semantic_key, concept_id, decision_id, true from accepted where status = 'APPROVED'"""


@query("f9_approved", _sql(F9A))
def f9_approved(spark, sf_dir):
    return _policies(Clinic(spark, sf_dir))[0]


F9P = f""", {ADJ}, {_APPROVED} select semantic_key, concept_id, bool_or(coalesce(a.status, 'REJECTED') <> 'APPROVED') as active from oldpol full join accepted a using (semantic_key, concept_id)
 where oldpol.active or a.status = 'REJECTED' group by 1, 2"""


@query("f9_policies", _sql(F9P))
def f9_policies(spark, sf_dir):
    return _policies(Clinic(spark, sf_dir))[1]


F9V = f""", {ADJ}, prov as (select o_orderkey as decision_id, case o_custkey % 4 when 0 then 'Pending_Human_Review' when 1 then 'Below_Confidence_Threshold' when 2 then 'REJECTED_BY_POLICY' else 'Auto' end as reviewed_by from orders)
select p.decision_id, case when reviewed_by = 'Auto' then reviewed_by when a.status = 'APPROVED' then 'Approved_by_Human' when a.status = 'REJECTED' then 'Rejected_by_Human'
 when d.status in ('PENDING', 'LOW_CONFIDENCE') and (d.semantic_key, d.concept_id) in (select (semantic_key, concept_id) from accepted) then 'Superseded_By_Canonical_Decision' else reviewed_by end as reviewed_by
from prov p join dec d using (decision_id) left join accepted a using (decision_id)"""


@query("f9_provenance", _sql(F9V))
def f9_provenance(spark, sf_dir):
    c, four = Clinic(spark, sf_dir), F.col("o_custkey") % 4
    mark = F.when(four == 0, governance.OPEN_MARKS[0]).when(four == 1, governance.OPEN_MARKS[1]).when(four == 2, governance.OPEN_MARKS[2]).otherwise("Auto")
    provenance = c.raw("orders").select(F.col("o_orderkey").alias("decision_id"), mark.alias("reviewed_by"))
    return governance.publish_provenance(_adjudicated(c)[0], _published(c)[0], provenance)


F10 = f"""select event_id, decision_id, actor, new_concept_id from (select e.review_id as event_id, m.*, row_number() over (partition by e.review_id, m.new_concept_id order by m.decision_id, m.actor) as k
 from (select distinct c.decision_id, c.actor, c.new_concept_id from (select decision_id, actor, 3000000 + decision_id % 28 as new_concept_id from rev) c join dec d using (decision_id) where d.status = 'REJECTED' and c.new_concept_id <> d.concept_id
  and exists (select 1 from rev v where v.decision_id = c.decision_id and v.actor = c.actor and v.verdict = 'REJECT') and c.new_concept_id in (select concept_id from {_CUR})) m join rev e on e.decision_id = m.decision_id) where k = 1"""


@query("f10", _sql(F10))
def f10(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    reviews = _reviews(c)
    claims = reviews.select("decision_id", "actor", (3000000 + F.col("decision_id") % 28).alias("new_concept_id"))
    return governance.counterproposals(_decisions(c), reviews, claims, reviews.select(F.col("review_id").alias("event_id"), "decision_id"), c.concept)[1]


def _registry(c):
    key = F.col("s_suppkey")
    return c.raw("supplier").select(F.concat(F.lit("adapter-"), (key % 30).cast("string")).alias("adapter"), F.col("s_nationkey").cast("string").alias("system"), F.concat(F.lit("V"), (key % 4).cast("string")).alias("vocabulary_id"), (key % 3 != 0).alias("active"))


_REG = "(select 'adapter-' || (s_suppkey % 30) as adapter, cast(s_nationkey as varchar) as system, 'V' || (s_suppkey % 4) as vocabulary_id, s_suppkey % 3 <> 0 as active from supplier)"
F11 = f"""select c_custkey as claim_id, adapter, system, vocabulary_id from (select c_custkey, 'adapter-' || (c_custkey % 40) as adapter, cast(c_nationkey as varchar) as system from customer) join (select adapter, system, count(*) as n, min(vocabulary_id) as vocabulary_id from {_REG} where active group by 1, 2) using (adapter, system) where n = 1"""


@query("f11", F11)
def f11(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    claims = c.raw("customer").select(F.col("c_custkey").alias("claim_id"), F.concat(F.lit("adapter-"), (F.col("c_custkey") % 40).cast("string")).alias("adapter"), F.col("c_nationkey").cast("string").alias("system"))
    return governance.resolve_source(claims, _registry(c))[0]


F12 = f"""with recursive a as (select c_custkey as action_id, 'adapter-' || (c_custkey % 30) as adapter, cast(c_nationkey as varchar) as system, 'V' || (c_custkey % 4) as vocabulary_id, c_custkey % 5 = 0 as ends, row_number() over (partition by c_custkey % 30, c_nationkey order by c_custkey) as n from customer),
 g as (select adapter, system, min(vocabulary_id) as held from {_REG} group by 1, 2 having max(active)),
 s as (select a.*, g.held as before from a left join g using (adapter, system) where n = 1
 union all select a.*, case when s.ends then null else coalesce(s.before, s.vocabulary_id) end from s join a on a.adapter = s.adapter and a.system = s.system and a.n = s.n + 1)
 select action_id, case when ends and before is null then 'NOT_ACTIVE' when ends then 'DEACTIVATED' when before is null then 'REGISTERED' when before = vocabulary_id then 'UNCHANGED' else 'CONFLICT' end as outcome from s"""


@query("f12", F12)
def f12(spark, sf_dir):
    c, key = Clinic(spark, sf_dir), F.col("c_custkey")
    actions = c.raw("customer").select(key.alias("action_id"), F.concat(F.lit("adapter-"), (key % 30).cast("string")).alias("adapter"), F.col("c_nationkey").cast("string").alias("system"), F.concat(F.lit("V"), (key % 4).cast("string")).alias("vocabulary_id"), F.when(key % 5 == 0, "DEACTIVATE").otherwise("REGISTER").alias("kind"))
    registry = _registry(c).groupBy("adapter", "system").agg(F.min("vocabulary_id").alias("vocabulary_id"), F.max("active").alias("active"))
    return governance.apply_registry(registry, actions)[1]


BOUND = """ev as (select p_partkey as event_id, cast(p_partkey as varchar) as code, case when p_partkey % 5 = 0 then 9 else 0 end as concept_id from part where p_partkey % 23 <> 0), claims as (select 'k' || p_partkey as record_key, p_partkey as decision_id, p_partkey + case when p_partkey % 31 = 0 then 1 else 0 end as event_id from part),
dd as (select p_partkey as decision_id, case when p_partkey % 19 = 0 then 'other' else 'k' || p_partkey end as record_key, case when p_partkey % 13 = 0 then 0 else p_size end as concept_id, p_partkey % 7 = 0 as eligible, cast(p_partkey as varchar) as code from part where p_partkey % 29 <> 0),
bb as (select 'k' || p_partkey as record_key, p_partkey as decision_id, p_partkey + case when p_partkey % 2 = 0 then 5 else 0 end as event_id from part where p_partkey % 17 = 0),
jj as (select c.*, coalesce(b.decision_id = c.decision_id and b.event_id = c.event_id, false) as again, case when again then null when b.decision_id is not null then 'CONFLICTING_BINDING' when d.decision_id is null then 'UNKNOWN_DECISION' when d.record_key <> c.record_key then 'OTHER_SOURCE'
 when d.eligible then 'ALREADY_ELIGIBLE' when d.concept_id <= 0 then 'NOT_A_SELECTION' when d.concept_id in (3, 4) then 'REJECTION_POLICY' when e.event_id is null then 'EVENT_NOT_UNIQUE' when e.concept_id <> 0 then 'EVENT_MAPPED' when e.code is distinct from d.code then 'SOURCE_DIFFERS' end as reason
 from claims c left join bb b using (record_key) left join dd d on d.decision_id = c.decision_id left join ev e on e.event_id = c.event_id)"""


def _bound(c):
    key, part = F.col("p_partkey"), c.raw("part")
    record = F.concat(F.lit("k"), key.cast("string"))
    claims = part.select(record.alias("record_key"), key.alias("decision_id"), (key + F.when(key % 31 == 0, 1).otherwise(0)).alias("event_id"))
    decisions = part.where("p_partkey % 29 <> 0").select(
        key.alias("decision_id"), F.when(key % 19 == 0, "other").otherwise(record).alias("record_key"), F.when(key % 13 == 0, 0).otherwise(F.col("p_size")).alias("concept_id"), F.lit("PRE_INGESTION").alias("status"), (key % 7 == 0).alias("eligible"), key.cast("string").alias("code")
    )
    events = part.where("p_partkey % 23 <> 0").select(key.alias("event_id"), key.cast("string").alias("code"), F.when(key % 5 == 0, 9).otherwise(0).alias("concept_id"))
    bindings = part.where("p_partkey % 17 = 0").select(record.alias("record_key"), key.alias("decision_id"), (key + F.when(key % 2 == 0, 5).otherwise(0)).alias("event_id"))
    policy = part.where("p_size in (3, 4)").select(F.col("p_size").alias("concept_id"))
    return governance.bind_events(claims, decisions, events, policy, bindings)


@query("f13", f"with {BOUND} select record_key, decision_id, event_id, again from jj where reason is null")
def f13(spark, sf_dir):
    return _bound(Clinic(spark, sf_dir))[0]


@query("f13_refused", f"with {BOUND} select record_key, reason from jj where reason is not null")
def f13_refused(spark, sf_dir):
    return _bound(Clinic(spark, sf_dir))[1]


F14 = f"""with {BOUND}, rr as (select p_partkey as receipt_id, 'run-' || (p_partkey % 10) as run_id, case when p_partkey % 6 = 0 then 'm0' else 'm1' end as manifest, 'k' || p_partkey as record_key from part), oo as (select receipt_id, case when run_id = 'run-9' then 'UNKNOWN_RUN' when run_id = 'run-8' then 'RUN_FAILED' when manifest <> 'm1' then 'MANIFEST_DIFFERS'
 when j.reason is not null then j.reason end as code, j.again from rr join jj j using (record_key)) select receipt_id, case when code is not null then 'FAILED' when again then 'ALREADY_BOUND' else 'BOUND' end as outcome, code from oo"""


@query("f14", F14)
def f14(spark, sf_dir):
    c, key = Clinic(spark, sf_dir), F.col("p_partkey")
    receipts = c.raw("part").select(key.alias("receipt_id"), F.concat(F.lit("run-"), (key % 10).cast("string")).alias("run_id"), F.when(key % 6 == 0, "m0").otherwise("m1").alias("manifest"), F.concat(F.lit("k"), key.cast("string")).alias("record_key"))
    runs = c.raw("nation").where("n_nationkey < 9").select(F.concat(F.lit("run-"), F.col("n_nationkey").cast("string")).alias("run_id"), F.when(F.col("n_nationkey") == 8, "FAILED").otherwise("SUCCESS").alias("status"), F.lit("m1").alias("manifest"))
    return governance.handoff(receipts, runs, *_bound(c))[0]


F14B = """select batch, n, case when n > 6 then 'TOO_MANY' when runs > 1 then 'MANY_RUNS' when records < n then 'DUPLICATE_RECORD' when events < n then 'DUPLICATE_EVENT' end as violation
from (select l_orderkey as batch, count(*) as n, count(distinct case when l_orderkey % 9 = 0 then l_linenumber % 2 else 0 end) as runs, count(distinct l_partkey % 50) as records, count(distinct l_suppkey) as events from lineitem group by 1)"""


@query("f14_batches", F14B)
def f14_batches(spark, sf_dir):
    run = F.when(F.col("l_orderkey") % 9 == 0, F.col("l_linenumber") % 2).otherwise(0)
    receipts = Clinic(spark, sf_dir).raw("lineitem").select(
        F.col("l_orderkey").alias("batch"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt_id"), F.concat(F.lit("run-"), run.cast("string")).alias("run_id"), F.lit("m1").alias("manifest"),
        (F.col("l_partkey") % 50).cast("string").alias("record_key"), F.lit("drug_exposure").alias("target_table"), F.col("l_suppkey").alias("target_id"),
    )
    return governance.handoff_batches(receipts, 6, uuid.NAMESPACE_URL, "handoff:").select("batch", "n", "violation")


F14D = """select p_partkey as receipt_id, case when n = 1 then id end as decision_id, case when coalesce(n, 0) = 0 then 'NO_DECISION' when n > 1 then 'MANY_DECISIONS' end as reason from part left join (select l_partkey, count(*) as n, min(l_orderkey * 10 + l_linenumber) as id
 from lineitem where l_orderkey % 29 = 0 and l_returnflag <> 'R' and l_linenumber <> 7 group by 1) d on d.l_partkey = p_partkey"""


@query("f14_decisions", F14D)
def f14_decisions(spark, sf_dir):
    c, adapter, table = Clinic(spark, sf_dir), F.lit("adapter-1").alias("source_adapter"), F.lit("drug_exposure").alias("target_table")
    key = lambda name: F.concat(F.lit("k"), F.col(name).cast("string")).alias("record_key")
    decisions = c.raw("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("decision_id"), adapter, table, key("l_partkey"), (F.col("l_linenumber") == 7).alias("eligible"),
        F.when(F.col("l_returnflag") == "R", "APPROVED").when(F.col("l_returnflag") == "A", governance.BEFORE_INGESTION[1]).otherwise(governance.BEFORE_INGESTION[0]).alias("status"),
        F.when(F.col("l_orderkey") % 29 == 0, "SELECT").otherwise("ABSTAIN").alias("model_decision"),
    )
    receipts = c.raw("part").select(F.col("p_partkey").alias("receipt_id"), adapter, table, key("p_partkey"))
    return governance.bindable_decisions(receipts, decisions)


@query("f15", "select c_name as name, c_custkey as actor_id from customer where c_custkey % 3 = 0")
def f15(spark, sf_dir):
    c = Clinic(spark, sf_dir).raw("customer")
    roles = c.select(F.col("c_custkey").alias("actor_id"), F.when(F.col("c_custkey") % 3 == 0, "reviewer").otherwise("adjudicator").alias("role"))
    return governance.resolve_actors(c.select(F.col("c_name").alias("name")), c.select(F.lower("c_name").alias("alias"), F.col("c_custkey").alias("actor_id")), roles, "reviewer")


@query("f15_roles", "select actor_id, string_agg(distinct role, ',' order by role) as roles from (select s_suppkey % 20 as actor_id, case s_nationkey % 3 when 0 then 'admin' when 1 then 'reviewer' else 'adjudicator' end as role from supplier) group by 1")
def f15_roles(spark, sf_dir):
    nation = F.col("s_nationkey") % 3
    roles = Clinic(spark, sf_dir).raw("supplier").select((F.col("s_suppkey") % 20).alias("actor_id"), F.when(nation == 0, "admin").when(nation == 1, "reviewer").otherwise("adjudicator").alias("role"))
    return governance.actor_roles(roles)
