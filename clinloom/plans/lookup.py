"""Registered queries: text, retrieval and decisions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clinloom.functions import ids, text
from clinloom.operators import retrieval, vectors
from clinloom.plans.binding import Clinic, oracle
from clinloom.plans.registry import query

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@query("e1", "select p_partkey, case when p_partkey % 2 = 0 then 'Expanded ' || lower(p_name) else '  ' || upper(p_name) || ' ' end as retrieval_text, case when p_partkey % 2 = 0 then 'a-' || lower(p_name) end as alias_id from part")
def e1(spark, sf_dir):
    part = Clinic(spark, sf_dir).raw("part")
    key = F.col("p_partkey")
    terms = part.select(key, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("term"), F.when(key % 2 == 0, "measurement").otherwise("observation").alias("target_table"))
    name = F.lower("p_name")
    lexicon = part.select(F.concat(F.lit("a-"), name).alias("alias_id"), name.alias("alias"), F.concat(F.lit("Expanded "), name).alias("expansion")).distinct()
    return retrieval.expand_aliases(terms, lexicon).select("p_partkey", "retrieval_text", "alias_id")


E2 = """select query_id, item_id, round(distance, 6) as distance, cast(rank as int) as rank from (select *, row_number() over (partition by query_id order by round(distance, 12), item_id) as rank
 from (select q.vec_id as query_id, i.vec_id as item_id, 1 - list_cosine_similarity(q.embedding::double[], i.embedding::double[]) as distance from embeddings q join embeddings i on true where q.vec_id % 50 = 0)) where rank <= 5"""


def _nearest(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("embeddings")
    pick = lambda where, name: rows.where(where).select(F.col("vec_id").alias(name), F.col("embedding").alias("vector"))
    return retrieval.cosine_topk(pick("vec_id % 50 = 0", "query_id"), pick("true", "item_id"), 5)


@query("e2", E2)
def e2(spark, sf_dir):
    return _nearest(spark, sf_dir).select("query_id", "item_id", F.round("distance", 6).alias("distance"), "rank")


#: As E2, but every row is a query, and its own id is left out.
E2_ALL = """select query_id, item_id, round(distance, 6) as distance, cast(rank as int) as rank from (select *, row_number() over (partition by query_id order by round(distance, 12), item_id) as rank
 from (select q.vec_id as query_id, i.vec_id as item_id, 1 - list_cosine_similarity(q.embedding::double[], i.embedding::double[]) as distance from embeddings q join embeddings i on i.vec_id <> q.vec_id)) where rank <= 5"""


@query("e2_all", E2_ALL)
def e2_all(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return retrieval.nearest_others(rows, 5).select("query_id", "item_id", F.round("distance", 6).alias("distance"), "rank")


@query("e2_ivf")
def e2_ivf(spark, sf_dir):
    """As e2, by the inverted file: every row indexed, ids divisible by 50 as queries. Approximate; recall is tested."""
    rows = Clinic(spark, sf_dir).raw("embeddings").select("vec_id", F.col("embedding").alias("vector"))
    index = vectors.build_index(rows.withColumnRenamed("vec_id", "item_id"))
    found = vectors.probe_topk(rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), index, 5)
    return found.select("query_id", "item_id", F.round("distance", 6).alias("distance"), "rank")


@query("e3", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, greatest(0, least(1, 1 - (l_discount * 20 - 0.5))) as cosine, 1 / (1 + greatest(0, l_discount * 20 - 0.5)) as other from lineitem")
def e3(spark, sf_dir):
    d = F.col("l_discount") * 20 - 0.5
    return Clinic(spark, sf_dir).raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.similarity(d).alias("cosine"), text.similarity(d, "l2").alias("other"))


_NAMES = "case p_partkey % 6 when 0 then p_name || ' [Mass/volume] in Serum or Plasma' when 1 then p_name || ' in Arterial blood by test strip' when 2 then 'Blood ' || p_name || ' mg/dL' when 3 then p_name || ' [Presence] in Urine (legacy)' when 4 then p_name || ' RNA count' else p_name end"
E4 = "select p_partkey, case p_partkey % 6 when 0 then 'serum_or_plasma' when 1 then 'arterial_blood' when 2 then 'blood' when 3 then 'urine' else '' end as specimen, case p_partkey % 6 when 0 then 'mass_volume' when 2 then 'mass_volume' when 3 then 'presence' when 4 then 'number_volume' else '' end as property, case p_partkey % 6 when 1 then 'test_strip' when 4 then 'nucleic_acid' else '' end as method from part"


@query("e4", E4)
def e4(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("part").select("p_partkey", text.axes(F.expr(_NAMES)).alias("a"))
    return rows.select("p_partkey", *[F.array_join(f"a.{x}", ",").alias(x) for x in text.AXES])


E5 = """with t as (select p_partkey as term_id, specimen, property, method from ({axes})), c as (select p_partkey as item_id, specimen, property, method from ({axes}))
select term_id, item_id, rerank_score, cast(new_rank as int) as new_rank from (select *, row_number() over (partition by term_id order by rerank_score desc, rank) as new_rank from (select t.term_id, c.item_id, k as rank,
 round(k / 20.0 + case when t.specimen = '' then 0 when t.specimen = c.specimen then 0.08 when c.specimen <> '' then -0.35 else 0 end + case when t.property = '' then 0 when t.property = c.property then 0.08 when c.property <> '' then -0.35 else 0 end
 + case when t.method = '' then 0 when t.method = c.method then 0.08 when c.method <> '' then -0.35 else 0 end, 6)::double as rerank_score from t, (select unnest(range(1, 8)) as k) join c on c.item_id = t.term_id + k)) where new_rank <= 3""".format(axes=E4)


@query("e5", E5)
def e5(spark, sf_dir):
    part = Clinic(spark, sf_dir).raw("part").select("p_partkey", F.expr(_NAMES).alias("name"))
    asks = part.select(F.col("p_partkey").alias("term_id"), F.col("name").alias("term"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("rank"))
    found = asks.join(part, F.col("p_partkey") == F.col("term_id") + F.col("rank")).withColumnRenamed("p_partkey", "item_id").withColumn("similarity", F.col("rank") / 20.0)
    return retrieval.rerank(found, 3).select("term_id", "item_id", "rerank_score", "new_rank")


_E6 = """select term_id, item_id, score, cast(rank as int) as rank from (select *, row_number() over (partition by term_id order by score desc, item_id) as rank from (select t.p_partkey as term_id, i.p_partkey as item_id,
 round(jaro_winkler_similarity(lower(trim(substr(t.p_name, 2))), lower(trim(i.p_name))), 6) as score from part t, part i where t.p_partkey % {by} = {of})) where rank <= 5"""
E6 = _E6.format(by=50, of=0)


def _fuzzy(spark, sf_dir, by=50, of=0):
    part = Clinic(spark, sf_dir).raw("part")
    terms = part.where(F.col("p_partkey") % by == of).select(F.col("p_partkey").alias("term_id"), F.expr("substr(p_name, 2)").alias("term"))
    return retrieval.jaro_winkler_topk(terms, part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name")), 5)


@query("e6", E6)
def e6(spark, sf_dir):
    return _fuzzy(spark, sf_dir)


E7 = f"""select p_partkey as case_id, case when p_partkey % 2 = 0 or coalesce(score >= 0.9, false) then 'MAP' else 'ABSTAIN' end as decision, case when p_partkey % 2 = 0 then 7 when score >= 0.9 then item_id end as concept_id,
 case when p_partkey % 2 = 0 then 1.0 else coalesce(score, 0.0) end::double as score, case when p_partkey % 2 = 0 then 'EXACT_CODE' when score >= 0.9 then 'CANDIDATE' else 'NONE' end as method from part left join (select * from ({_E6.format(by=2, of=1)}) where rank = 1) f on f.term_id = p_partkey"""


@query("e7", E7)
def e7(spark, sf_dir):
    even = F.col("p_partkey") % 2 == 0
    exact = Clinic(spark, sf_dir).raw("part").select(F.col("p_partkey").alias("case_id"), F.when(even, "MAP").otherwise("ABSTAIN").alias("decision"), F.when(even, 7).cast("long").alias("concept_id"))
    return retrieval.threshold_decision(exact, _fuzzy(spark, sf_dir, 2, 1).withColumnRenamed("term_id", "case_id"), 0.9)


@query(
    "e8",
    """select p_partkey as term_id, case when p_partkey % 8 in (0, 1) then case p_partkey % 8 when 0 then 'SELECT' else 'ABSTAIN' end else 'ABSTAIN' end as decision, case when p_partkey % 8 = 0 then p_partkey end as concept_id,
 case p_partkey % 8 when 2 then 'NOT_JSON' when 3 then 'SCHEMA' when 4 then 'CONFIDENCE_NOT_NUMERIC' when 5 then 'CONFIDENCE_RANGE' when 6 then 'NOT_A_CANDIDATE' when 7 then 'SIGNALS' end as error from part""",
)
def e8(spark, sf_dir):
    key, k = F.col("p_partkey").cast("string"), F.col("p_partkey") % 8
    reply = lambda decision, chosen, confidence, signals: F.concat(F.lit(f'{{"decision":"{decision}","selected_concept_id":'), chosen, F.lit(f',"confidence":{confidence},"reason":"a reason","clinical_signals":{signals}}}'))
    content = (
        F.when(k == 0, reply("SELECT", key, "0.9", '["unit"]'))
        .when(k == 1, reply("ABSTAIN", F.lit("null"), "0", "[]"))
        .when(k == 2, F.lit('{"decision":'))
        .when(k == 3, F.lit('{"decision":"ABSTAIN"}'))
        .when(k == 4, reply("SELECT", key, '"0.9"', "[]"))
        .when(k == 5, reply("SELECT", key, "1.5", "[]"))
        .when(k == 6, reply("SELECT", F.lit("5"), "0.5", "[]"))
        .otherwise(reply("SELECT", key, "0.5", '["a",""]'))
    )
    responses = Clinic(spark, sf_dir).raw("part").select(F.col("p_partkey").alias("term_id"), content.alias("content"), F.array("p_partkey", F.lit(-1)).alias("candidates"))
    return retrieval.validate_decisions(responses).select("term_id", "decision", "concept_id", "error")


_SCORED = "(select p_partkey as term_id, p_partkey * 3 as concept_id, round(least((p_partkey % 100) / 100.0, (p_partkey % 37 + 60) / 100.0), 4)::double as governed_score from part where p_partkey % 3 <> 0)"


def _governed(c):
    key = F.col("p_partkey")
    part = c.raw("part")
    decisions = part.select(key.alias("term_id"), F.when(key % 3 != 0, key * 3).alias("concept_id"), ((key % 37 + 60) / 100.0).alias("confidence"))
    return retrieval.governed_score(decisions, part.select(key.alias("term_id"), (key * 3).alias("item_id"), ((key % 100) / 100.0).alias("similarity")))


@query("e9", f"select * from {_SCORED}")
def e9(spark, sf_dir):
    return _governed(Clinic(spark, sf_dir)).select("term_id", "concept_id", "governed_score")


_STATUS = f"(select *, case when term_id % 10 = 1 then 'REJECTED' when governed_score >= 0.8 then 'PENDING' else 'LOW_CONFIDENCE' end as status from {_SCORED})"


def _proposals(c):
    policy = c.raw("part").where("p_partkey % 10 = 1").select(F.col("p_partkey").alias("term_id"), (F.col("p_partkey") * 3).alias("concept_id"))
    affected = c.event.select(F.col("code").cast("long").alias("term_id"), "event_id")
    return retrieval.record_proposals(_governed(c), affected, policy)


@query("e10", f"select * from {_STATUS}")
def e10(spark, sf_dir):
    return _proposals(Clinic(spark, sf_dir))[0]


@query("e10_provenance", oracle(f"select event_id, term_id, concept_id, s.status from event join {_STATUS} s on s.term_id = cast(code as bigint)", "event"))
def e10_provenance(spark, sf_dir):
    return _proposals(Clinic(spark, sf_dir))[1]


@query("e11", oracle("select event_id, cast(code as bigint) as term_id, 'ABSTAINED' as status from event where cast(code as bigint) % 3 = 0", "event"))
def e11(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    affected = c.event.select(F.col("code").cast("long").alias("term_id"), "event_id")
    return retrieval.record_abstentions(c.raw("part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("term_id")), affected)[1]


@query("e12", "select p_name || p_partkey as record_key, -cast('0x' || substr(sha256(p_name || p_partkey), 1, 15) as bigint) - 1 as event_id, p_partkey as concept_id, case when p_size >= 25 then 'PENDING' else 'LOW_CONFIDENCE' end as status, false as publication_eligible from part")
def e12(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("record_key"), F.col("p_partkey").alias("concept_id"), (F.col("p_size") / 50.0).alias("similarity"))
    return retrieval.record_external(rows, 0.5)


_LEDGER = "(select vec_id as entry_id, vec_id % 40 as term_id, label as item_id, (vec_id * 7 % 100) / 100.0 as similarity, vec_id % 13 as seen_at from embeddings)"


def _ledger(c):
    key = F.col("vec_id")
    return c.raw("embeddings").select(key.alias("entry_id"), (key % 40).alias("term_id"), F.col("label").alias("item_id"), ((key * 7 % 100) / 100.0).alias("similarity"), (key % 13).alias("seen_at"))


@query("e13", f"select entry_id, term_id, item_id from {_LEDGER} where term_id % 2 = 0 and similarity >= 0.8")
def e13(spark, sf_dir):
    rows = _ledger(Clinic(spark, sf_dir))
    return retrieval.suggestions(rows.where("term_id % 2 = 0").select("term_id").distinct(), rows).select("entry_id", "term_id", "item_id")


@query("e14", f"select entry_id, term_id, item_id, seen_at from {_LEDGER} qualify row_number() over (partition by term_id, item_id order by seen_at desc, entry_id desc) = 1")
def e14(spark, sf_dir):
    return retrieval.suggestion_queue(_ledger(Clinic(spark, sf_dir))).select("entry_id", "term_id", "item_id", "seen_at")


E15 = """select lower(trim(term)) as term_key, concept_id, approved_at, row_id from (select p_name || ' ' as term, p_size as concept_id, p_partkey % 90 as approved_at, p_partkey as row_id from part) where lower(trim(term)) not in (select lower(p_name) from part where p_partkey < 3)
 qualify row_number() over (partition by lower(trim(term)), concept_id order by approved_at, row_id) = 1 order by approved_at, row_id limit 100"""


@query("e15", E15)
def e15(spark, sf_dir):
    part = Clinic(spark, sf_dir).raw("part")
    rows = part.select(F.concat("p_name", F.lit(" ")).alias("term"), F.col("p_size").alias("concept_id"), (F.col("p_partkey") % 90).alias("approved_at"), F.col("p_partkey").alias("row_id"))
    return retrieval.approved_examples(rows, 100, part.where("p_partkey < 3").select(F.upper("p_name").alias("term")))


@query("e16")
def e16(spark, sf_dir):
    return text.redact(Clinic(spark, sf_dir).raw("documents").select("doc_id", "text"), "text").select("doc_id", "text", F.array_join("categories", ",").alias("categories"))


@query("e17", "select event_id, case event_id % 4 when 0 then 'FORBIDDEN_KEY' else 'IDENTIFIER' end as reason from events where event_id % 4 in (0, 1)")
def e17(spark, sf_dir):
    k, user = F.col("event_id") % 4, F.col("user_id").cast("string")
    details = F.when(k == 0, F.concat(F.lit('{"Email":"x'), user, F.lit('"}'))).when(k == 1, F.concat(F.lit('{"note":"Patient/'), user, F.lit('"}'))).otherwise(F.col("props"))
    return text.audit_violations(Clinic(spark, sf_dir).raw("events").select("event_id", details.alias("details")), "details").select("event_id", "reason")


@query("e18")
def e18(spark, sf_dir):
    return Clinic(spark, sf_dir).raw("part").select("p_partkey", ids.uuid5(SPACE, F.concat_ws("|", "p_brand", "p_name", F.col("p_partkey").cast("string"))).alias("uuid"))


E19 = "select p_partkey, sha256('hospital-csv-v1|' || p_brand || '|measurement|r' || p_partkey) as record_key, p_name || ' | ' || p_brand || ' | ' || case when p_partkey % 2 = 0 then '[REDACTED_FHIR_PATIENT_REFERENCE]' else 'mg' end as retrieval_text from part"


@query("e19", E19)
def e19(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("part").select("p_partkey", "p_name", "p_brand", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Patient/"), F.col("p_partkey").cast("string"))).otherwise("mg").alias("unit"))
    key = F.sha2(F.concat_ws("|", F.lit("hospital-csv-v1"), "p_brand", F.lit("measurement"), F.concat(F.lit("r"), F.col("p_partkey").cast("string"))).cast("binary"), 256)
    parts = [text.redacted(F.col(c))["text"] for c in ("p_name", "p_brand", "unit")]
    return rows.select("p_partkey", key.alias("record_key"), F.concat_ws(" | ", *parts).alias("retrieval_text"))


@query("e20")
def e20(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    names = c.raw("customer").select(F.concat_ws(" ", F.lit("Dr"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("name")).distinct()
    aliases = c.raw("nation").select(F.col("n_nationkey").alias("actor_id"), F.concat_ws(" ", F.lit("dr  Machinéry"), F.col("n_nationkey").cast("string")).alias("alias"))
    return retrieval.suggest_actors(names, aliases)


