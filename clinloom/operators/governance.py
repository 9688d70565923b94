"""Governance of mappings as set operations over batches of actions.

Decisions: decision_id, semantic_key, target_table, source_value, concept_id, run_id, proposer, status,
eligible, proposed_at. Reviews: review_id, decision_id, actor, verdict (APPROVE or REJECT), submitted_at.
Each batch gives accepted rows, rejected rows with the first reason against them, and next tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.functions.ids import uuid5
from clinloom.session import discard, store

OPEN = ("PENDING", "LOW_CONFIDENCE")
# Marks of provenance rows, those still open and those that a decision leaves.
OPEN_MARKS = ("Pending_Human_Review", "Below_Confidence_Threshold", "REJECTED_BY_POLICY")
MARKS = {"APPROVED": "Approved_by_Human", "REJECTED": "Rejected_by_Human", "SUPERSEDED": "Superseded_By_Canonical_Decision"}
# States of a decision made before its record was ingested.
BEFORE_INGESTION = ("PRE_INGESTION", "PRE_INGESTION_LOW_CONFIDENCE")


def semantic_key(*parts) -> Column:
    """One key for decisions that mean the same."""
    return F.concat_ws("\x1f", *[F.coalesce(F.lower(F.trim(p.cast("string"))), F.lit("")) for p in parts])


def _admitted(votes: DataFrame, columns: list[str]) -> DataFrame:
    """``votes`` (semantic_key and ``columns``) with ``reason``, null if admitted. The votes of a key stream through a
    task in order; only what the key has admitted, two votes a decision at most, is held."""
    ordered = votes.select("semantic_key", *columns).repartition("semantic_key").sortWithinPartitions("semantic_key", "submitted_at", "review_id")
    schema = T.StructType([*ordered.schema.fields, T.StructField("reason", T.StringType())])
    key_at, decision_at, actor_at = (ordered.columns.index(c) for c in ("semantic_key", "decision_id", "actor"))

    def run(batches):
        now, places, actors = None, {}, set()
        for batch in batches:
            reasons = []
            for key, decision, actor in zip(*(batch.column(i).to_pylist() for i in (key_at, decision_at, actor_at)), strict=True):
                if key != now:
                    now, places, actors = key, {}, set()
                if places.get(decision, 0) >= 2:
                    reasons.append("TWO_REVIEWS_EXIST")
                elif actor in actors:
                    reasons.append("SAME_PERSON")
                else:
                    places[decision] = places.get(decision, 0) + 1
                    if actor is not None:
                        actors.add(actor)
                    reasons.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reasons, pa.string())], names=schema.fieldNames())

    return ordered.mapInArrow(run, schema)


def _admitted_by_rounds(votes: DataFrame, columns: list[str]) -> DataFrame:
    """As ``_admitted``, in rounds over all keys together, so that a key's votes lie in many tasks. Of the votes still open, one
    that is the earliest of its decision and of its actor in its key depends on no other and is admitted; then the votes of
    the actors admitted and of the decisions with two such votes fall out. Only a decision's first vote of each actor can be
    admitted, so others never enter. The second vote admitted tells the reason of those refused."""
    rows = store(votes.select("semantic_key", *columns).withColumn("_at", F.struct("submitted_at", "review_id", F.monotonically_increasing_id().alias("row"))), "votes")
    place, actor = ["semantic_key", "decision_id"], ["semantic_key", "actor"]
    least = lambda df, keys, name: df.groupBy(*keys).agg(F.min("_at").alias(name))
    named = rows.where("actor is not null").groupBy("semantic_key", "decision_id", "actor").agg(F.min("_at").alias("_at"))
    left = store(named.unionByName(rows.where("actor is null").select("semantic_key", "decision_id", "actor", "_at")), "votes-open")
    settled = None
    while not left.isEmpty():
        both = left.join(least(left, place, "_place"), place).join(least(left.where("actor is not null"), actor, "_actor"), actor, "left")
        first = store(both.where("_at = _place and (actor is null or _at = _actor)").select(*left.columns), "votes-first")
        now = first if settled is None else settled.unionByName(first)
        full = now.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select(*place)
        taken = first.where("actor is not null").select(*actor).distinct()
        rest = left.join(first.select("semantic_key", "_at"), ["semantic_key", "_at"], "left_anti").join(taken, actor, "left_anti").join(full, place, "left_anti")
        before, left, settled = left, store(rest, "votes-open"), now
        discard(before)
    if settled is None:
        return rows.withColumn("reason", F.lit(None).cast("string")).drop("_at")
    second = settled.groupBy(*place).agg(F.max("_at").alias("_second"), F.count(F.lit(1)).alias("_n")).where("_n = 2").select(*place, "_second")
    judged = rows.join(settled.select("semantic_key", "_at", F.lit(True).alias("_in")), ["semantic_key", "_at"], "left").join(second, place, "left")
    reason = F.when(F.col("_in"), None).when(F.col("_second") < F.col("_at"), "TWO_REVIEWS_EXIST").otherwise("SAME_PERSON")
    return judged.select("semantic_key", *columns, reason.alias("reason"))


#: A key with more votes than this is judged in rounds, not by one task.
FOLDED_VOTES = 10_000


def _judged(votes: DataFrame, columns: list[str], most: int) -> DataFrame:
    """Each key's votes with ``reason``: those of a key with ``most`` votes or fewer by a fold, of others in rounds."""
    busy = votes.groupBy("semantic_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("semantic_key")
    if busy.isEmpty():
        return _admitted(votes, columns)
    busy = store(busy, "busy-keys")
    return _admitted(votes.join(busy, "semantic_key", "left_anti"), columns).unionByName(_admitted_by_rounds(votes.join(busy, "semantic_key", "left_semi"), columns))


def admit_reviews(decisions: DataFrame, actions: DataFrame, folded: int = FOLDED_VOTES) -> tuple[DataFrame, DataFrame]:
    """Votes of ``actions`` in order of (submitted_at, review_id). A refused vote counts neither for the two
    places of a decision nor as a vote of its actor. Keys of more than ``folded`` votes are judged in rounds."""
    d = decisions.select("decision_id", "semantic_key", "proposer", "status", "eligible")
    known = actions.join(d, "decision_id", "left")
    early = (
        F.when(F.col("semantic_key").isNull(), "UNKNOWN_DECISION")
        .when(~F.col("eligible"), "NOT_PUBLISHABLE")
        .when(~F.col("status").isin(*OPEN), "NOT_REVIEWABLE")
        .when(F.col("proposer") == F.col("actor"), "OWN_PROPOSAL")
    )
    judged = known.withColumn("reason", early)
    out = ["review_id", "decision_id", "actor", "verdict", "submitted_at"]
    done = _judged(judged.where("reason is null"), out, folded)
    rejected = judged.where("reason is not null").select(*out, "reason").unionByName(done.where("reason is not null").select(*out, "reason"))
    return done.where("reason is null").select(*out), rejected


def dedupe_votes(reviews: DataFrame, decisions: DataFrame) -> DataFrame:
    """(review_id, active): the earliest vote of an actor on a semantic key stays active."""
    order = Window.partitionBy("actor", "semantic_key").orderBy("submitted_at", "review_id")
    both = reviews.join(decisions.select("decision_id", "semantic_key"), "decision_id")
    return both.select("review_id", (F.row_number().over(order) == 1).alias("active"))


def _canonical(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Pending publishable decisions, one a semantic key, with n_reviews: most reviewed, then earliest."""
    counts = reviews.groupBy("decision_id").agg(F.count_distinct("review_id").alias("n_reviews"))
    open_ = decisions.where("status = 'PENDING' and eligible").join(counts, "decision_id", "left").withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0)))
    order = Window.partitionBy("semantic_key").orderBy(F.desc("n_reviews"), "proposed_at", "decision_id")
    return open_.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def review_queue(decisions: DataFrame, reviews: DataFrame, actor: int, run_id: str | None = None, novel_only: bool = False) -> DataFrame:
    """Decisions that ``actor`` may review: not yet reviewed twice, not their own, nothing alike seen by them;
    of one run, and not proposed before in another, if asked."""
    chosen = decisions if run_id is None else decisions.where(F.col("run_id") == run_id)
    queue = _canonical(chosen, reviews).where((F.col("n_reviews") < 2) & ~F.coalesce(F.col("proposer") == actor, F.lit(False)))
    seen = reviews.where(F.col("actor") == actor).join(decisions.select("decision_id", "semantic_key"), "decision_id").select("semantic_key")
    queue = queue.join(seen, "semantic_key", "left_anti")
    if novel_only:
        prior = decisions.select(F.col("semantic_key").alias("_k"), F.col("run_id").alias("_r"), F.col("proposed_at").alias("_t"), F.col("decision_id").alias("_d"))
        before = (F.col("_t") < F.col("proposed_at")) | ((F.col("_t") == F.col("proposed_at")) & (F.col("_d") < F.col("decision_id")))
        queue = queue.join(prior, (F.col("semantic_key") == F.col("_k")) & (F.col("run_id") != F.col("_r")) & before, "left_anti")
    return queue.select("decision_id", "run_id", "source_value", "concept_id", "n_reviews")


def queue_metrics(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    c = _canonical(decisions, reviews).agg(F.count_if(F.col("n_reviews") < 2).alias("ready"), F.count_if(F.col("n_reviews") >= 2).alias("ready_to_adjudicate"))
    low = decisions.where("status = 'LOW_CONFIDENCE' and eligible").agg(F.count_distinct("semantic_key").alias("low_confidence"))
    return c.join(low, how="cross")  # one row each


def adjudication_queue(decisions: DataFrame, reviews: DataFrame, actor: int) -> DataFrame:
    """Decisions with two reviews that ``actor`` neither proposed nor reviewed."""
    ready = _canonical(decisions, reviews).where((F.col("n_reviews") >= 2) & ~F.coalesce(F.col("proposer") == actor, F.lit(False)))
    return ready.join(reviews.where(F.col("actor") == actor).select("decision_id"), "decision_id", "left_anti").select("decision_id", "concept_id", "n_reviews")


def reviewable_runs(decisions: DataFrame) -> DataFrame:
    runs = decisions.where("status = 'PENDING' and eligible").groupBy("run_id").agg(F.max("proposed_at").alias("last_proposed"), F.count(F.lit(1)).alias("n"))
    return runs.orderBy(F.desc("last_proposed"), "run_id")


def agreement(reviews: DataFrame, decisions: DataFrame) -> DataFrame:
    """(domain, pairs, raw_agreement, kappa, approve_votes, reject_votes) over the first two votes of each
    decision, overall and by target table; kappa is null where chance alone agrees always."""
    order = Window.partitionBy("decision_id").orderBy("submitted_at", "review_id")
    two = reviews.withColumn("_n", F.row_number().over(order)).where("_n <= 2").groupBy("decision_id").agg(
        F.max(F.when(F.col("_n") == 1, F.col("verdict"))).alias("a"), F.max(F.when(F.col("_n") == 2, F.col("verdict"))).alias("b")
    )
    pairs = two.where("b is not null").join(decisions.select("decision_id", "target_table"), "decision_id")
    pairs = pairs.withColumn("domain", F.explode(F.array(F.lit("ALL"), F.col("target_table"))))
    n, yes = F.count(F.lit(1)), lambda c: F.count_if(F.col(c) == "APPROVE")
    s = pairs.groupBy("domain").agg(n.alias("pairs"), F.count_if(F.col("a") == F.col("b")).alias("same"), yes("a").alias("ya"), yes("b").alias("yb"))
    observed = F.col("same") / F.col("pairs")
    expected = (F.col("ya") * F.col("yb") + (F.col("pairs") - F.col("ya")) * (F.col("pairs") - F.col("yb"))) / (F.col("pairs") * F.col("pairs"))
    return s.select(
        "domain", "pairs", F.round(observed, 6).alias("raw_agreement"), F.round(F.try_divide(observed - expected, 1 - expected), 6).alias("kappa"),
        (F.col("ya") + F.col("yb")).alias("approve_votes"), (2 * F.col("pairs") - F.col("ya") - F.col("yb")).alias("reject_votes"),
    )


def adjudicate(decisions: DataFrame, reviews: DataFrame, actions: DataFrame, concept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``actions`` (action_id, decision_id, actor, verdict): accepted ones with the decision's final status,
    and the others with the reason. The first acceptable action on a semantic key settles it."""
    voters = reviews.groupBy("decision_id").agg(F.collect_set("actor").alias("voters"), F.count(F.lit(1)).alias("n_reviews"))
    current = concept.where("standard_concept = 'S' and invalid_reason is null").select("concept_id", F.lit(True).alias("_current"))
    d = decisions.select("decision_id", "semantic_key", "proposer", "status", "concept_id").join(current, "concept_id", "left").join(voters, "decision_id", "left")
    n = F.coalesce(F.size("voters"), F.lit(0))
    reason = (
        F.when(F.col("semantic_key").isNull(), "UNKNOWN_DECISION")
        .when(F.col("proposer") == F.col("actor"), "OWN_PROPOSAL")
        .when((n != 2) | (F.col("n_reviews") != 2), "NEEDS_TWO_REVIEWS")
        .when(F.array_contains("voters", F.col("actor")), "NOT_DISTINCT")
        .when(~F.col("status").isin(*OPEN), "NOT_PENDING")
        .when((F.col("verdict") == "APPROVE") & F.col("_current").isNull(), "CONCEPT_NOT_CURRENT")
    )
    judged = actions.join(d, "decision_id", "left").withColumn("reason", reason)
    order = Window.partitionBy("semantic_key").orderBy("action_id")
    fine = judged.where("reason is null").withColumn("reason", F.when(F.row_number().over(order) > 1, "ALREADY_SETTLED"))
    final = F.when(F.col("verdict") == "APPROVE", "APPROVED").otherwise("REJECTED")
    accepted = fine.where("reason is null").select("action_id", "decision_id", "semantic_key", "concept_id", final.alias("status"))
    rejected = judged.where("reason is not null").select("action_id", "decision_id", "reason").unionByName(fine.where("reason is not null").select("action_id", "decision_id", "reason"))
    return accepted, rejected


def publish_decisions(accepted: DataFrame, decisions: DataFrame, code_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next decisions and next code map (semantic_key, concept_id): a settled decision takes its status, open
    ones of the same meaning and concept are superseded, an approval replaces the key's mapping and a rejection of that
    mapping deletes it."""
    mine = accepted.select("decision_id", F.col("status").alias("_own"))
    keys = accepted.select("semantic_key", "concept_id", F.lit(True).alias("_settled")).distinct()
    status = F.coalesce("_own", F.when(F.col("_settled") & F.col("status").isin(*OPEN), "SUPERSEDED"), "status")
    after = decisions.join(mine, "decision_id", "left").join(keys, ["semantic_key", "concept_id"], "left").withColumn("status", status).select(*decisions.columns)
    approved = accepted.where("status = 'APPROVED'").select("semantic_key", "concept_id")
    rejected = accepted.where("status = 'REJECTED'").select("semantic_key", "concept_id")
    kept = code_map.join(approved, "semantic_key", "left_anti").join(rejected, ["semantic_key", "concept_id"], "left_anti")
    return after, kept.unionByName(approved)


def publish_policies(accepted: DataFrame, approved: DataFrame, policies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next approved set (semantic_key, concept_id, decision_id, active) and next rejection policies (semantic_key,
    concept_id, active). An approval takes its key's place in the set and rests the policy against its concept; a
    rejection makes or wakes that policy and rests the approved row of its concept."""
    on, off, pair = F.lit(True), F.lit(False), ["semantic_key", "concept_id"]
    yes, no = accepted.where("status = 'APPROVED'"), accepted.where("status = 'REJECTED'")

    def rested(rows: DataFrame, by: DataFrame) -> DataFrame:
        hit = by.select(*pair, on.alias("_hit")).distinct()
        return rows.join(hit, pair, "left").withColumn("active", F.when(F.col("_hit"), off).otherwise(F.col("active"))).select(*rows.columns)

    kept = rested(approved.join(yes, "semantic_key", "left_anti"), no)
    next_approved = kept.unionByName(yes.select(*pair, "decision_id", on.alias("active")))
    next_policies = rested(policies.join(no, pair, "left_anti"), yes).unionByName(no.select(*pair, on.alias("active")).distinct())
    return next_approved, next_policies


def publish_provenance(accepted: DataFrame, published: DataFrame, provenance: DataFrame) -> DataFrame:
    """``provenance`` (decision_id, reviewed_by) after ``publish_decisions`` gave ``published``: open marks of settled
    and superseded decisions change, others stay."""
    own = accepted.select("decision_id", "status")
    over = published.where("status = 'SUPERSEDED'").select("decision_id", "status").join(own, "decision_id", "left_anti")
    mark = F.coalesce(*[F.when(F.col("_status") == s, F.lit(m)) for s, m in MARKS.items()])
    rows = provenance.join(own.unionByName(over).withColumnRenamed("status", "_status"), "decision_id", "left")
    return rows.withColumn("reviewed_by", F.when(F.col("reviewed_by").isin(*OPEN_MARKS), F.coalesce(mark, "reviewed_by")).otherwise(F.col("reviewed_by"))).select(*provenance.columns)


def counterproposals(decisions: DataFrame, reviews: DataFrame, claims: DataFrame, events: DataFrame, concept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``claims`` (decision_id, actor, new_concept_id) on rejected decisions by a person who voted to reject,
    with another, current concept: new decisions, and the events (decision_id, event_id) that they
    carry over, each once."""
    rejected = decisions.where("status = 'REJECTED'").select("decision_id", "concept_id")
    voted = reviews.where("verdict = 'REJECT'").select("decision_id", "actor").distinct()
    current = concept.where("standard_concept = 'S' and invalid_reason is null").select(F.col("concept_id").alias("new_concept_id"))
    good = claims.join(rejected, "decision_id").where("new_concept_id <> concept_id").join(voted, ["decision_id", "actor"], "left_semi").join(current, "new_concept_id", "left_semi")
    made = good.select("decision_id", "actor", "new_concept_id").distinct()
    order = Window.partitionBy("event_id", "new_concept_id").orderBy("decision_id", "actor")
    carried = events.join(made, "decision_id").withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return made, carried.select("event_id", "decision_id", "actor", "new_concept_id")


def resolve_source(claims: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``claims`` (claim_id, adapter, system) with the one active vocabulary of ``registry`` (adapter, system,
    vocabulary_id, active); claims with none or several are refused."""
    active = registry.where("active").groupBy("adapter", "system").agg(F.count(F.lit(1)).alias("_n"), F.min("vocabulary_id").alias("vocabulary_id"))
    both = claims.join(active, ["adapter", "system"], "left")
    reason = F.when(~F.col("adapter").rlike("^[a-z0-9][a-z0-9_-]*$"), "BAD_ADAPTER").when(F.col("_n").isNull(), "NOT_REGISTERED").when(F.col("_n") > 1, "AMBIGUOUS")
    judged = both.withColumn("reason", reason)
    return judged.where("reason is null").select("claim_id", "adapter", "system", "vocabulary_id"), judged.where("reason is not null").select("claim_id", "reason")


def apply_registry(registry: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Register and deactivate ``actions`` (action_id, adapter, system, vocabulary_id, kind) in order: the next
    registry, and (action_id, outcome). A pair has one active vocabulary at most. Only a pair's last
    change matters for the next state, so each action needs just the change before it."""
    pair = ["adapter", "system"]
    now = registry.where("active").select(*pair, F.col("vocabulary_id").alias("_now"))
    # between two deactivations, the first registration holds, or before any the one that was active
    earlier = Window.partitionBy(*pair).orderBy("action_id").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("kind") == "DEACTIVATE", 1).otherwise(0)
    rows = actions.join(now, pair, "left").withColumn("_part", F.coalesce(F.sum(ends).over(earlier), F.lit(0)))
    within = Window.partitionBy(*pair, "_part").orderBy("action_id").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.when(F.col("kind") == "REGISTER", F.col("vocabulary_id"))
    start = F.when(F.col("_part") == 0, F.col("_now"))
    rows = rows.withColumn("_held", F.coalesce(start, F.first(wanted, ignorenulls=True).over(within)))
    held = F.col("_held")
    outcome = (
        F.when((F.col("kind") == "REGISTER") & held.isNull(), "REGISTERED")
        .when((F.col("kind") == "REGISTER") & (held == F.col("vocabulary_id")), "UNCHANGED")
        .when(F.col("kind") == "REGISTER", "CONFLICT")
        .when(held.isNull(), "NOT_ACTIVE")
        .otherwise("DEACTIVATED")
    )
    judged = rows.withColumn("outcome", outcome)
    outcomes = judged.select("action_id", "outcome")
    after = F.when(F.col("outcome") == "REGISTERED", F.col("vocabulary_id")).when(F.col("kind") == "REGISTER", held)
    final = judged.groupBy(*pair).agg(F.max_by(after, "action_id").alias("_held"), F.lit(True).alias("_touched"))
    old = registry.join(final, ["adapter", "system"], "left").withColumn("active", F.when(F.col("_touched"), F.col("vocabulary_id").eqNullSafe(F.col("_held"))).otherwise(F.col("active"))).select(*registry.columns)
    fresh = final.where("_held is not null").select("adapter", "system", F.col("_held").alias("vocabulary_id"), F.lit(True).alias("active"))
    known = registry.select("adapter", "system", "vocabulary_id")
    return old.unionByName(fresh.join(known, ["adapter", "system", "vocabulary_id"], "left_anti")), outcomes


def bind_events(claims: DataFrame, decisions: DataFrame, events: DataFrame, policy: DataFrame, bindings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``claims`` (record_key, decision_id, event_id) of resolved sources: bound rows, a repeated binding
    among them, and refused ones with the first reason against them."""
    b = bindings.select("record_key", F.col("decision_id").alias("_b_decision"), F.col("event_id").alias("_b_event"))
    d = decisions.select("decision_id", F.col("record_key").alias("_d_key"), F.col("concept_id").alias("_d_concept"), "status", "eligible", F.col("code").alias("_d_code"))
    e = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"), F.max("concept_id").alias("_e_concept"), F.max("code").alias("_e_code"))
    p = policy.select(F.col("concept_id").alias("_d_concept"), F.lit(True).alias("_refused")).distinct()
    all_ = claims.join(b, "record_key", "left").join(d, "decision_id", "left").join(e, "event_id", "left").join(p, "_d_concept", "left")
    again = F.coalesce((F.col("_b_decision") == F.col("decision_id")) & (F.col("_b_event") == F.col("event_id")), F.lit(False))
    reason = (
        F.when(F.col("_b_decision").isNotNull() & ~again, "CONFLICTING_BINDING")
        .when(F.col("_d_key").isNull(), "UNKNOWN_DECISION")
        .when(F.col("_d_key") != F.col("record_key"), "OTHER_SOURCE")
        .when(~again & F.col("eligible"), "ALREADY_ELIGIBLE")
        .when(F.col("_d_concept") <= 0, "NOT_A_SELECTION")
        .when(F.col("_refused"), "REJECTION_POLICY")
        .when(F.col("_n").isNull() | (F.col("_n") != 1), "EVENT_NOT_UNIQUE")
        .when(~again & (F.col("_e_concept") != 0), "EVENT_MAPPED")
        .when(~F.col("_e_code").eqNullSafe(F.col("_d_code")), "SOURCE_DIFFERS")
    )
    judged = all_.withColumn("reason", F.when(again, None).otherwise(reason)).withColumn("again", again)
    return judged.where("reason is null").select("record_key", "decision_id", "event_id", "again"), judged.where("reason is not null").select("record_key", "reason")


def handoff(receipts: DataFrame, runs: DataFrame, bound: DataFrame, refused: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per receipt (receipt_id, run_id, manifest, record_key) an outcome and code, and counts by outcome. A
    receipt of a run that failed or has another manifest fails before binding counts."""
    r = runs.select("run_id", F.col("status").alias("_run"), F.col("manifest").alias("_manifest"))
    b = bound.select("record_key", "again", F.lit(True).alias("_bound"))
    all_ = receipts.join(r, "run_id", "left").join(b, "record_key", "left").join(refused, "record_key", "left")
    code = (
        F.when(F.col("_run").isNull(), "UNKNOWN_RUN")
        .when(F.col("_run") != "SUCCESS", "RUN_FAILED")
        .when(F.col("_manifest") != F.col("manifest"), "MANIFEST_DIFFERS")
        .when(F.col("_bound").isNull(), F.coalesce("reason", F.lit("NOT_BOUND")))
    )
    outcome = F.when(F.col("code").isNotNull(), "FAILED").when(F.col("again"), "ALREADY_BOUND").otherwise("BOUND")
    out = all_.withColumn("code", code).select("receipt_id", outcome.alias("outcome"), "code")
    return out, out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def handoff_batches(receipts: DataFrame, most: int, namespace: uuid.UUID, prefix: str) -> DataFrame:
    """(batch, n, violation, batch_id) of ``receipts`` (batch, receipt_id, run_id, manifest, record_key, target_table,
    target_id): the first fault of a batch, or else its id, the version 5 UUID of ``prefix`` and its sorted receipt ids.
    Ids are gathered only where the batch has ``most`` receipts at most."""
    several = lambda *c: F.count_distinct(F.struct(*c))
    counts = receipts.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), several("run_id", "manifest").alias("_runs"), several("record_key").alias("_records"), several("target_table", "target_id").alias("_events")
    )
    violation = (
        F.when(F.col("n") > most, "TOO_MANY")
        .when(F.col("_runs") > 1, "MANY_RUNS")
        .when(F.col("_records") < F.col("n"), "DUPLICATE_RECORD")
        .when(F.col("_events") < F.col("n"), "DUPLICATE_EVENT")
    )
    judged = counts.select("batch", "n", violation.alias("violation"))
    good = receipts.join(judged.where("violation is null"), "batch", "left_semi")
    named = good.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(F.col("receipt_id").cast("string"))), "|").alias("_ids"))
    return judged.join(named.select("batch", uuid5(namespace, F.concat(F.lit(prefix), "_ids")).alias("batch_id")), "batch", "left")


def bindable_decisions(receipts: DataFrame, decisions: DataFrame) -> DataFrame:
    """(receipt_id, decision_id, reason): the one decision of a receipt's source, record and table that selects a concept
    before ingestion and isn't eligible yet; none and several are reasons."""
    keys = ["source_adapter", "record_key", "target_table"]
    open_ = decisions.where(F.col("status").isin(*BEFORE_INGESTION) & ~F.coalesce("eligible", F.lit(False)) & (F.col("model_decision") == "SELECT"))
    one = open_.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("decision_id").alias("_id"))
    n = F.coalesce("_n", F.lit(0))
    reason = F.when(n == 0, "NO_DECISION").when(n > 1, "MANY_DECISIONS")
    return receipts.join(one, keys, "left").select("receipt_id", F.when(n == 1, F.col("_id")).alias("decision_id"), reason.alias("reason"))


def resolve_actors(names: DataFrame, aliases: DataFrame, roles: DataFrame, role: str) -> DataFrame:
    """``names`` (name) with the actor whose exact alias it is, if they have the role."""
    a = aliases.select("alias", "actor_id")
    holders = roles.where(F.col("role") == role).select("actor_id")
    return names.join(a, F.lower(F.trim("name")) == F.col("alias")).join(holders, "actor_id", "left_semi").select("name", "actor_id")


def actor_roles(roles: DataFrame) -> DataFrame:
    return roles.groupBy("actor_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))
