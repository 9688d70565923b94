"""Retrieval of candidate concepts and the decisions made on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.functions.text import AXES, actor_key, alias_key, axes, jaro_winkler, sequence_ratio
from clinloom.session import ship_package, store

#: Queries that a task holds at once, and rows that they meet at once.
QUERY_BLOCK, ROWS_AT_ONCE = 4_096, 512
#: Rows, about, of each side of a cell where every row is a query.
CELL_ROWS = 32_768


def expand_aliases(terms: DataFrame, lexicon: DataFrame, synthetic: bool = True) -> DataFrame:
    """``terms`` (term, target_table) with retrieval_text and alias_id: the expansion (alias_id, alias,
    expansion) of a measurement's exact alias; other terms, and all of them where the lexicon's scope does
    not hold, stay as they are."""
    known = lexicon.select(alias_key("alias").alias("_key"), "alias_id", "expansion")
    key = F.when((F.col("target_table") == "measurement") & F.lit(synthetic), alias_key("term"))
    joined = terms.withColumn("_key", key).join(known, "_key", "left")
    return joined.select(*terms.columns, F.coalesce("expansion", "term").alias("retrieval_text"), "alias_id")


def as_matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows; null ones and those of another length are zero."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
    rows = np.zeros((len(column), width))
    rows[fits.to_numpy(zero_copy_only=False)] = column.filter(fits).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return rows


def cosine_topk(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(query_id, item_id, distance, rank): the k nearest rows of ``index`` (item_id, vector) to each of
    ``queries`` (query_id, vector), by cosine, ties by id. Queries go block by block to every task, which
    keeps its k best of each, so what is shuffled is k rows a query and task; a zero or null vector is
    at distance 1."""
    spark = index.sparkSession
    result, block = None, []

    def search(ids, vectors):
        shared = spark.sparkContext.broadcast((ids, vectors))

        def run(batches):
            ids, q = shared.value
            best_s = np.full((len(ids), 0), 0.0)
            best_i = np.zeros((len(ids), 0), np.int64)
            for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
                v = as_matrix(batch.column(1), q.shape[1])
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                s = q @ (v / np.where(norm == 0, 1, norm)).T
                best_s = np.concatenate([best_s, s], axis=1)
                best_i = np.concatenate([best_i, np.broadcast_to(batch.column(0).to_numpy(), s.shape)], axis=1)
                order = np.lexsort((best_i, -np.round(best_s, 12)), axis=1)[:, :k]
                best_s, best_i = np.take_along_axis(best_s, order, 1), np.take_along_axis(best_i, order, 1)
            n = best_s.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(best_i.ravel()), pa.array(1 - best_s.ravel())], names=["query_id", "item_id", "distance"])

        return index.select("item_id", "vector").mapInArrow(run, "query_id long, item_id long, distance double")

    def finish():
        nonlocal result, block
        vectors = np.array([b[1] for b in block], float)
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        one = search(np.array([b[0] for b in block], np.int64), vectors / np.where(norm == 0, 1, norm))
        result = one if result is None else result.unionByName(one)
        block = []

    for row in queries.select("query_id", "vector").where("vector is not null").toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == QUERY_BLOCK:
            finish()
    if block:
        finish()
    if result is None:
        return spark.createDataFrame([], "query_id long, item_id long, distance double, rank int")
    order = Window.partitionBy("query_id").orderBy(F.round("distance", 12), "item_id")
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_others(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, item_id, distance, rank): as ``cosine_topk`` with each of ``rows`` (item_id, vector) for a query, but for the rows
    of its own id. Every pair is met: both sides are cut into parts of about ``CELL_ROWS``, and a task meets a part of the
    queries with a part of the rows. So the work is quadratic, a task holds two parts and some pairs of them, nothing goes
    through the driver, and what is shuffled is each row twice a part and k rows a query and part."""
    ship_package(rows.sparkSession)
    rows = rows.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "vector")
    parts = max(1, -(-rows.count() // CELL_ROWS))
    cells = min(parts * parts, 10_000)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("item_id", "vector"), F.lit(parts)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = rows.where("vector is not null").withColumnRenamed("_part", "_q").withColumn("_i", other).repartition(cells, "_q", "_i")
    met = rows.withColumnRenamed("_part", "_i").withColumn("_q", other).repartition(cells, "_q", "_i")

    def search(asked: pa.Table, met: pa.Table) -> pa.Table:
        ids, items = (t.column("item_id").to_numpy() for t in (asked, met))
        width = pc.max(pc.list_value_length(asked.column("vector"))).as_py() or 0
        q, v = (as_matrix(t.column("vector").combine_chunks(), width) for t in (asked, met))
        for m in (q, v):
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            m /= np.where(norm == 0, 1, norm)
        most, step = min(k, len(items)), max(1, QUERY_BLOCK * ROWS_AT_ONCE // max(1, len(items)))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in range(0, len(ids) if most else 0, step):
            own = ids[at : at + step]
            d = np.round(1 - q[at : at + step] @ v.T, 12)
            d[own[:, None] == items] = np.inf
            # the k best of each and what ties with the last of them, in order; no number comes after all others
            row, col = np.nonzero(~(d > np.partition(d, most - 1, axis=1)[:, most - 1, None]) & (d != np.inf))
            order = np.lexsort((items[col], d[row, col], row))
            row, col = row[order], col[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, col = row[best], col[best]
            found.append((own[row], items[col], d[row, col]))
        return pa.table(dict(zip(("query_id", "item_id", "distance"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    best = asked.groupBy("_q", "_i").cogroup(met.groupBy("_q", "_i")).applyInArrow(search, "query_id long, item_id long, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "item_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rerank(candidates: DataFrame, k: int) -> DataFrame:
    """``candidates`` (term_id, term, item_id, name, similarity, rank) reranked by axes: 0.08 more for each
    axis in common, 0.35 less for each in conflict; ties keep their order, and the similarity stays."""
    # the patterns run once a distinct text, over all tasks
    texts = candidates.select(F.explode(F.array("term", "name")).alias("_text")).where("_text is not null").distinct()
    known = store(texts.select("_text", axes(F.col("_text")).alias("_axes")), "axes")
    of = lambda text, axis: known.withColumnsRenamed({"_text": text, "_axes": axis})
    rows = candidates.join(of("term", "_s"), "term", "left").join(of("name", "_c"), "name", "left")
    score = F.col("similarity")
    for axis in AXES:
        ours, theirs = F.col(f"_s.{axis}"), F.col(f"_c.{axis}")
        # a term without a text has no axes
        score = score + F.when(ours.isNull() | (F.size(ours) == 0), 0.0).when(F.arrays_overlap(ours, theirs), 0.08).when(F.size(theirs) > 0, -0.35).otherwise(0.0)
    rows = rows.withColumn("rerank_score", F.round(score, 6))
    order = Window.partitionBy("term_id").orderBy(F.desc("rerank_score"), "rank")
    return rows.withColumn("new_rank", F.row_number().over(order)).where(F.col("new_rank") <= k).drop("_s", "_c")


#: Terms of a worklist, and names of a register, that meet all rows at once, about; more come in blocks.
BLOCK_TERMS, BLOCK_NAMES = 20_000, 50_000


def _letters(words: list[str]) -> np.ndarray:
    """How often each of 64 classes of characters stands in each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) % 64
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(owner * 64 + points, minlength=64 * len(words)).reshape(-1, 64).astype(np.int16)


class _Nearest:
    """The k best names of each term so far. A pair is scored only if letters in common, lengths and leading
    characters leave it a chance against the term's k-th score."""

    def __init__(self, terms: list[tuple[int, str]], k: int):
        self.terms, self.k = terms, k
        self.count, self.size = _letters([t for _, t in terms]), np.array([len(t) for _, t in terms])
        self.best: list[list[tuple[float, int, str]]] = [[] for _ in terms]

    def add(self, items: list[int], names: list[str]) -> None:
        count, size = _letters(names), np.array([len(n) for n in names])
        heads = [np.array([n[:j].ljust(j, "\0") for n in names], object) for j in range(1, 5)]
        for t, (_, term) in enumerate(self.terms):
            m = np.minimum(count, self.count[t]).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                most = np.where(m > 0, (m / size + m / max(1, self.size[t]) + 1) / 3, 0.0)
            most = np.where((size == 0) & (self.size[t] == 0), 1.0, most)
            lead = sum((heads[j - 1] == term[:j]).astype(int) if len(term) >= j else 0 for j in range(1, 5))
            most = most + 0.1 * lead * (1 - most) + 1e-9
            best = self.best[t]
            for i in np.argsort(-most, kind="stable").tolist():
                if len(best) >= self.k and most[i] < -best[self.k - 1][0] - 1e-6:
                    break
                best.append((-round(jaro_winkler(term, names[i]), 6), items[i], names[i]))
                best.sort()
                del best[self.k :]


def _blocks(rows: DataFrame, key: str, size: int) -> Iterator[list]:
    """``rows`` in blocks of about ``size``, by a hash of ``key``, one at a time on the driver."""
    rows = store(rows, "worklist")
    many = -(-rows.count() // size)
    for b in range(many):
        yield rows.where(F.pmod(F.xxhash64(key), F.lit(many)) == b).collect()


def jaro_winkler_topk(terms: DataFrame, slice_: DataFrame, k: int) -> DataFrame:
    """(term_id, item_id, score, rank): the k most similar names of ``slice_`` (item_id, name) for each of
    ``terms`` (term_id, term), ties by item_id. Each distinct term meets each distinct name once; of a name's items only
    the k least can be among the best. Distinct terms go in blocks of about ``BLOCK_TERMS``, each of which meets all distinct
    names in one pass; a task sends on its k best names of each."""
    spark = slice_.sparkSession
    named = slice_.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.trim("name")).alias("name")).where("name is not null")
    asked = terms.select(F.col("term_id").cast("long").alias("term_id"), F.lower(F.trim("term")).alias("term")).where("term_id is not null and term is not null")
    least = Window.partitionBy("name").orderBy("item_id")
    items = store(named.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k), "items")
    # a name stands for its least item: the k best items are those of the k best names, ties by that item
    heads = items.where("_n = 1").select("item_id", "name")
    found = spark.createDataFrame([], "term string, name string, score double")
    for block in _blocks(asked.select("term").distinct(), "term", BLOCK_TERMS):
        found = found.unionByName(_nearest_names(spark.sparkContext.broadcast([r[0] for r in block]), heads, k))
    order = Window.partitionBy("term").orderBy(F.desc("score"), "item_id")
    best = found.join(items.drop("_n"), "name").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(best, "term").select("term_id", "item_id", "score", "rank")


def _nearest_names(shared: Broadcast, named: DataFrame, k: int) -> DataFrame:
    def run(batches):
        nearest = _Nearest(list(enumerate(shared.value)), k)
        for batch in batches:
            if batch.num_rows and nearest.terms:
                nearest.add(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        rows = [(term, name, -score) for (_, term), best in zip(nearest.terms, nearest.best, strict=True) for score, _, name in best]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64()), strict=True)], names=["term", "name", "score"])

    return named.mapInArrow(run, "term string, name string, score double")


def threshold_decision(exact: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """``exact`` (case_id, decision, concept_id) first; where it abstains, the first candidate (case_id,
    item_id, score, rank) if it reaches the threshold."""
    first = candidates.where("rank = 1").select("case_id", F.col("item_id").alias("_id"), F.col("score").alias("_score"))
    both = exact.join(first, "case_id", "left")
    own, near = F.col("decision") == "MAP", F.coalesce(F.col("_score") >= threshold, F.lit(False))
    return both.select(
        "case_id",
        F.when(own | near, "MAP").otherwise("ABSTAIN").alias("decision"),
        F.when(own, F.col("concept_id")).when(near, F.col("_id")).alias("concept_id"),
        F.when(own, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
        F.when(own, "EXACT_CODE").when(near, "CANDIDATE").otherwise("NONE").alias("method"),
    )


RESPONSE = "decision string, selected_concept_id string, confidence string, reason string, clinical_signals string"
_RESPONSE_KEYS = ("clinical_signals", "confidence", "decision", "reason", "selected_concept_id")


def validate_decisions(responses: DataFrame) -> DataFrame:
    """``responses`` (term_id, content, candidates: array of ids) under the reply's contract: term_id,
    decision, concept_id, confidence, reason, signals and error. A reply that breaks it is an
    abstention with confidence 0 and the first rule it broke."""
    raw = lambda key: F.get_json_object("content", f"$.{key}")
    # get_json_object drops quotes, so strings are told from numbers by the variant's type
    kind = lambda key: F.schema_of_variant(F.try_variant_get("_v", f"$.{key}", "variant"))
    keys = F.array_sort(F.json_object_keys("content"))
    number = F.expr("try_cast(get_json_object(content, '$.confidence') as double)")
    signals = F.from_json(raw("clinical_signals"), "array<string>")
    numeric = kind("confidence").rlike("^(BIGINT|DOUBLE|DECIMAL|TINYINT|SMALLINT|INT|FLOAT)")
    selected = F.expr("try_cast(get_json_object(content, '$.selected_concept_id') as long)")
    no_id = kind("selected_concept_id") == "VOID"
    error = (
        F.when(F.col("_v").isNull(), "NOT_JSON")
        .when(~keys.eqNullSafe(F.array(*map(F.lit, _RESPONSE_KEYS))), "SCHEMA")
        .when(~((kind("decision") == "STRING") & raw("decision").isin("SELECT", "ABSTAIN")), "DECISION")
        .when(~numeric, "CONFIDENCE_NOT_NUMERIC")
        .when(~F.coalesce(number.between(0, 1), F.lit(False)), "CONFIDENCE_RANGE")
        .when((kind("reason") != "STRING") | (F.trim(raw("reason")) == ""), "REASON_EMPTY")
        .when(F.length(raw("reason")) > 300, "REASON_LONG")
        .when(~kind("clinical_signals").rlike("^ARRAY<(STRING|VOID)>") | (F.size(signals) > 6) | F.exists(signals, lambda s: s.isNull() | (F.trim(s) == "") | (F.length(s) > 100)), "SIGNALS")
        .when((raw("decision") == "ABSTAIN") & ~no_id, "ABSTAIN_WITH_ID")
        .when((raw("decision") == "SELECT") & ~F.coalesce(kind("selected_concept_id").rlike("INT") & F.array_contains("candidates", selected), F.lit(False)), "NOT_A_CANDIDATE")
    )
    judged = responses.withColumn("_v", F.try_parse_json("content")).withColumn("error", error)
    good = F.col("error").isNull()
    return judged.select(
        "term_id",
        F.when(good, raw("decision")).otherwise("ABSTAIN").alias("decision"),
        F.when(good & (raw("decision") == "SELECT"), selected).alias("concept_id"),
        F.when(good, number).otherwise(0.0).alias("confidence"),
        F.when(good, F.trim(raw("reason"))).otherwise("INVALID_RESPONSE").alias("reason"),
        F.when(good, F.transform(signals, F.trim)).otherwise(F.array().cast("array<string>")).alias("signals"),
        "error",
    )


def governed_score(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Selections (term_id, concept_id, confidence) met with their candidate (term_id, item_id, similarity):
    the smaller of both scores, to four places."""
    c = candidates.select("term_id", F.col("item_id").alias("concept_id"), "similarity")
    return decisions.where("concept_id is not null").join(c, ["term_id", "concept_id"]).withColumn("governed_score", F.round(F.least("similarity", "confidence"), 4))


def proposal_status(score: Column, rejected: Column, review_threshold: float = 0.80) -> Column:
    return F.when(rejected, "REJECTED").when(score >= review_threshold, "PENDING").otherwise("LOW_CONFIDENCE")


def record_proposals(scored: DataFrame, affected: DataFrame, policy: DataFrame, review_threshold: float = 0.80) -> tuple[DataFrame, DataFrame]:
    """Decisions (term_id, concept_id, governed_score, status) and a provenance row for each affected event
    (term_id, event_id); a scoped rejection policy (term_id, concept_id) makes a proposal rejected."""
    p = policy.select("term_id", "concept_id", F.lit(True).alias("_rejected")).distinct()
    decisions = scored.join(p, ["term_id", "concept_id"], "left").withColumn("status", proposal_status(F.col("governed_score"), F.col("_rejected").isNotNull(), review_threshold))
    decisions = decisions.select("term_id", "concept_id", "governed_score", "status")
    return decisions, affected.join(decisions, "term_id").select("event_id", "term_id", "concept_id", "status")


def record_abstentions(terms: DataFrame, affected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Abstentions of terms, never publishable, and their provenance."""
    decisions = terms.select("term_id", F.lit(0).alias("concept_id"), F.lit("ABSTAINED").alias("status"), F.lit(False).alias("publication_eligible"))
    return decisions, affected.join(decisions, "term_id").select("event_id", "term_id", "status")


def record_external(rows: DataFrame, threshold: float) -> DataFrame:
    """Decisions on records that are not ingested yet (record_key, concept_id, similarity): not publishable,
    under a negative stand-in for the event's id."""
    digest = F.conv(F.substring(F.sha2(F.col("record_key").cast("binary"), 256), 1, 15), 16, 10).cast("long")
    status = F.when(F.col("similarity") >= threshold, "PENDING").otherwise("LOW_CONFIDENCE")
    return rows.select("record_key", (-digest - 1).alias("event_id"), "concept_id", status.alias("status"), F.lit(False).alias("publication_eligible"))


def suggestions(abstained: DataFrame, candidates: DataFrame, floor: float = 0.80) -> DataFrame:
    """Candidates of abstained terms worth a look."""
    return candidates.join(abstained.select("term_id"), "term_id", "left_semi").where(F.col("similarity") >= floor)


def suggestion_queue(ledger: DataFrame) -> DataFrame:
    """The latest entry (seen_at, entry_id) of each term and item, best first."""
    order = Window.partitionBy("term_id", "item_id").orderBy(F.desc("seen_at"), F.desc("entry_id"))
    return ledger.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n").orderBy(F.desc("similarity"), "term_id", "item_id")


def approved_examples(approved: DataFrame, n: int, exclude: DataFrame | None = None) -> DataFrame:
    """The first approval (approved_at, row_id) of each term key and concept, n of them in order; terms of
    ``exclude`` (term) are left out."""
    rows = approved.withColumn("term_key", F.lower(F.trim("term")))
    if exclude is not None:
        rows = rows.join(exclude.select(F.lower(F.trim("term")).alias("term_key")), "term_key", "left_anti")
    order = Window.partitionBy("term_key", "concept_id").orderBy("approved_at", "row_id")
    first = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return first.select("term_key", "concept_id", "approved_at", "row_id").orderBy("approved_at", "row_id").limit(n)


def suggest_actors(names: DataFrame, aliases: DataFrame, threshold: float = 0.84) -> DataFrame:
    """Possible identities (name, actor_id, similarity) of ``names`` among ``aliases`` (actor_id, alias): the
    sequence ratio of their keys, at least 0.96 with first and last token in common and 0.92 where one's
    tokens are a part of the other's. The register's keys are sent in blocks of about ``BLOCK_NAMES``, each of which meets
    every distinct name once; lengths, compared in the JVM, leave fewer pairs to match."""
    left = names.select("name", actor_key("name").alias("_a")).where("_a <> ''")
    right = aliases.select("actor_id", actor_key("alias").alias("_b")).distinct()
    asked = store(left.select("_a").distinct(), "names")
    scored = names.sparkSession.createDataFrame([], "_a string, _b string, similarity double")
    for block in _blocks(right.select("_b").distinct(), "_b", BLOCK_NAMES):
        scored = scored.unionByName(_alike(asked, names.sparkSession.createDataFrame(block, "_b string"), threshold))
    found = left.join(scored, "_a").join(right, "_b")
    return found.groupBy("name", "actor_id").agg(F.round(F.max("similarity"), 6).alias("similarity"))


def _alike(asked: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    both = asked.crossJoin(F.broadcast(known)).withColumns({"_x": F.split("_a", " "), "_y": F.split("_b", " ")})
    two = (F.size("_x") >= 2) & (F.size("_y") >= 2)
    edges = two & (F.get("_x", F.lit(0)) == F.get("_y", F.lit(0))) & (F.element_at("_x", -1) == F.element_at("_y", -1))
    inside = ((F.size("_x") >= 2) & (F.size(F.array_except("_x", "_y")) == 0)) | ((F.size("_y") >= 2) & (F.size(F.array_except("_y", "_x")) == 0))
    # lengths alone bound the ratio, so most pairs are never compared
    short, long_ = F.least(F.length("_a"), F.length("_b")), F.greatest(F.length("_a"), F.length("_b"))
    chance = (2.0 * short / (short + long_) >= threshold) | edges | inside
    near = both.where(chance).withColumns({"_edges": edges, "_inside": inside})
    score = F.greatest(sequence_ratio("_a", "_b"), F.when(F.col("_edges"), 0.96).otherwise(0.0), F.when(F.col("_inside"), 0.92).otherwise(0.0))
    return near.select("_a", "_b", score.alias("similarity")).where(F.col("similarity") >= threshold)
