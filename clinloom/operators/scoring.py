"""Mapping coverage and accuracy, selective prediction, calibration and thresholds.

Cases and predictions meet in one table: case_id, domain, split, expected_decision (MAP or ABSTAIN),
expected_id, decision, concept_id and score; raw_decision and raw_id are a prediction before any threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("expected_map", "expected_abstain", "accepted", "correct_map", "wrong_map", "false_map", "correct_abstain", "missed_map", "correct")
BIN_EDGES = (0.0, 0.6, 0.7, 0.8, 0.9, 1.000001)


def share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole), 6)


def mapping_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, total, mapped) for each table with concept_id."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("concept_id") != 0).alias("mapped")).select(F.lit(name).alias("table_name"), "total", "mapped")
        out = row if out is None else out.unionByName(row)
    return out


def decision_counts(decisions: DataFrame, reviews: DataFrame, adjudications: DataFrame, run_id: str) -> DataFrame:
    """(kind, target_table, status, n) of a run: its ``decisions`` (decision_id, run_id, target_table, status) by table
    and status, and in a row each the active ``reviews`` (decision_id, active; null is active) and the
    ``adjudications`` (decision_id) of them."""
    own = decisions.where(F.col("run_id") == run_id)
    counts = own.groupBy("target_table", "status").agg(F.count(F.lit(1)).alias("n")).select(F.lit("decision").alias("kind"), "target_table", "status", "n")
    ids, none = own.select("decision_id").distinct(), F.lit(None).cast("string")
    for kind, rows in (("review", reviews.where(F.coalesce("active", F.lit(True)))), ("adjudication", adjudications)):
        n = rows.join(ids, "decision_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(n.select(F.lit(kind).alias("kind"), none.alias("target_table"), none.alias("status"), "n"))
    return counts


def mapping_accuracy(truth: DataFrame, events: DataFrame) -> DataFrame:
    """Coverage, precision and recall in percent against every row of ``truth`` (event_id, true_id)."""
    both = truth.join(events.select("event_id", "concept_id"), "event_id", "left")
    counts = both.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("concept_id") != 0).alias("mapped"), F.count_if(F.col("concept_id") == F.col("true_id")).alias("correct")
    )
    percent = lambda a, b: F.coalesce(F.round(100 * F.try_divide(F.col(a).cast("double"), F.col(b)), 6), F.lit(0.0))
    return counts.select("*", percent("mapped", "total").alias("coverage"), percent("correct", "mapped").alias("precision"), percent("correct", "total").alias("recall"))


def flag_columns(decision: Column, concept: Column) -> dict[str, Column]:
    """The nine outcome flags of a case (expected_decision, expected_id)."""
    expected, accepted = F.col("expected_decision") == "MAP", decision == "MAP"
    right = F.coalesce(concept == F.col("expected_id"), F.lit(False))
    values = (
        expected, ~expected, accepted, expected & accepted & right, expected & accepted & ~right, ~expected & accepted, ~expected & ~accepted, expected & ~accepted,
        (expected & accepted & right) | (~expected & ~accepted),
    )
    return dict(zip(FLAGS, values, strict=True))


def flags(cases: DataFrame) -> DataFrame:
    """``cases`` with the nine outcome flags."""
    return cases.withColumns(flag_columns(F.col("decision"), F.col("concept_id")))


def summed(flagged: DataFrame, *keys: str) -> DataFrame:
    """Counts and rates of flagged cases by ``keys``."""
    return with_rates(flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(f).alias(f) for f in FLAGS]))


def with_rates(counts: DataFrame) -> DataFrame:
    c = F.col
    return counts.withColumns(
        {
            "coverage": F.coalesce(share(c("accepted"), c("total")), F.lit(0.0)),
            "accepted_precision": share(c("correct_map"), c("accepted")),
            "mappable_recall": share(c("correct_map"), c("expected_map")),
            "abstain_accuracy": share(c("correct_abstain"), c("expected_abstain")),
            "overall_accuracy": F.coalesce(share(c("correct"), c("total")), F.lit(0.0)),
        }
    )


def score(cases: DataFrame) -> DataFrame:
    """Overall, by domain and by split: (scope, value, total, flags, rates). One pass over the cases."""
    scopes = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), v.alias("value")) for s, v in (("all", F.lit("")), ("domain", F.col("domain")), ("split", F.col("split")))]))
    return summed(flags(cases).withColumn("_s", scopes).select("*", "_s.*"), "scope", "value")


def retrieval_metrics(cases: DataFrame, concept: DataFrame) -> DataFrame:
    """By domain: expected maps, hits among the candidates, recall, and accepted targets of another domain or
    none that is current."""
    target = concept.select(F.col("concept_id").alias("_id"), F.col("domain_id").alias("_domain"), ((F.col("standard_concept") == "S") & F.col("invalid_reason").isNull()).alias("_valid"))
    both = cases.join(target, F.col("concept_id") == F.col("_id"), "left")
    expected, accepted = F.col("expected_decision") == "MAP", F.col("decision") == "MAP"
    hit = F.coalesce(F.array_contains("candidates", F.col("expected_id")), F.lit(False))
    counts = both.groupBy("domain").agg(
        F.count_if(expected).alias("expected_maps"),
        F.count_if(expected & hit).alias("hits"),
        F.count_if(accepted & ~F.col("_domain").eqNullSafe(F.col("domain"))).alias("domain_errors"),
        F.count_if(accepted & ~F.coalesce("_valid", F.lit(False))).alias("invalid_targets"),
    )
    return counts.withColumn("recall", share(F.col("hits"), F.col("expected_maps")))


def _rows(df: DataFrame, values: list, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(values, schema)


def calibration_bins(cases: DataFrame, edges: tuple[float, ...] = BIN_EDGES) -> DataFrame:
    """Accepted predictions by score bin, empty bins too; the last bin takes in 1."""
    number = sum((F.coalesce(F.col("score"), F.lit(0.0)) >= e).cast("int") for e in edges) - 1
    accepted = cases.where("decision = 'MAP'").withColumn("bin", number).groupBy("bin").agg(
        F.count(F.lit(1)).alias("_n"), F.round(F.avg("score"), 6).alias("mean_score"), F.count_if(F.col("concept_id") == F.col("expected_id")).alias("_right")
    )
    bins = _rows(cases, [(i, a, min(b, 1.0)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))], "bin int, lower double, upper double")
    return bins.join(accepted, "bin", "left").select("lower", "upper", F.coalesce("_n", F.lit(0)).alias("n"), "mean_score", share(F.col("_right"), F.col("_n")).alias("accuracy"))


def _by_score(cases: DataFrame, grid: list[float], mapped: Column, counts: dict[str, tuple[Column, Column]], *keys: str) -> DataFrame:
    """(keys, threshold, total, counts): at each threshold the sums of the first condition of a count over the cases that reach
    it, and of its second over the others; ``mapped`` says whether a case can. A case is counted once, in the interval
    of the grid that its score lies in; only that histogram, a row an interval and key, meets the grid."""
    levels = sorted({float(t) for t in grid})
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    passed = F.when(mapped, F.size(F.filter(F.array(*map(F.lit, levels)), lambda t: t <= score))).otherwise(0)
    sums = [F.count_if(c).alias(f"_{k}_{name}") for name, pair in counts.items() for k, c in enumerate(pair)]
    bins = cases.withColumn("_passed", passed).groupBy(*keys, "_passed").agg(F.count(F.lit(1)).alias("_n"), *sums)
    at = bins.withColumn("_level", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(levels)])))
    reached = F.col("_passed") > F.col("_level.i")
    total = [F.sum(F.when(reached, F.col(f"_0_{name}")).otherwise(F.col(f"_1_{name}"))).alias(name) for name in counts]
    return at.withColumn("threshold", F.col("_level.threshold")).groupBy(*keys, "threshold").agg(F.sum("_n").alias("total"), *total)


def threshold_curve(cases: DataFrame, grid: list[float], *keys: str) -> DataFrame:
    """Counts and rates of the raw predictions at each threshold of a fixed grid, by ``keys``."""
    held = flag_columns(F.lit("MAP"), F.col("raw_id"))
    left = flag_columns(F.lit("ABSTAIN"), F.lit(None).cast("long"))
    return with_rates(_by_score(cases, grid, F.col("raw_decision") == "MAP", {f: (held[f], left[f]) for f in FLAGS}, *keys))


def select_thresholds(cases: DataFrame, grid: list[float], min_precision: float, max_false: int) -> DataFrame:
    """The threshold of each domain with the best recall under the precision floor and the cap on false
    maps; ties by precision, then lower coverage, then the higher threshold. Domains without one stay."""
    curve = threshold_curve(cases, grid, "domain")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    order = Window.partitionBy("domain").orderBy(zero("mappable_recall").desc(), zero("accepted_precision").desc(), F.col("coverage"), F.desc("threshold"))
    fit = curve.where((F.col("accepted_precision") >= min_precision) & (F.col("false_map") <= max_false))
    best = fit.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("domain", F.col("threshold").alias("selected"), "mappable_recall", "accepted_precision")
    none, some = "NO_THRESHOLD_SATISFIES_SAFETY_CONSTRAINTS", "MAX_RECALL_WITHIN_PRESPECIFIED_SAFETY_CONSTRAINTS"
    return cases.select("domain").distinct().join(best, "domain", "left").withColumn("reason", F.when(F.col("selected").isNull(), none).otherwise(some))


def threshold_analysis(cases: DataFrame, grid: list[float]) -> DataFrame:
    """Review queue by threshold: admitted, correct and incorrect proposals, precision, recall of positives."""
    right, no = F.coalesce(F.col("concept_id") == F.col("expected_id"), F.lit(False)), F.lit(False)
    positive = F.col("expected_decision") == "MAP"
    wanted = {"admitted": (F.lit(True), no), "correct": (right, no), "incorrect": (~right, no), "_positive": (positive, positive)}
    counts = _by_score(cases, grid, F.col("decision") == "MAP", wanted)
    return counts.select("threshold", "admitted", "correct", "incorrect", share(F.col("correct"), F.col("admitted")).alias("precision"), share(F.col("correct"), F.col("_positive")).alias("recall"))


def calibration_summary(cases: DataFrame) -> DataFrame:
    positive, abstains = F.col("expected_decision") == "MAP", F.col("decision") == "ABSTAIN"
    return cases.agg(
        F.count_if(positive).alias("positive_cases"),
        F.count_if(positive & F.coalesce(F.array_contains("candidates", F.col("expected_id")), F.lit(False))).alias("retrieval_hits"),
        F.count_if(positive & ~abstains & F.coalesce(F.col("concept_id") == F.col("expected_id"), F.lit(False))).alias("correct_selections"),
        F.count_if(positive & abstains).alias("positive_abstentions"),
        F.count_if(~positive).alias("negative_cases"),
        F.count_if(~positive & abstains).alias("safe_abstentions"),
    )


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cases whose prediction changed, with the names of the changed fields; a case on one side alone fails
    the comparison and shows as ``MISSING``."""
    fields = ("decision", "concept_id", "score")
    b = before.select("case_id", F.lit(True).alias("_b"), *[F.col(f).alias(f"b_{f}") for f in fields])
    a = after.select("case_id", F.lit(True).alias("_a"), *[F.col(f).alias(f"a_{f}") for f in fields])
    both = b.join(a, "case_id", "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"b_{f}").eqNullSafe(F.col(f"a_{f}")), F.lit(f)) for f in fields]))
    missing = F.col("_a").isNull() | F.col("_b").isNull()
    out = both.withColumn("changed", F.when(missing, "MISSING").otherwise(F.array_join(changed, ",")))
    return out.where("changed <> ''").select("case_id", "changed", F.col("b_decision").alias("before_decision"), F.col("a_decision").alias("after_decision"))


def metric_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """(scope, value, metric, before, after, delta) of two score tables."""
    rates = ("coverage", "accepted_precision", "mappable_recall", "abstain_accuracy", "overall_accuracy")
    long = lambda df, name: df.unpivot(["scope", "value"], list(rates), "metric", name)
    both = long(before, "before").join(long(after, "after"), ["scope", "value", "metric"], "full")
    return both.withColumn("delta", F.round(F.col("after") - F.col("before"), 6))


def threshold_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """(threshold, metric, before, after, delta) of two threshold analyses. Unlike grids fail."""
    metrics = ["admitted", "correct", "incorrect", "precision", "recall"]
    as_double = [F.col(m).cast("double").alias(m) for m in metrics]
    long = lambda df, name: df.select("threshold", *as_double).unpivot(["threshold"], metrics, "metric", name).withColumn(f"_{name}", F.lit(True))
    both = long(before, "before").join(long(after, "after"), ["threshold", "metric"], "full")
    unlike = F.col("_before").isNull() | F.col("_after").isNull()
    delta = F.when(unlike, F.raise_error(F.lit("the runs have different threshold grids")).cast("double")).otherwise(F.round(F.col("after") - F.col("before"), 6))
    return both.select("threshold", "metric", "before", "after", delta.alias("delta"))


def require_comparable(before: DataFrame, after: DataFrame) -> None:
    """Fails unless both runs hold the same cases, each once, with the same labels."""
    labels = ("domain", "split", "expected_decision", "expected_id")
    b = before.select("case_id", *[F.col(f).alias(f"b_{f}") for f in labels], F.lit(1).alias("_b"))
    a = after.select("case_id", *[F.col(f).alias(f"a_{f}") for f in labels], F.lit(1).alias("_a"))
    same = F.lit(True)
    for f in labels:
        same = same & F.col(f"b_{f}").eqNullSafe(F.col(f"a_{f}"))
    both = b.join(a, b["case_id"].eqNullSafe(a["case_id"]), "full")
    found = both.agg(F.count_if(F.col("_b").isNull() | F.col("_a").isNull()).alias("alone"), F.count_if(~same).alias("unlike"), F.count(F.lit(1)).alias("n")).first()
    twice = before.groupBy("case_id").count().where("count > 1").unionByName(after.groupBy("case_id").count().where("count > 1"))
    if found["alone"] or found["unlike"] or not twice.isEmpty():
        raise ValueError(f"the runs differ: {found['alone']} cases on one side alone, {found['unlike']} with other labels, or cases twice")


def exclusion_reasons(truth: DataFrame, concept: DataFrame) -> DataFrame:
    """Distinct (term, true_id) pairs by the first reason against using them."""
    target = concept.select(F.col("concept_id").alias("true_id"), "standard_concept", "invalid_reason", "domain_id", F.lit(True).alias("_known"))
    reason = (
        F.when(F.trim("term") == "", "EMPTY_TERM")
        .when(F.col("_known").isNull(), "UNKNOWN_CONCEPT")
        .when(~F.col("standard_concept").eqNullSafe("S"), "NOT_STANDARD")
        .when(F.col("invalid_reason").isNotNull(), "INVALID")
        .when(F.col("domain_id") != "Measurement", "OTHER_DOMAIN")
        .otherwise("ELIGIBLE")
    )
    return truth.select("term", "true_id").distinct().join(target, "true_id", "left").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def sample_cases(truth: DataFrame, split: str, n: int) -> DataFrame:
    """The n first terms by digest, of those with a single true concept, in a split: development where the
    digest's first byte is below 204."""
    one = truth.groupBy("term").agg(F.count_distinct("true_id").alias("_k"), F.min("true_id").alias("true_id")).where("_k = 1")
    digest = F.sha2(F.col("term").cast("binary"), 256)
    low = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int") < 204
    chosen = one.withColumn("digest", digest).where(low if split == "development" else ~low)
    return chosen.select("term", "true_id", "digest").orderBy("digest", "term").limit(n)


def probe_cases(truth: DataFrame, terms: DataFrame) -> DataFrame:
    """The first row of ``truth`` by event for each of ``terms``."""
    order = Window.partitionBy("term").orderBy("event_id")
    return truth.join(terms, "term", "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def measurement_context(events: DataFrame) -> DataFrame:
    """By unmapped term: its units in order, and whether any value is a number or anything else."""
    unit = F.when(F.trim("unit_code") != "", F.col("unit_code"))
    coded = F.col("value_code").isNotNull() & F.try_to_number("value_code", F.lit("999999999")).isNull()
    return events.where("concept_id = 0").groupBy("code").agg(
        F.array_join(F.array_sort(F.collect_set(unit)), ",").alias("units"), F.bool_or(F.col("value").isNotNull()).alias("has_numeric"), F.bool_or(coded).alias("has_coded")
    )


def predict_by_code(cases: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """MAP where a code (case_id, vocabulary_id, code) has exactly one current standard concept, itself or
    its mapping; else ABSTAIN with the reason."""
    source = concept.where("invalid_reason is null")
    own = source.where("standard_concept = 'S'").select("vocabulary_id", F.col("concept_code").alias("code"), F.col("concept_id").alias("found"))
    standard = own.select("found")
    maps = relationship.where("relationship_id = 'Maps to' and invalid_reason is null").select(F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("found"))
    mapped = source.join(maps, "concept_id").join(standard, "found", "left_semi").select("vocabulary_id", F.col("concept_code").alias("code"), "found")
    targets = own.unionByName(mapped).distinct().groupBy("vocabulary_id", "code").agg(F.count(F.lit(1)).alias("_n"), F.min("found").alias("_id"))
    n = F.coalesce("_n", F.lit(0))
    reason = F.when(F.col("code").isNull(), "NO_SOURCE_CODE").when(n == 0, "NO_STANDARD_MAPPING").when(n > 1, "AMBIGUOUS_STANDARD_MAPPING").otherwise("EXACT_STANDARD_CODE")
    return cases.join(targets, ["vocabulary_id", "code"], "left").select(
        "case_id", F.when(n == 1, "MAP").otherwise("ABSTAIN").alias("decision"), F.when(n == 1, F.col("_id")).alias("concept_id"), reason.alias("reason")
    )


def invalid_references(cases: DataFrame, concept: DataFrame, current: bool = True) -> DataFrame:
    """Labelled cases whose expected concept is unknown, not a current standard one (unless ``current`` is false), or of another domain."""
    c = concept.select(F.col("concept_id").alias("expected_id"), F.col("domain_id"), F.col("standard_concept"), F.col("invalid_reason"), F.lit(True).alias("_known"))
    reason = F.when(F.col("_known").isNull(), "UNKNOWN").when(F.lit(current) & ~(F.col("standard_concept").eqNullSafe("S") & F.col("invalid_reason").isNull()), "NOT_CURRENT").when(~F.col("domain_id").eqNullSafe(F.col("domain")), "OTHER_DOMAIN")
    return cases.where("expected_decision = 'MAP'").join(c, "expected_id", "left").withColumn("reason", reason).where("reason is not null").select("case_id", "expected_id", "reason")
