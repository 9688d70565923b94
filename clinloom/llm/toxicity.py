"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other text, labelled or not, is only unlabelled. A
linear model over presence features (a document's distinct lower-cased words, and their prefixes of
three to six characters, hashed) is trained in numpy by Adam on the class-prior-corrected risk with
logistic loss,

    prior * E_pos[l(+)] + max(0, E_unl[l(-)] - prior * E_pos[l(-)]),

and where the second term is negative, its gradient is turned so that the model does not fit the
unlabelled positives away. The prior is the share of label 1 among the labelled training rows, or where it
is smaller the mixture's bound: no feature can be rarer among the unlabelled than the prior times its share
of the positives, so the least such ratio, over features that ``SUPPORT`` of the positives have, bounds it.
Of each ratio the upper confidence limit counts (``DEVIATIONS`` of its logarithm), so that noise does not make
the bound small. A feature's share of the unlabelled is that of all training documents. The positives, and the
unlabelled ones of the gradient steps, are bounded samples, the least by a hash of the id: ``POSITIVE_ROWS``
and ``UNLABELLED_ROWS``.
Features are the ``FEATURES`` ones that tell most, by count times log lift among the positives.

Nulls and edge cases: a null or empty text, or one without words, scores the model's bias; without a
positive every score is 0; null labels and ids train nothing; repeated and very long texts are
scored whole; of several texts under one doc_id the one with the least hash is learned from, of several labels the
highest; other columns pass through, but ``score`` replaces one of its name; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import Memory, add_columns, crc32_mod, rows_in_slices
from clinloom.session import store

POSITIVE_ROWS, UNLABELLED_ROWS = 4_000, 12_000
#: A feature is used if positives have it so often, and if prior * lift, the share of positives among
#: documents with it, is so large.
FEATURES, LEAST_POSITIVE, LEAST_SHARE = 4_096, 5, 0.35
SUPPORT, DEVIATIONS = 0.05, 2.0
STEPS, RATE, RIDGE = 300, 0.1, 2e-4
THRESHOLD = 0.3
_WORD = re.compile(r"\w+").findall


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its prefixes."""
    return [xxhash.xxh32_intdigest("=" + word), *(xxhash.xxh32_intdigest("^" + word[:n]) for n in range(3, min(6, len(word)) + 1))]


def document_features(text: str | None, memory: dict) -> set[int]:
    return set().union(*map(memory.__getitem__, set(_WORD((text or "").lower()))))


@dataclass(frozen=True)
class ToxicityModel:
    index: dict[int, int]  # feature hash to place
    weight: np.ndarray
    bias: float

    def scorer(self):
        index, weight, bias = self.index, self.weight, self.bias
        memory = Memory(lambda w: tuple(index[f] for f in word_features(w) if f in index))

        def score(texts):
            out = np.full(len(texts), bias)
            for i, text in enumerate(texts):
                at = document_features(text, memory)
                if at:
                    out[i] += weight[sorted(at)].sum()
            return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

        return score


def fit(rows: list[np.ndarray], positive: np.ndarray, size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias from documents' feature places; ``positive`` marks the confirmed ones."""
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    pos, unl = positive, ~positive
    n_pos, n_unl = max(int(pos.sum()), 1), max(int(unl.sum()), 1)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    best = (np.inf, w, b)
    for step in range(1, STEPS + 1):
        z = b + np.bincount(owner, w[flat], minlength=len(rows))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        loss_pos, loss_neg = np.logaddexp(0, -z), np.logaddexp(0, z)
        negative = loss_neg[unl].mean() - prior * loss_neg[pos].mean()
        risk = prior * loss_pos[pos].mean() + max(0.0, negative) + RIDGE * (w @ w)
        if risk < best[0]:
            best = (risk, w.copy(), b)
        g = np.zeros(len(rows))  # of the risk by each document's z
        turn = 1.0 if negative >= 0 else -1.0
        g[unl] = turn * p[unl] / n_unl
        g[pos] = prior * ((p[pos] - 1) * (negative >= 0) - turn * p[pos]) / n_pos
        gradient = np.append(np.bincount(flat, g[owner], minlength=size) + 2 * RIDGE * w, g.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return best[1], float(best[2])


def train(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learns from ``labels`` (doc_id, toxic) and the texts of ``documents``, training rows alone."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    confirmed = marked.where("toxic = 1").select("doc_id").orderBy(*by_hash).limit(POSITIVE_ROWS).withColumn("positive", F.lit(True))
    others = documents.where("doc_id is not null").select("doc_id").distinct().orderBy(*by_hash).limit(UNLABELLED_ROWS).withColumn("positive", F.lit(False))
    # both samples are bounded, so they may be broadcast
    chosen = documents.select("doc_id", "text", F.xxhash64("text").alias("order")).join(F.broadcast(confirmed.unionByName(others)), "doc_id")

    def make():
        memory = Memory(lambda w: tuple(word_features(w)))
        return lambda part: [[sorted(document_features(t, memory)) for t in part.column(at).to_pylist()]]

    at = chosen.columns.index("text")
    # one row a document: of several texts under one doc_id, the one with the least hash
    each = add_columns(chosen, "features array<long>", make).groupBy("doc_id", "positive").agg(F.min_by("features", "order").alias("features"))
    seen = store(each, "features")
    shares = marked.agg(F.avg("toxic")).first()[0]
    sizes = {r["positive"]: r["n"] for r in seen.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(True):
        return ToxicityModel({}, np.empty(0), -500.0)
    n_pos = sizes[True]
    held = seen.where("positive").select(F.explode("features").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("p"))
    held = store(held.where(F.col("p") >= LEAST_POSITIVE), "held")
    everywhere, n_unl = _counts(documents.where("doc_id is not null"), [r["f"] for r in held.select("f").collect()])
    counts = store(held.join(everywhere, "f", "left").select("f", "p", F.coalesce("u", F.lit(0)).alias("u")), "counts")
    lift = (F.col("p") / n_pos) / ((F.col("u") + 1) / F.lit(float(max(1, n_unl))))
    gain = F.col("p") * F.log(lift)
    supported = counts.where(F.col("p") >= max(LEAST_POSITIVE, SUPPORT * n_pos))
    limit = F.exp(DEVIATIONS * F.sqrt(1 / F.col("p") + 1 / (F.col("u") + 1))) / lift
    mixed = supported.agg(F.min(limit)).first()[0]
    prior = float(np.clip(min(shares or 0.0, mixed or 1.0), 1e-3, 0.5))
    likely = prior * lift >= LEAST_SHARE
    best = counts.where((F.col("p") >= LEAST_POSITIVE) & likely).orderBy(gain.desc(), "f").limit(FEATURES)
    index = {r["f"]: k for k, r in enumerate(best.select("f").collect())}
    got = _restrict(seen, index).toPandas()
    got = got.sort_values(["positive", "doc_id"], kind="stable")
    weight, bias = fit([np.asarray(x, np.int64) for x in got["features"]], got["positive"].to_numpy(bool), max(1, len(index)), prior)
    return ToxicityModel(index, weight, bias)


def _counts(documents: DataFrame, features: list[int]) -> tuple[DataFrame, int]:
    """How many of all documents have each of the features (f, u), which the positives' sample bounds, and
    the number of documents."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(np.array(sorted(features), np.int64))

    def count(batches):
        known = shared.value
        index = {f: k for k, f in enumerate(known.tolist())}
        memory = Memory(lambda w: tuple(index[f] for f in word_features(w) if f in index))
        total, n = np.zeros(len(known), np.int64), 0
        for part in rows_in_slices(batches):
            places = [k for t in part.column(0).to_pylist() for k in document_features(t, memory)]
            total += np.bincount(np.array(places, np.int64), minlength=len(known))
            n += part.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(known[at], -1)), pa.array(np.append(total[at], n))], names=["f", "u"])

    rows = documents.select("text").mapInArrow(count, "f long, u long").groupBy("f").agg(F.sum("u").alias("u"))
    rows = store(rows, "everywhere")
    n = rows.where("f = -1").first()
    return rows.where("f >= 0"), n["u"] if n else 0


def _restrict(seen: DataFrame, index: dict[int, int]) -> DataFrame:
    """``features`` as places of the kept ones."""
    shared = seen.sparkSession.sparkContext.broadcast(index)
    at = seen.columns.index("features")

    def make():
        get = shared.value.get
        return lambda part: [[sorted(k for f in x if (k := get(f)) is not None) for x in part.column(at).to_pylist()]]

    return add_columns(seen, "features array<long>", make)


def score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` with score, the probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def make():
        scorer = shared.value.scorer()
        return lambda part: [pa.array(scorer(part.column(at).to_pylist()))]

    return add_columns(df, "score double", make)


def op7(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out (false for a null doc_id), score, predicted. Learns from rows whose
    crc32(doc_id) modulo 4 is not 2."""
    held = F.coalesce(crc32_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = documents.select("doc_id", "text")
    model = train(docs.where(~held), labels.select("doc_id", "toxic").where(~held))
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
