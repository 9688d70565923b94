"""Quality rules by gradient-boosted trees over document statistics.

Statistics of whole texts are counted in the tasks. The trees are grown in numpy on a bounded sample of
labelled rows (``TRAIN_ROWS``, the least by a hash of the id), by histograms of quantile bins, with
logistic loss. Features in ``MONOTONE`` carry a sign: a split whose children disagree with it is not
taken, and child values are kept within bounds passed down from their ancestors, so the score never
falls as such a feature moves in its good direction. The finished trees are flattened into node arrays,
and a batch walks all of them level by level.

Nulls and edge cases: a null or empty text has zero in every count, fails the base rule and is not
kept; without labels the trees are absent and the base rule alone decides; repeated and very long
texts are counted whole; of several texts under one labelled doc_id the one with the least hash is learned from, of
several labels the highest; other columns pass through, but those of the names of the counts, ``features``, ``score``,
``base_failed`` and ``kept`` are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import add_columns

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features in order, with the direction in which quality may only rise (0: free).
MONOTONE = {
    "log_words": 0,
    "mean_word": 0,
    "symbol_rate": -1,
    "dup_line_rate": -1,
    "repeat_rate": -1,
    "upper_rate": 0,
    "digit_rate": 0,
    "bang_rate": -1,
    "distinct_rate": 0,
    "words_a_line": 0,
    "stop_mark_rate": 0,
}
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, LEAST_LEAF, RIDGE, BINS = 60, 3, 0.2, 8.0, 1.0, 64
#: Kept from this probability of good quality on.
KEEP_FROM = 0.5


def statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The counts of ``COUNTS`` and the features of ``MONOTONE``."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = len(lines) - len(set(lines))
    threes = list(zip(words, words[1:], words[2:], strict=False))
    in_repeats = 0
    if len(set(threes)) < len(threes):
        seen = Counter(threes)
        reach = 0
        for i, three in enumerate(threes):
            if seen[three] > 1:
                in_repeats += i + 3 - max(i, reach)
                reach = i + 3
    letters = max(chars, 1)
    features = [
        np.log1p(n),
        chars / max(n, 1),
        symbols / max(n, 1),
        repeated / max(len(lines), 1),
        in_repeats / max(n, 1),
        sum(map(str.isupper, text)) / letters if text else 0.0,
        sum(map(text.count, "0123456789")) / letters,
        text.count("!") / max(n, 1),
        len(set(words)) / max(n, 1),
        n / max(len(lines), 1),
        (text.count(".") + text.count(",")) / max(n, 1),
    ]
    return (n, chars, symbols, repeated, in_repeats), features


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts and a column ``features`` (array<double>)."""
    at = df.columns.index(text)

    def make():
        def work(part):
            done = [statistics(t) for t in part.column(at).to_pylist()]
            return [*([c[k] for c, _ in done] for k in range(len(COUNTS))), [f for _, f in done]]

        return work

    return add_columns(df, ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>", make)


@dataclass
class Trees:
    """All trees in flat arrays: an inner node has a feature, a limit and its left child (the right one
    follows it), a leaf has feature -1 and a value."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while (inner := self.feature[node] >= 0).any():
            f = np.maximum(self.feature[node], 0)
            down = self.left[node] + (x[rows, f] > self.limit[node])
            node = np.where(inner, down, node)
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Trees:
    """Boosted trees for labels 0 and 1."""
    share = np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    feature, limit, left, value, roots = [], [], [], [], []
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, k], cuts)) if len(x) else np.empty(0) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    score = np.full(len(y), base)

    def node() -> int:
        for one, empty in ((feature, -1), (limit, 0.0), (left, -1), (value, 0.0)):
            one.append(empty)
        return len(feature) - 1

    for _ in range(TREES if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        roots.append(root := node())
        todo = [(root, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, depth, low, high = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            fit = float(np.clip(gs / (hs + RIDGE), low, high))
            best = (1e-6, None)
            if depth < DEPTH:
                for k, e in enumerate(edges):
                    bins = binned[rows, k]
                    gl = np.cumsum(np.bincount(bins, g[rows], minlength=len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(bins, h[rows], minlength=len(e) + 1))[:-1]
                    nl = np.cumsum(np.bincount(bins, minlength=len(e) + 1))[:-1]
                    gr, hr, nr = gs - gl, hs - hl, len(rows) - nl
                    vl, vr = gl / (hl + RIDGE), gr / (hr + RIDGE)
                    gain = gl * vl + gr * vr - gs * gs / (hs + RIDGE)
                    fair = (nl >= LEAST_LEAF) & (nr >= LEAST_LEAF) & ((vr - vl) * signs[k] >= 0)
                    gain = np.where(fair, gain, -np.inf)
                    if len(gain) and gain.max() > best[0]:
                        b = int(gain.argmax())
                        best = (gain[b], (k, b, np.clip(vl[b], low, high), np.clip(vr[b], low, high)))
            if best[1] is None:
                value[at] = RATE * fit
                score[rows] += RATE * fit
                continue
            k, b, vl, vr = best[1]
            goes = binned[rows, k] > b
            feature[at], limit[at], left[at] = k, float(edges[k][b]), node()
            node()
            middle = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[signs[k]]
            todo.append((left[at], rows[~goes], depth + 1, *bounds[0]))
            todo.append((left[at] + 1, rows[goes], depth + 1, *bounds[1]))
    return Trees(np.array(feature, np.int64), np.array(limit, float), np.array(left, np.int64), np.array(value, float), np.array(roots, np.int64), base)


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents, the least by a hash of the id."""
    chosen = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # bounded by ``rows``, so it may be broadcast
    found = documents.select("doc_id", "text", F.xxhash64("text").alias("order")).join(F.broadcast(chosen), "doc_id")
    # one row a document: of several texts under one doc_id, the one with the least hash
    one = with_statistics(found).groupBy("doc_id", "quality").agg(F.min_by("features", "order").alias("features"))
    got = one.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(MONOTONE))
    return grow(x, got["quality"].to_numpy(float), list(MONOTONE.values()))


def judge(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``df`` with the counts, ``score`` (probability of good quality), base_failed and kept."""
    counted = with_statistics(df, text)
    shared = df.sparkSession.sparkContext.broadcast(trees)
    at = counted.columns.index("features")

    def make():
        def work(part):
            flat = part.column(at).flatten().to_numpy(zero_copy_only=False)
            return [pa.array(shared.value.probability(flat.reshape(part.num_rows, len(MONOTONE))))]

        return work

    scored = add_columns(counted, "score double", make)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= KEEP_FROM))


def op10(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept; and score."""
    docs = documents.select("doc_id", "text")
    judged = judge(docs, train(docs, labels.select("doc_id", "quality")))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "score")
