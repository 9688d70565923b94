"""Language identification by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every other character becomes a blank, and n-grams of one to three characters
(not of blanks alone) are hashed into ``BUCKETS``. Training counts n-grams by language in the tasks and
sums them in Spark over all labelled rows; the matrix of log probabilities, whose size is the number of
languages (``MAX_LANGUAGES`` at most, else it fails) times ``BUCKETS``, is broadcast. Scoring gathers
the columns of a batch's n-grams and sums them by document, in numpy.

Nulls and edge cases: a null or empty text, or one without letters, gives ``und`` with score 0; a null
language is no label; without any labelled row every text gives ``und``; repeated rows repeat; very
long texts are scored whole; an empty table gives no rows; other columns pass through, but ``lang_pred`` and
``score`` replace those of their names. Ties go to the language first in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import add_columns, crc32_mod, give_back, rows_in_slices
from clinloom.session import ship_package

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 512
UNDETERMINED = "und"
#: Languages whose counts a task holds before it sends them on.
HELD_LANGUAGES = 32
#: Characters handled at once, so that temporary arrays stay small.
CHUNK_CHARS = 250_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True at each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, documents): a bucket for each n-gram and the number of its text, in order of texts for
    each n-gram length."""
    parts = [(t or "").lower().encode("utf-32-le", "replace") for t in texts]
    lengths = np.array([len(p) // 4 + 1 for p in parts])  # with a closing blank
    points = np.frombuffer(b" \0\0\0".join(parts) + b" \0\0\0", np.uint32)
    letter = _letters()[np.minimum(points, 0x10FFFF)]
    points = np.where(letter, points, 32).astype(np.uint64)
    document = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    last = np.cumsum(lengths) - 1
    found, owner = [], []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = len(points) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            some = np.zeros(m, bool)
            for k in range(n):
                h = (h + points[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                some |= letter[k : k + m]
            inside = some
            for k in range(1, n):  # starts so late that the n-gram would run into the next text
                late = last - k + 1
                inside[late[(late >= 0) & (late < m)]] = False
            found.append((h[inside] >> np.uint64(13)).astype(np.int64) % BUCKETS)
            owner.append(document[:m][inside])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    return np.concatenate(found), np.concatenate(owner)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > CHUNK_CHARS:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # bucket x language, float32
    prior: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, some in _chunks(texts):
            bucket, owner = gram_buckets(some)
            total = np.zeros((len(some), len(self.languages)))
            grams = np.bincount(owner, minlength=len(some))
            for k in range(len(self.languages)):
                total[:, k] = np.bincount(owner, self.log_prob[:, k][bucket], minlength=len(some))
            if not self.languages:
                names += [UNDETERMINED] * len(some)
                scores += [0.0] * len(some)
                continue
            total += self.prior
            best = total.argmax(axis=1)
            top = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for i, n in enumerate(grams):
                names.append(self.languages[best[i]] if n else UNDETERMINED)
                scores.append(float(top[i]) if n else 0.0)
        return names, scores


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model from all rows of ``labelled`` with a language."""
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.where(F.col(lang).isNotNull()).select(text, lang)

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}

        def send():
            for name, one in counts.items():
                at = np.flatnonzero(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(name)] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(one[at], documents[name]).astype(np.int64))],
                    names=["lang", "bucket", "n"],
                )
            counts.clear()
            documents.clear()

        for part in rows_in_slices(batches):
            texts, langs = part.column(0).to_pylist(), np.array(part.column(1).to_pylist(), object)
            for at, some in _chunks(texts):
                bucket, owner = gram_buckets(some)
                names, code = np.unique(langs[at : at + len(some)].astype(str), return_inverse=True)
                both = np.bincount(code[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    counts[name] = counts.get(name, 0) + both[k * BUCKETS : (k + 1) * BUCKETS]
                    documents[name] = documents.get(name, 0) + int((code == k).sum())
            if len(counts) > HELD_LANGUAGES:
                yield from send()
        yield from send()
        give_back()

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(r[0] for r in rows.select(lang).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((BUCKETS, len(languages)))
    prior = np.zeros(len(languages))
    if languages:
        # at most MAX_LANGUAGES rows of BUCKETS counts, whatever the size of the corpus
        got = sums.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
        for row in got.toLocalIterator():
            k = languages.index(row["lang"])
            at, n = np.array(row["at"]), np.array(row["n"], float)
            prior[k] = n[at < 0].sum()
            table[at[at >= 0], k] = n[at >= 0]
        table = np.log(table + SMOOTHING) - np.log(table.sum(axis=0) + SMOOTHING * BUCKETS)
        prior = np.log(prior / prior.sum())
    return LanguageModel(languages, table.astype(np.float32), prior)


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def make():
        return lambda part: list(shared.value.score(part.column(at).to_pylist()))

    return add_columns(df, "lang_pred string, score double", make)


def fit_on(documents: DataFrame) -> LanguageModel:
    """Learns from documents whose crc32(doc_id) modulo 3 is not 1."""
    return train(documents.where(~F.coalesce(crc32_mod(F.col("doc_id"), 3) == 1, F.lit(False))))


def op4(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out (false for a null doc_id), lang_pred, score."""
    rows = documents.select("doc_id", "text", "lang")
    scored = identify(rows.select("doc_id", "text"), fit_on(rows))
    held = F.coalesce(crc32_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")
