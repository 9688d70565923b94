"""The language model: gradients, probabilities, windows, exact counts, and what it learns."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from clinloom.llm import attention as A
from clinloom.llm.registry import BYTE_RANKS

PATTERN = public_tokenizers.PATTERN
COLUMNS = "doc_id long, text string"


def weights(seed):
    r = np.random.default_rng(seed)
    w = A.new_weights(np.ones(A.GROUPS * A.MEMBERS) / (A.GROUPS * A.MEMBERS))
    return {k: v + 0.2 * r.standard_normal(v.shape) for k, v in w.items()}, r


def test_gradients():
    w, r = weights(1)
    x, y = r.integers(0, 1024, (3, A.SPAN)), r.integers(0, 1024, (3, A.SPAN - A.CONTEXT))
    counts = r.random(y.shape) < 0.8
    loss, grads = A.gradients(w, x, y, counts)
    assert math.isclose(loss, -(A.log_probabilities(w, x, y) * counts).sum() / counts.sum(), rel_tol=1e-6)
    for key in w:
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in w[key].shape)
            old, losses = w[key][at], []
            for step in (1e-5, -1e-5):
                w[key][at] = old + step
                losses.append(A.gradients(w, x, y, counts)[0])
            w[key][at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - grads[key][at]) < 1e-5


def test_probabilities_sum_to_one_and_see_no_later_place():
    w, r = weights(2)
    x = np.repeat(r.integers(0, 1024, (1, A.SPAN)), 1024, axis=0)
    y = np.repeat(np.arange(1024)[:, None], A.SPAN - A.CONTEXT, axis=1)
    p = A.log_probabilities(w, x, y)
    assert np.allclose(np.exp(p).sum(0), 1, atol=1e-6)
    assert np.allclose(A.log_probabilities(w, x, y, bounded=True), p)
    other = x.copy()
    other[:, -5:] = 3
    assert np.allclose(A.log_probabilities(w, other, y)[:, :-5], p[:, :-5])
    assert not np.allclose(A.log_probabilities(w, other, y)[:, -5:], p[:, -5:])


@pytest.mark.parametrize("length", [0, 1, 7, 8, 23, 24, 25, 100])
@pytest.mark.parametrize("opens", [True, False])
def test_each_class_is_told_once_from_those_before_it(length, opens):
    stream = np.arange(100, 100 + length)
    x, y, counts, owner = A.windows([np.array([], np.int64), stream], [False, opens])
    told = y[counts].tolist()
    assert told == stream[0 if opens else A.CONTEXT :].tolist() and set(owner) <= {1}
    for row, of, real in zip(x, y, counts):
        for i in np.flatnonzero(real):
            seen = row[: A.CONTEXT + i + 1]
            k = of[i] - 100
            want = ([A.END] * A.SPAN + stream[:k].tolist())[-len(seen) :]
            assert seen.tolist() == want


def ids_of(word):
    text = " " + word.decode()
    return [i for at in range(0, len(text), A.LONGEST) for i in A._encoding(BYTE_RANKS, PATTERN).encode_ordinary(text[at : at + A.LONGEST])]


def naive_score(model, words):
    """Place by place, with its own attention loop."""
    v, w, d = model.vocabulary, model.weights, A.SIZE
    ids = [i for word in words for i in ids_of(word)]
    classes = [int(v.klass[i]) for i in ids] + [A.END]
    total = sum(float(v.share[i]) for i in ids)
    even = lambda h: h / np.sqrt((h**2).mean() + 1e-5)
    step = A.SPAN - A.CONTEXT
    for at, c in enumerate(classes):
        start = at // step * step - A.CONTEXT - 1
        seen = [classes[j] if j >= 0 else A.END for j in range(start, at)]
        hs = [w["table"][x] + w["place"][i] for i, x in enumerate(seen)]
        ns = [even(h) for h in hs]
        q = ns[-1] @ w["query"]
        a = np.exp(np.array([q @ (n @ w["key"]) for n in ns]) / math.sqrt(d))
        h = hs[-1] + sum(p * (n @ w["value"]) for p, n in zip(a / a.sum(), ns)) @ w["join"]
        h = even(h + np.maximum(even(h) @ w["up"] + w["shift"], 0) @ w["down"])
        g, m = divmod(c, A.MEMBERS)
        for z, k in ((h @ w["group"] + w["group_prior"], g), (h @ w["member"][g] + w["member_prior"][g], m)):
            total += (z[k] - np.log(np.exp(z).sum())) / math.log(10)
    return total


def corpus(seed, n=150):
    r = random.Random(seed)
    heads, tails = ["The", "of", "and", "to"], ["ing.", "ed", "ation", "É", "x" * 700]
    text = lambda: r.choice([" ", "\n", "\t \x0b"]).join(r.choice(heads) + " " + r.choice("stre ple mon dra".split()) + r.choice(tails[:4]) for _ in range(r.randint(1, 90)))
    rows = [(i, text()) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, " \n "), (None, "The unseen"), (n + 3, "a b " * 5_000), (n + 4, tails[4])]
    return rows + [rows[0]] * 2 + [(n + 5 + i, f"word{i} of") for i in range(40)]


def test_words_at_once_as_one_by_one():
    r = random.Random(6)
    letters = "ab cÉ1-'.!\u00a0日xs\u3000"
    words = {"".join(r.choices(letters, k=r.randint(1, 9))).encode() for _ in range(3000)} | {b"x" * 300, b"\xff\xfe", b"'s", b"a\x00b"}
    words = {x for w in words for x in w.split()}
    found = A.WordIds(BYTE_RANKS, PATTERN)
    found.learn(words)
    for w in words:
        assert found[w] == found.one(w)
    small = A.WordIds(BYTE_RANKS, PATTERN, 100)
    for some in ([b"a", b"bc"], list(words)[:500], [b"a"]):
        small.learn(set(some))
        assert small.ids(some).tobytes() == b"".join(found[w] for w in some)


@pytest.mark.parametrize("known", [200_000, 3])
def test_counts_and_scores(spark, monkeypatch, known):
    monkeypatch.setattr(A, "KNOWN_WORDS", known)
    monkeypatch.setattr(A, "COUNTED_WORDS", 20)
    monkeypatch.setattr(A, "LEAST_IDS", 2_000)
    monkeypatch.setattr(A, "TASK_IDS", 4_000)
    rows = corpus(3)
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], COLUMNS + ", n_tokens int, c0 double").repartition(3)
    training = df.where("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2")
    fitted = A.fit(training.select("doc_id", "text"), BYTE_RANKS, PATTERN)
    got = A.score(df, fitted)
    assert sorted(got.columns) == sorted(["doc_id", "text", "c0", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    got = got.collect()
    assert len(got) == len(rows)
    count, ends = Counter(), 0
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            count.update((text or "").encode().lower().split())
            ends += 1
    N, V = sum(count.values()) + ends, len(count) + 1
    slow = 0
    for r in got:
        words = (r.text or "").encode().lower().split()
        base = sum(math.log10((count[w] + 1) / (N + V + 1)) for w in words) + math.log10((ends + 1) / (N + V + 1))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(w in count for w in words) + 1, N)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if len(words) < 60 and slow < 25:
            slow += 1
            assert math.isclose(r.score, naive_score(fitted.model, words), rel_tol=1e-3)
    # ids of all training words, not of the stretches alone
    ids = Counter()
    for w, c in count.items():
        for i in ids_of(w):
            ids[i] += c
    assert A.id_counts(fitted.counts, BYTE_RANKS, PATTERN) == dict(ids)


def test_words_of_many_texts_at_once():
    texts = ["  The\tCat\x0bthe ", "", None, " \n", "É\u00a0É\x1cx \u2028 THE", "a b a", "x" * 70]
    found = A.Words.of(pa.array(texts))
    want = [A.words_of((t or "").encode()) for t in texts]
    for words in (found, A.Words.of_lists(want)):
        cut = np.split(words.codes, words.ends[:-1])
        assert [[words.kinds[c] for c in some] for some in cut] == want
    ids, many = A.WordIds(BYTE_RANKS, PATTERN).ids_of(found)
    assert ids.tolist() == [i for words in want for w in words for i in ids_of(w)]
    assert many.tolist() == [sum(len(ids_of(w)) for w in words) for words in want]
    assert [len(x) for x in A.WordIds(BYTE_RANKS, PATTERN).ids_of(A.Words.of(pa.array([], pa.string())))] == [0, 0]


def test_one_rule_takes_the_stretches_of_any_corpus(spark, monkeypatch):
    """Every fourth stretch of each text, and 20 others, however large the corpus is; all of one with no more."""
    taken = []
    monkeypatch.setattr(A, "one_round", lambda stretches, start, *rest: taken.extend(bytes(r.stretch) for r in stretches.collect()) or start)
    monkeypatch.setattr(A, "SHARE", 4)
    monkeypatch.setattr(A, "FIRST", 20)
    small = [(i, " ".join(f"own{i}x{k}" for k in range(640))) for i in range(40)]  # ten stretches each
    for more in ([], [(100 + i, "a b c " * 1_000_000) for i in range(3)]):
        taken.clear()
        A.fit(spark.createDataFrame(small + more, COLUMNS), BYTE_RANKS, PATTERN)
        texts = Counter(s.split(b"x")[0] for s in taken)
        fourths = sum(min(2, texts[b"own%d" % i]) for i in range(40))
        assert fourths == 80 and 80 <= sum(texts[b"own%d" % i] for i in range(40)) <= 140
        large = sum(n for text, n in texts.items() if not text.startswith(b"own"))
        assert abs(large - len(more) * 46_875 / 4) <= 23
    taken.clear()
    A.fit(spark.createDataFrame(small[:2], COLUMNS), BYTE_RANKS, PATTERN)
    assert sorted(w for s in taken for w in s.split()) == sorted(w.encode() for _, text in small[:2] for w in text.split())


def test_every_stretch_of_a_large_corpus_is_trained_on(spark, monkeypatch):
    """Each once, in one of the rounds, whatever the number of stretches."""
    taken = []
    monkeypatch.setattr(A, "one_round", lambda stretches, start, *rest: taken.append([bytes(r.stretch) for r in stretches.collect()]) or start)
    texts = [" ".join(f"t{i}x{k}" for k in range(64 * 4_000)) for i in range(4)] + ["a b c", None]
    A.fit(spark.createDataFrame(list(enumerate(texts)), COLUMNS), BYTE_RANKS, PATTERN)
    assert len(taken) == A.ROUNDS and all(2_500 < len(some) < 2_900 for some in taken)
    words = Counter(w for some in taken for s in some for w in s.split())
    assert words == Counter(w.encode() for t in texts for w in (t or "").split())


def test_learns(spark):
    """Held-out texts of the same making are likelier than their ids' shares make them."""
    rows = [(i, t) for i, t in corpus(4, 400) if i is not None and i < 400]
    df = spark.createDataFrame(rows, COLUMNS)
    fitted = A.fit(df.where("doc_id < 300"), BYTE_RANKS, PATTERN)
    even = A.Model(fitted.model.vocabulary, A.new_weights(fitted.model.vocabulary.shares))
    held = [A.words_of(t.encode()) for i, t in rows if i >= 300]
    assert fitted.model.scorer()(held).sum() > 0.75 * even.scorer()(held).sum()


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (4, None)], COLUMNS)
    assert A.op11(df.limit(0), BYTE_RANKS, PATTERN).collect() == []
    # nothing to learn from
    got = A.score(df, A.fit(df.limit(0), BYTE_RANKS, PATTERN)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in sorted(got)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
