"""Language-model scoring by a causal self-attention model in numpy, with word counts of the corpus beside it.

Texts become subword ids word by word (lower-cased ASCII, byte-level ranks of a given vocabulary), then one end.
The model has one attention layer over windows of ``SPAN`` positions, a small feed-forward layer and a softmax in two
steps, over ``GROUPS`` groups and over ``MEMBERS`` of the group, of the most frequent ids (neighbours in a group start a word or
go on with one, and are about as frequent); one class stands for all other ids, which share its probability by their counts.
A text is cut into windows that overlap by ``CONTEXT`` positions: the first ones give context alone, each other id is
scored once, whatever the text's length. Windows of many texts run side by side under one causal mask.

What is learned grows with the corpus. One pass over the training documents counts every word and takes every stretch of
``STRETCH`` words of each text: all are trained on. (Above 1, ``SHARE`` is for trials: every ``SHARE``-th stretch of each text, beginning at a
hashed one, and of the others the ``FIRST`` with the smallest hashes.) The words' counts, over all training documents, give the ids' counts, so classes and shares are the whole corpus's. Gradient steps run in ``ROUNDS``: a round's own part of the
stretches is dealt to tasks of about ``TASK_IDS`` ids, each trains from the round's weights by Adam, the weights are averaged by
their ids in two levels. A task goes over its stretches again until it has made the steps of ``LEAST_IDS`` ids.

The base, sums of log10((c + 1) / (N + V + 1)) over words and end, is exact: counts of the most frequent words
(``KNOWN_WORDS`` at most) go with the tasks, the others' come by a join of (document, word) with the counts.

Nulls and edge cases: a null or empty text is its end alone; rows without doc_id are training rows; repeated rows are
learned from and scored each; without a training document c, N and V are 0 and the model is even; a very long text is many
windows, a very long word many ids; other columns pass through, but those of the names given here are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import ctypes
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import Memory, add_columns, crc32_mod, give_back, rows_in_slices
from clinloom.session import ship_package, store

#: Positions of a window, and how many of them are context alone.
SPAN, CONTEXT = 24, 6
#: Size of a position's vector and of the feed-forward layer; groups of classes and classes in each, of which two are fixed.
SIZE, INNER, GROUPS, MEMBERS = 24, 24, 32, 32
END, OTHER = 0, 1
STRETCH, SHARE, FIRST, ROUNDS = 64, 1, 8_192, 6
TASK_IDS, LEAST_IDS = 500_000, 150_000
BATCH_WINDOWS, RATE = 64, 0.004
KNOWN_WORDS = 200_000
#: Distinct words that a task counts before it hands them on, and windows scored side by side.
COUNTED_WORDS, SIDE_BY_SIDE = 400_000, 192
#: Longer words are encoded in parts; so many words' ids are kept.
LONGEST, KEPT_WORDS = 256, 250_000
_SUMMED = 64


def words_of(text: bytes | None) -> list[bytes]:
    """Stretches without ASCII blanks, A-Z lower-cased; bytes.split() cuts at exactly these blanks."""
    return (text or b"").lower().split()


@dataclass(frozen=True)
class Words:
    """The words of some texts: distinct ``kinds``, the texts' words as ``codes`` of those, text i's up to ``ends[i]``."""

    kinds: list[bytes]
    codes: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        """``words_of`` all ``texts`` at once; Arrow's ASCII blanks are these, too."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
        flat, lengths = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        found = flat.dictionary_encode()
        kinds, codes = found.dictionary.cast(pa.binary()).to_pylist(), found.indices.to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        if b"" in kinds:  # stands before and after blanks at a text's ends
            empty = kinds.index(b"")
            del kinds[empty]
            real = codes != empty
            ends = np.concatenate([[0], np.cumsum(real)])[ends]
            codes = codes[real] - (codes[real] > empty)
        return cls(kinds, codes, ends)

    @classmethod
    def of_lists(cls, texts: list[list[bytes]]) -> Words:
        code: dict[bytes, int] = {}
        codes = [code.setdefault(w, len(code)) for words in texts for w in words]
        return cls(list(code), np.array(codes, np.int64), np.cumsum([len(t) for t in texts], dtype=np.int64))

    def lengths(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.ends)), self.lengths())


# ---- subword ids


@cache
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class WordIds(Memory):
    """From a word to its ids, as the bytes of unsigned 32-bit numbers; many words at once by ``learn``."""

    def __init__(self, path: str, pattern: str, most: int = KEPT_WORDS):
        encoding = _encoding(path, pattern)
        self.encode = encoding.encode_ordinary
        self.lengths = np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)])
        super().__init__(self.one, most)

    def one(self, word: bytes) -> bytes:
        text = " " + word.decode("utf-8", "replace")
        found = [i for at in range(0, len(text), LONGEST) for i in self.encode(text[at : at + LONGEST])]
        return np.array(found, np.uint32).tobytes()

    def many(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Short words encoded as one text and cut by their lengths; one by one where the ids do not end with the words."""
        ids = np.array(self.encode((b" " + b" ".join(words)).decode("utf-8", "replace")), np.uint32)
        ends = np.cumsum(self.lengths[ids])
        stops = np.cumsum([len(w) + 1 for w in words])
        cut = np.searchsorted(ends, stops)
        if not len(ends) or ends[-1] != stops[-1] or (ends[cut] != stops).any():
            return {w: self.one(w) for w in words}
        flat, cut = ids.tobytes(), 4 * (cut + 1)
        return {w: flat[a:b] for w, a, b in zip(words, [0, *cut[:-1].tolist()], cut.tolist(), strict=True)}

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if len(w) <= 64 and w not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = [w for w in words if len(w) <= 64]
        for at in range(0, len(new), 1_024):
            self.update(self.many(new[at : at + 1_024]))

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint32)

    def ids_of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has; a word is looked up once, however often it stands there."""
        self.learn({w for w in words.kinds})
        each = [self[w] for w in words.kinds]
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat, first = np.frombuffer(b"".join(each), np.uint32), np.cumsum(size) - size
        many = size[words.codes]
        stops = np.cumsum(many)
        at = np.arange(stops[-1] if len(stops) else 0) + np.repeat(first[words.codes] - stops + many, many)
        per_text = np.diff(np.concatenate([[0], stops])[words.ends], prepend=0)
        return flat[at], per_text


# ---- the model


def new_weights(shares: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; classes begin with their ``shares``, by groups and in them."""
    r = np.random.default_rng(seed)
    d, shares = SIZE, shares.reshape(GROUPS, MEMBERS)
    make = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return {
        "table": make(GROUPS * MEMBERS, d, scale=0.5), "place": make(SPAN, d, scale=0.1), "query": make(d, d, scale=d**-0.5), "key": make(d, d, scale=d**-0.5),
        "value": make(d, d, scale=d**-0.5), "join": make(d, d, scale=0.5 * d**-0.5), "up": make(d, INNER, scale=d**-0.5), "shift": np.zeros(INNER, np.float32),
        "down": make(INNER, d, scale=0.5 * INNER**-0.5), "group": make(d, GROUPS, scale=0.02), "group_prior": np.log(shares.sum(1)).astype(np.float32),
        "member": make(GROUPS, d, MEMBERS, scale=0.02), "member_prior": np.log(shares / shares.sum(1, keepdims=True)).astype(np.float32),
    }


#: Position CONTEXT + i of a window sees the positions up to itself.
_SEEN = (np.arange(SPAN)[None, :] <= np.arange(CONTEXT, SPAN)[:, None]).astype(np.float32)
_MASK, _ONES = np.where(_SEEN > 0, 0, -1e9).astype(np.float32), np.ones(SPAN, np.float32)


def _even(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r = 1 / np.sqrt(np.einsum("...d,...d->...", h, h)[..., None] / h.shape[-1] + 1e-5)
    return h * r, r


def _even_back(dn: np.ndarray, n: np.ndarray, r: np.ndarray) -> np.ndarray:
    return r * (dn - n * (np.einsum("...d,...d->...", dn, n)[..., None] / n.shape[-1]))


def _forward(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Vectors at the positions past the context of each window, and what the way back needs."""
    d = SIZE
    h0 = w["table"].take(x, axis=0)
    h0 += w["place"]
    n0, r0 = _even(h0)
    flat = n0.reshape(-1, d)
    k, v = (flat @ w["key"]).reshape(n0.shape), (flat @ w["value"]).reshape(n0.shape)
    late = np.ascontiguousarray(n0[:, CONTEXT:])
    q = (late.reshape(-1, d) @ w["query"]).reshape(late.shape)
    q *= d**-0.5
    a = q @ k.transpose(0, 2, 1)
    a += _MASK
    a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)
    a /= (a @ _ONES)[..., None]
    o = (a @ v).reshape(-1, d)
    h1 = o @ w["join"]
    h1 += h0[:, CONTEXT:].reshape(-1, d)
    n1, r1 = _even(h1)
    g = n1 @ w["up"]
    g += w["shift"]
    np.maximum(g, 0, out=g)
    n2, r2 = _even(h1 + g @ w["down"])
    return n2, (n0, r0, k, v, late, q, a, o, n1, r1, g, r2)


def _by_group(y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the rows by the group of their class, and (group, first, end) in it of each group that occurs."""
    groups = (y // MEMBERS).astype(np.uint8)
    order = np.argsort(groups, kind="stable")
    ends = np.cumsum(np.bincount(groups, minlength=GROUPS))
    return order, [(g, int(a), int(b)) for g, a, b in zip(range(GROUPS), [0, *ends[:-1]], ends, strict=True) if a < b]


def _softmax(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log probabilities of the classes ``y``; ``z`` becomes the probabilities of all."""
    z -= z.max(1, keepdims=True)
    rows = np.arange(len(z))
    of = z[rows, y]
    np.exp(z, out=z)
    total = z.sum(1)
    z /= total[:, None]
    return of - np.log(total)


def _members(w: dict[str, np.ndarray], n2: np.ndarray, order: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = n2[order]
    z = np.empty((len(rows), MEMBERS), n2.dtype)
    for g, a, b in spans:
        np.matmul(rows[a:b], w["member"][g], out=z[a:b])
        z[a:b] += w["member_prior"][g]
    return rows, z


def _told(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log probabilities of the classes ``y`` alone; ``z`` is used up."""
    z -= z.max(1, keepdims=True)
    of = z[np.arange(len(z)), y]
    np.exp(z, out=z)
    return of - np.log(z @ np.ones(z.shape[1], z.dtype))


def is_bounded(w: dict[str, np.ndarray]) -> bool:
    """Whether no score of a class can leave what exp takes: vectors have the length SIZE ** 0.5."""
    most = lambda out, prior: float(SIZE**0.5 * np.sqrt((out**2).sum(-2)).max() + np.abs(prior).max())
    match = float(SIZE**0.5 * np.linalg.norm(w["query"], 2) * np.linalg.norm(w["key"], 2))
    return max(match, most(w["group"], w["group_prior"]), most(w["member"], w["member_prior"])) < 80


def prepared(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What depends on a class and its place alone, for all of them, and layers with their shifts as a last row."""
    h = w["table"] + w["place"][:, None]
    n, late, d = _even(h)[0], slice(CONTEXT, None), SIZE
    shifted = lambda layer, shift: np.ascontiguousarray(np.concatenate([layer, shift[..., None, :]], -2))
    return {
        "key": (n @ w["key"]).reshape(-1, d), "value": (n @ (w["value"] @ w["join"])).reshape(-1, d), "query": (n[late] @ w["query"] * d**-0.5).reshape(-1, d).astype(h.dtype), "own": h[late].reshape(-1, d),
        "up": shifted(w["up"], w["shift"]), "down": w["down"], "group": shifted(w["group"], w["group_prior"]), "member": shifted(w["member"], w["member_prior"]),
    }


_PLACES = (np.arange(SPAN) * GROUPS * MEMBERS).astype(np.intp)


def _evened(h: np.ndarray) -> np.ndarray:
    """``_even`` of ``h`` with a last column of ones, which meets a layer's shift."""
    out = np.empty((len(h), h.shape[1] + 1), h.dtype)
    r = np.einsum("id,id->i", h, h)
    r /= h.shape[1]
    r += 1e-5
    np.sqrt(r, out=r)
    np.divide(h, r[:, None], out=out[:, :-1])
    out[:, -1] = 1
    return out


def told(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``log_probabilities`` from ``prepared`` weights that are ``is_bounded``: the same sums, without maxima taken off."""
    at = x + _PLACES
    late = at[:, CONTEXT:] - _PLACES[CONTEXT]
    a = p["query"].take(late, axis=0) @ p["key"].take(at, axis=0).transpose(0, 2, 1)
    np.exp(a, out=a)
    a *= _SEEN
    h = a @ p["value"].take(at, axis=0)
    h /= (a @ _ONES.astype(a.dtype))[..., None]
    h += p["own"].take(late, axis=0)
    h = h.reshape(-1, SIZE)
    g = _evened(h) @ p["up"]
    np.maximum(g, 0, out=g)
    h += g @ p["down"]
    n = _evened(h)
    classes, rows, ones = y.ravel(), np.arange(len(n)), np.ones(MEMBERS, n.dtype)
    groups, members = np.divmod(classes, MEMBERS)
    order, spans = _by_group(classes)
    z = n @ p["group"]
    out = z.ravel().take(rows * GROUPS + groups)
    np.exp(z, out=z)
    total = z @ ones
    n, z = n.take(order, axis=0), np.empty((len(n), MEMBERS), n.dtype)
    for k, a, b in spans:
        np.matmul(n[a:b], p["member"][k], out=z[a:b])
    of = z.ravel().take(rows * MEMBERS + members.take(order))
    np.exp(z, out=z)
    out[order] += of - np.log(z @ ones)
    out -= np.log(total)
    return out.reshape(y.shape)


def log_probabilities(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, bounded: bool = False) -> np.ndarray:
    """Natural log probability of each class ``y`` (windows by positions past the context); ``bounded`` as ``is_bounded``."""
    if bounded:
        return told(prepared(w), x, y)
    n2, _ = _forward(w, x)
    classes = y.ravel()
    order, spans = _by_group(classes)
    z = n2 @ w["group"]
    z += w["group_prior"]
    out = _told(z, classes // MEMBERS)
    _, z = _members(w, n2, order, spans)
    out[order] += _told(z, classes[order] % MEMBERS)
    return out.reshape(y.shape)


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the positions with ``counts`` 1 and its gradients."""
    n2, (n0, r0, k, v, late, q, a, o, n1, r1, g, r2) = _forward(w, x)
    d, classes, flat = SIZE, y.ravel(), counts.ravel().astype(n2.dtype)
    share = flat / max(flat.sum(), 1)
    rows = np.arange(len(n2))
    z = n2 @ w["group"] + w["group_prior"]
    loss = _softmax(z, classes // MEMBERS)
    z[rows, classes // MEMBERS] -= 1
    z *= share[:, None]
    out = {"group": n2.T @ z, "group_prior": z.sum(0)}
    dn2 = z @ w["group"].T
    order, spans = _by_group(classes)
    sorted_n2, z = _members(w, n2, order, spans)
    loss[order] += _softmax(z, classes[order] % MEMBERS)
    z[rows, classes[order] % MEMBERS] -= 1
    z *= share[order][:, None]
    out["member"], out["member_prior"] = np.zeros_like(w["member"]), np.zeros_like(w["member_prior"])
    back = np.empty_like(sorted_n2)
    for m, first, end in spans:
        out["member"][m], out["member_prior"][m] = sorted_n2[first:end].T @ z[first:end], z[first:end].sum(0)
        np.matmul(z[first:end], w["member"][m].T, out=back[first:end])
    dn2[order] += back
    dh2 = _even_back(dn2, n2, r2)
    out["down"] = g.T @ dh2
    dg = (dh2 @ w["down"].T) * (g > 0)
    out["up"], out["shift"] = n1.T @ dg, dg.sum(0)
    dh1 = dh2 + _even_back(dg @ w["up"].T, n1, r1)
    out["join"] = o.T @ dh1
    do = (dh1 @ w["join"].T).reshape(late.shape)
    dv, da = a.transpose(0, 2, 1) @ do, do @ v.transpose(0, 2, 1)
    da = a * (da - (da * a).sum(-1, keepdims=True))
    dq, dk = (da @ k).reshape(-1, d) * d**-0.5, (da.transpose(0, 2, 1) @ q).reshape(-1, d)
    dv, all_of = dv.reshape(-1, d), n0.reshape(-1, d)
    out["query"], out["key"], out["value"] = late.reshape(-1, d).T @ dq, all_of.T @ dk, all_of.T @ dv
    dn0 = (dk @ w["key"].T + dv @ w["value"].T).reshape(n0.shape)
    dn0[:, CONTEXT:] += (dq @ w["query"].T).reshape(late.shape)
    dh0 = _even_back(dn0, n0, r0)
    dh0[:, CONTEXT:] += dh1.reshape(late.shape)
    out["place"], out["table"] = dh0.sum(0), np.zeros_like(w["table"])
    seen = np.argsort(x.ravel(), kind="stable")
    rows = x.ravel()[seen]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    out["table"][rows[first]] = np.add.reduceat(dh0.reshape(-1, d)[seen], first)
    return -float((loss * share).sum()), out


class Adam:
    def __init__(self, w: dict[str, np.ndarray], rate: float):
        self.w, self.rate, self.step = w, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in w.items()}
        self.square = {k: np.zeros_like(v) for k, v in w.items()}

    def take(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        size = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale, warm = min(1.0, 1.0 / max(size, 1e-12)), min(1.0, self.step / 20)
        for key, g in grads.items():
            g = g * np.float32(scale)
            m, s = self.mean[key], self.square[key]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            self.w[key] -= self.rate * warm * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-8)


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for key in sorted(like):
        out[key] = flat[at : at + like[key].size].reshape(like[key].shape).astype(np.float32)
        at += like[key].size
    return out


def _keep_freed() -> None:
    """Lets this process reuse freed arrays of up to 32 MB, not map and clear new pages for each (three times the
    time); ``give_back`` returns them at a task's end. Where the C library has no such setting, nothing changes."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(-3, 32 << 20)
        mallopt(-1, 64 << 20)


# ---- windows


def windows(streams: list[np.ndarray], opens: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, counts, owner) of the windows over streams of classes. A stream that ``opens`` a text has ends before
    it, and all its classes are targets; of another the first ``CONTEXT`` are context."""
    step = SPAN - CONTEXT
    xs, ys, counts, owner = [], [], [], []
    for i, (s, first) in enumerate(zip(streams, opens, strict=True)):
        n = len(s) if first else len(s) - CONTEXT
        if n <= 0:
            continue
        many = -(-n // step)
        # a window's inputs stand one place before what they tell
        full = np.full(many * step + CONTEXT + 1, END, np.int32)
        at = 1 + CONTEXT if first else 1
        full[at : at + len(s)] = s
        xs.append(np.lib.stride_tricks.sliding_window_view(full[:-1], SPAN)[::step])
        ys.append(full[1 + CONTEXT :].reshape(many, step))
        real = np.ones((many, step), bool)
        real[-1, n - (many - 1) * step :] = False
        counts.append(real)
        owner.append(np.full(many, i))
    if not xs:
        return np.zeros((0, SPAN), np.int32), np.zeros((0, step), np.int32), np.zeros((0, step), bool), np.zeros(0, np.int64)
    return np.concatenate(xs), np.concatenate(ys), np.concatenate(counts), np.concatenate(owner)


@dataclass(frozen=True)
class Vocabulary:
    """``klass`` of each id, and the log10 share that an id has of its class's probability (0 but for ``OTHER``)."""

    path: str
    pattern: str
    klass: np.ndarray
    share: np.ndarray
    shares: np.ndarray  # of all classes; those that no id has are next to nothing

    @classmethod
    def of(cls, counts: dict[int, int], ends: int, path: str, pattern: str) -> Vocabulary:
        encoding = _encoding(path, pattern)
        size, most = encoding.n_vocab, GROUPS * MEMBERS
        n = np.zeros(size, np.int64)
        for i, c in counts.items():
            n[i] = c
        frequent = [i for i in np.lexsort((np.arange(size), -n))[: most - 2].tolist() if n[i]]
        frequent.sort(key=lambda i: not encoding.decode_single_token_bytes(i).startswith(b" "))  # keeps the order otherwise
        klass = np.full(size, OTHER, np.int32)
        klass[frequent] = np.arange(2, 2 + len(frequent))
        rest = klass == OTHER
        share = np.zeros(size)
        share[rest] = np.log10((n[rest] + 1) / (n[rest].sum() + rest.sum()))
        of = np.bincount(klass, weights=n, minlength=most) + np.where(np.arange(most) < 2 + len(frequent), 1, 1e-9)
        of[END] += ends
        return cls(path, pattern, klass, share, of / of.sum())


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    weights: dict[str, np.ndarray]

    def scorer(self) -> Callable[[list[list[bytes]] | Words], np.ndarray]:
        """From the words of texts to their log10 probabilities, ends included."""
        known, klass, share, w = WordIds(self.vocabulary.path, self.vocabulary.pattern), self.vocabulary.klass, self.vocabulary.share, self.weights

        ready = prepared(w) if is_bounded(w) else None
        _keep_freed()

        def score(texts):
            words = texts if isinstance(texts, Words) else Words.of_lists(texts)
            ids, many = known.ids_of(words)
            ends = np.cumsum(many)
            out = np.bincount(np.repeat(np.arange(len(many)), many), weights=share[ids], minlength=len(many)).astype(np.float64)
            classes = np.insert(klass[ids], ends, END)  # an end after each text
            x, y, counts, owner = windows(np.split(classes, (ends + np.arange(1, len(ends) + 1))[:-1]) if len(ends) else [], [True] * len(many))
            for at in range(0, len(x), SIDE_BY_SIDE):
                part = slice(at, at + SIDE_BY_SIDE)
                found = told(ready, x[part], y[part]) if ready else log_probabilities(w, x[part], y[part])
                found = (found * counts[part]).sum(1, dtype=np.float64)
                out += np.bincount(owner[part], weights=found, minlength=len(many)) / math.log(10)
            return out

        return score


# ---- learning


def gather(training: DataFrame, share: int, first: int) -> DataFrame:
    """One pass over whole texts: (word, n) with partial counts, and (stretch, opens, closes, slot) of every ``share``-th stretch,
    so at 1 of all; of the others each task gives the ``first`` with the smallest hashes, with their ``rank``."""
    ship_package(training.sparkSession)
    schema = pa.schema({"word": pa.binary(), "n": pa.int64(), "stretch": pa.binary(), "opens": pa.bool_(), "closes": pa.bool_(), "slot": pa.int32(), "rank": pa.int64()})

    def batch(word=(), n=(), stretches=()):
        rest = [pa.array(c, t) for c, t in zip(zip(*stretches, strict=True), schema.types[2:], strict=True)] if stretches else [pa.nulls(len(word), t) for t in schema.types[2:]]
        head = [pa.nulls(len(stretches), t) for t in schema.types[:2]] if stretches else [pa.array(word, pa.binary()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(head + rest, schema=schema)

    def run(batches):
        count: Counter[bytes] = Counter()
        low: list[tuple] = []
        limit = np.uint64(2**64 - 1)
        for part in rows_in_slices(batches):
            taken = []
            for text, mark in zip(part.column(0).cast(pa.binary()).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = words_of(text)
                count.update(words)
                many = max(1, -(-len(words) // STRETCH))
                own = mark % (share * ROUNDS)
                picked = range(-own % share, many, share)
                if share > 1:
                    hashes = _mix(np.arange(1, many + 1, dtype=np.uint64) * _ODD + np.uint64(mark % 2**64))
                    picked = {*picked, *np.flatnonzero(hashes <= limit).tolist()}
                for k in picked:
                    row = (b" ".join(words[k * STRETCH : (k + 1) * STRETCH]), k == 0, k == many - 1)
                    if (k + own) % share == 0:
                        taken.append((*row, (own // share + k // share) % ROUNDS, None))
                    else:
                        low.append((*row, int(hashes[k]) % ROUNDS, int(hashes[k]) - 2**63))
                if len(low) > 2 * first:
                    low = sorted(low, key=_rank)[:first]
                    limit = np.uint64(low[-1][-1] + 2**63) if low else np.uint64(0)
            if taken:
                yield batch(stretches=taken)
            if len(count) > COUNTED_WORDS:
                yield batch(list(count), list(count.values()))
                count.clear()
        if count:
            yield batch(list(count), list(count.values()))
        low = sorted(low, key=_rank)[:first]
        for at in range(0, len(low), 1_024):
            yield batch(stretches=low[at : at + 1_024])
        del count, low
        give_back()

    text = F.col("text").cast("string")
    mark = F.xxhash64(text, "doc_id").alias("mark")
    return training.select(text.alias("text"), mark).mapInArrow(run, "word binary, n long, stretch binary, opens boolean, closes boolean, slot int, rank long")


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _rank(row: tuple) -> int:
    return row[-1]


def id_counts(counts: DataFrame, path: str, pattern: str) -> dict[int, int]:
    """How often each id occurs in the words of ``counts`` (word, c); as many rows as the vocabulary has at most."""

    def run(batches):
        known = WordIds(path, pattern)
        total = np.zeros(len(known.lengths), np.int64)
        for part in rows_in_slices(batches, 8_192):
            words = part.column(0).to_pylist()  # each word comes once
            known.clear()
            known.learn(set(words))
            ids = [known[w] for w in words]
            n = np.repeat(part.column(1).to_numpy(), [len(i) // 4 for i in ids])
            np.add.at(total, np.frombuffer(b"".join(ids), np.uint32), n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])

    found = counts.select("word", "c").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in found.toLocalIterator()}


def _train(start: dict[str, np.ndarray], vocabulary: Vocabulary, rate: float, stretches: Iterator[list[tuple[bytes, bool, bool]]], seed: int, least: int) -> tuple[dict[str, np.ndarray], int]:
    """Weights after the stretches, and how many ids they had. Few stretches are gone over again, up to ``least`` steps."""
    known, r = WordIds(vocabulary.path, vocabulary.pattern), np.random.default_rng(seed)
    adam, ids, kept = Adam({k: v.copy() for k, v in start.items()}, rate), 0, []

    def steps(x, y, counts):
        order = r.permutation(len(x))
        for at in range(0, len(x), BATCH_WINDOWS):
            part = order[at : at + BATCH_WINDOWS]
            adam.take(gradients(adam.w, x[part], y[part], counts[part])[1])

    for some in stretches:
        streams, texts = [], [text.split() for text, _, _ in some]
        known.learn(set().union(*texts))
        for words, (_, _, closes) in zip(texts, some, strict=True):
            classes = vocabulary.klass[known.ids(words)]
            streams.append(np.append(classes, END) if closes else classes)
        x, y, counts, _ = windows(streams, [opens for _, opens, _ in some])
        ids += int(counts.sum())
        if len(x) and adam.step < least:
            kept.append((x, y, counts))
        steps(x, y, counts)
    while kept and adam.step < least:
        for part in kept:
            steps(*part)
    return adam.w, ids


def one_round(stretches: DataFrame, start: dict[str, np.ndarray], vocabulary: Vocabulary, rate: float, tasks: int, seed: int) -> dict[str, np.ndarray]:
    """The tasks' weights, averaged by their ids: summed in tasks first, then ``_SUMMED`` sums at most on the driver."""
    schema = pa.schema({"ids": pa.int64(), "weights": pa.binary()})
    least = LEAST_IDS // (BATCH_WINDOWS * (SPAN - CONTEXT))

    def row(ids, flat):
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.int64()), pa.array([flat.tobytes()], pa.binary())], schema=schema)

    def train(batches):
        _keep_freed()
        parts = (list(zip(*(c.to_pylist() for c in p.columns), strict=True)) for p in rows_in_slices(batches, 2_048))
        w, ids = _train(start, vocabulary, rate, parts, seed, least)
        if ids:
            yield row(ids, pack(w).astype(np.float64) * ids)
        give_back()

    def add(batches):
        total, ids = None, 0
        for b in batches:
            for n, flat in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                flat = np.frombuffer(flat, np.float64)
                total, ids = (flat if total is None else total + flat), ids + n
        if ids:
            yield row(ids, total)

    order = F.xxhash64("stretch")
    dealt = stretches.select("stretch", "opens", "closes").repartition(tasks, order).sortWithinPartitions(order, "stretch", "opens", "closes")
    rows = dealt.mapInArrow(train, "ids long, weights binary").repartition(min(tasks, _SUMMED)).mapInArrow(add, "ids long, weights binary").collect()
    if not rows:
        return start
    return unpack(sum(np.frombuffer(r.weights, np.float64) for r in rows) / sum(r.ids for r in rows), start)


@dataclass(frozen=True)
class Fitted:
    """``counts`` (word, c) of the training words, ``tokens`` with ends and their number of kinds, and the model."""

    counts: DataFrame
    tokens: int
    kinds: int
    ends: int
    model: Model


def fit(training: DataFrame, path: str, pattern: str) -> Fitted:
    # holds the training texts, in stretches
    gathered = store(gather(training, SHARE, FIRST), "gathered", compression="zstd")
    counts = store(gathered.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")), "words")
    kinds, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = training.count()
    vocabulary = Vocabulary.of(id_counts(counts, path, pattern), ends, path, pattern)
    weights = new_weights(vocabulary.shares)
    stretches = gathered.where("stretch is not null and rank is null")
    low = gathered.where("rank is not null").orderBy("rank", "stretch", "opens", "closes").limit(FIRST)
    stretches = stretches.unionByName(store(low, "first"))
    # ids are some 2.3 bytes each
    size = (stretches.agg(F.sum(F.octet_length("stretch") + 1)).first()[0] or 0) / 2.3
    tasks = max(1, round(size / ROUNDS / TASK_IDS))
    for k in range(ROUNDS):
        weights = one_round(stretches.where(F.col("slot") == k), weights, vocabulary, RATE * (1 - k / ROUNDS), tasks, k)
    return Fitted(counts, total + ends, kinds + (ends > 0), ends, Model(vocabulary, weights))


# ---- scoring


def _frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of the most frequent words, ``most`` at most: those above a step of a histogram of logarithms."""
    step = F.floor(F.log2("c") * 16).alias("step")
    held, least = 0, None
    for row in sorted(counts.groupBy(step).count().collect(), key=lambda r: -r.step):
        held += row["count"]
        if held > most:
            break
        least = row.step
    if least is None:
        return {}
    return {bytes(r.word): r.c for r in counts.where(step >= least).select("word", "c").toLocalIterator()}


def score(documents: DataFrame, fitted: Fitted) -> DataFrame:
    """``documents`` with n_tokens, n_known, train_tokens, base_score and score; each whole text is split once."""
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    frequent, model, has_ends = _frequent(fitted.counts, KNOWN_WORDS), fitted.model, int(fitted.ends > 0)
    even = fitted.tokens + fitted.kinds + 1
    end = math.log10((fitted.ends + 1) / even)
    kept = documents.drop(*new)
    names = [f"c{i}" for i in range(len(kept.columns))]  # stand for the columns, so that names may clash
    rows = kept.toDF(*names)
    text = rows[names[kept.columns.index("text")]].cast("string")

    def make():
        of = model.scorer()

        def work(part):
            words = Words.of(part.column(part.schema.get_field_index("_text")))
            many, texts = words.lengths(), words.texts()
            c = np.array([frequent.get(w, 0) for w in words.kinds], np.int64)
            met = c > 0
            seen = np.bincount(texts, weights=met[words.codes], minlength=len(many)).astype(np.int64) + has_ends
            base = np.bincount(texts, weights=np.where(met, np.log10((c + 1) / even), 0.0)[words.codes], minlength=len(many)).astype(np.float64) + end
            # the other words, once a text with their number
            rare = ~met[words.codes]
            pairs, times = np.unique(texts[rare] * len(c) + words.codes[rare], return_counts=True)
            at = np.concatenate([[0], np.cumsum(np.bincount(pairs // max(len(c), 1), minlength=len(many)))])
            kinds = pa.array(words.kinds, pa.binary()).take(pa.array(pairs % max(len(c), 1)))
            pairs = pa.StructArray.from_arrays([kinds, pa.array(times, pa.int64())], names=["word", "n"])
            return [many + 1, seen, base, of(words), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs)]

        return work

    made = add_columns(rows.withColumn("_text", text), "_n long, _seen long, _base double, _score double, _rare array<struct<word: binary, n: long>>", make)
    made = store(made.drop("_text").withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = made.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.n")
    met = rare.join(fitted.counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = met.groupBy("_row").agg(F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(even)))).alias("_more"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_met"))
    whole = made.drop("_rare").join(store(sums, "rare"), "_row", "left")
    return whole.select(
        *(F.col(c).alias(was) for c, was in zip(names, kept.columns, strict=True)),
        F.col("_n").alias("n_tokens"),
        (F.col("_seen") + F.coalesce("_met", F.lit(0))).alias("n_known"),
        F.lit(fitted.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"),
        F.col("_score").alias("score"),
    )


def op11(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    held = F.coalesce(crc32_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), held.alias("held_out"))
    fitted = fit(rows.where("not held_out").select("doc_id", "text"), path, pattern)
    return score(rows, fitted).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
