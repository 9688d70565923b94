"""Byte-level BPE encoding and decoding by ranks.

A text is cut by the vocabulary's pattern; each piece is merged on its own. The pairs of live
neighbours of a piece sit in a segment tree over its byte positions: a leaf holds the rank of the pair
that starts there, joined with its position, so the root is the leftmost pair of least rank. A merge
writes three leaves (the merged start, the swallowed start, the live neighbour on the left), each in a
logarithmic number of steps, so a piece of n bytes costs O(n log n) even when it is one huge word.

The pieces of a slice of texts that are new to the task are merged together: the trees of one size class are the
rows of one numpy array, and a step takes all roots, makes one merge in each row and writes its three leaves
up level by level. A rank is looked up by the ids of its two parts. Huge pieces, and size classes of few
pieces, are merged one by one.

What a task remembers of pieces is bounded in bytes (``MEMORY_BYTES``) and goes with the task.

Nulls: a null text encodes as the empty text (no ids). Empty and very long texts are whole; repeated
rows give repeated results; other columns, nulls among them, pass through untouched, but for those of the
names of the new ones, which are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import add_columns

#: Bytes, as estimated, of the pieces that a task remembers. Past it the memory starts anew; results do not
#: change.
MEMORY_BYTES = 40 << 20
#: Pieces of a text that are in hand at once.
CHUNK_PIECES = 200_000
#: Bytes of the longest pieces that are merged as rows of an array; least rows of an array; most leaves of one.
ROW_BYTES, LEAST_ROWS, MOST_LEAVES = 128, 8, 1 << 17
NO_PAIR = 1 << 62
NO_RANK = NO_PAIR >> 32


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [NO_PAIR] * (2 * size)
    end = list(range(1, n + 1))  # of the live token that starts at a position
    before = list(range(-1, n))  # start of the live token on the left of a position
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for k in range(size - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    while (least := tree[1]) != NO_PAIR:
        i = least & 0xFFFFFFFF
        j = end[i]
        stop = end[i] = end[j]
        before[stop] = i
        rank = get(piece[i : end[stop]]) if stop < n else None
        changes = [(i, NO_PAIR if rank is None else rank << 32 | i)]
        if tree[size + j] != NO_PAIR:
            changes.append((j, NO_PAIR))
        h = before[i]
        if h >= 0:
            rank = get(piece[h:stop])
            value = NO_PAIR if rank is None else rank << 32 | h
            if tree[size + h] != value:
                changes.append((h, value))
        for at, value in changes:  # point updates, each up one path and no further than it matters
            k = size + at
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class PairRanks:
    """Rank of a pair by the ids of its parts: a table with open addressing, read for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1  # stands for no token and pairs with none
        self.stride = self.none + 1
        self.byte = np.array([ranks.get(bytes([b]), self.none) for b in range(256)], np.int64)
        get = ranks.get
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = get(token[:k]), get(token[k:])
                if left is not None and right is not None:
                    keys.append(left * self.stride + right)
                    values.append(rank)
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NO_RANK, np.int32)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            self.keys[slot[free]] = keys[free]
            at = slot[free]
            mine = self.keys[at] == keys[free]  # of several for one slot, one has it
            self.values[at[mine]] = values[free[mine]]
            left = self.keys[slot] != keys
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; ``NO_RANK`` where two ids make no token."""
        keys = left * self.stride + right
        slot = self._slot(keys)
        there = self.keys[slot]
        away = np.flatnonzero((there != keys) & (there >= 0))
        while len(away):
            slot[away] = (slot[away] + 1) & self.last
            there = self.keys[slot[away]]
            away = away[(there != keys[away]) & (there >= 0)]
        return self.values[slot].astype(np.int64)


def merge_rows(pieces: list[bytes], size: int, pairs: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces one after another, how many each has): the pieces, of at most ``size`` bytes each, a
    power of two, are merged side by side, a merge of each at a time."""
    m = len(pieces)
    n = np.array([len(p) for p in pieces])
    inside = np.arange(size) < n[:, None]
    token = np.full((m, size + 2), pairs.none)  # by start; the last place is left of the first
    letters = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(m, size)
    token[:, :size][inside] = pairs.byte[letters[inside]]
    tree = np.full((m, 2 * size), NO_PAIR)
    rank = pairs.of(token[:, : size - 1].ravel(), token[:, 1:size].ravel()).reshape(m, size - 1)
    tree[:, size : 2 * size - 1] = np.where(rank == NO_RANK, NO_PAIR, rank << 32 | np.arange(size - 1))
    level = size
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    end = np.tile(np.arange(1, size + 2), (m, 1)).ravel()
    before = np.tile(np.arange(-1, size), (m, 1)).ravel()
    live, token, tree = inside.ravel(), token.ravel(), tree.ravel()
    rows = np.arange(m)
    while True:
        root = tree[rows * (2 * size) + 1]
        on = root != NO_PAIR
        if not on.all():
            rows, root = rows[on], root[on]
            if not len(rows):
                break
        of_tree, of_token, of_end = rows * (2 * size), rows * (size + 2), rows * (size + 1)
        i, merged = root & 0xFFFFFFFF, root >> 32
        j = end[of_end + i]
        stop = end[of_end + j]
        end[of_end + i] = stop
        before[of_end + stop] = i
        token[of_token + i] = merged
        live[rows * size + j] = False
        h = before[of_end + i]
        first = h < 0
        rank = pairs.of(
            np.concatenate([merged, token[of_token + np.where(first, size + 1, h)]]), np.concatenate([token[of_token + stop], merged])
        )
        value = np.where(rank == NO_RANK, NO_PAIR, rank << 32 | np.concatenate([i, h]))
        # the three leaves; without a left neighbour the swallowed one is written twice
        tops = np.tile(of_tree, 3)
        at = np.concatenate([i, np.where(first, j, h), j]) + size
        tree[tops + at] = np.concatenate([value, np.full(len(rows), NO_PAIR)])
        for _ in range(size.bit_length() - 1):
            at >>= 1
            below = tops + 2 * at
            tree[tops + at] = np.minimum(tree[below], tree[below + 1])
    live = live.reshape(m, size)
    return token.reshape(m, size + 2)[:, :size][live], live.sum(axis=1)


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... for each k, counts[k] of them."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


class _Numbers(dict):
    """Numbers pieces in order of their first sight; ``new`` has those whose ids aren't known yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts with a memory of pieces. The pattern may be any."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: PairRanks | None = None):
        self.ranks, self.pairs = ranks, pairs or PairRanks(ranks)
        self.pattern = regex.compile(pattern)
        self._forget()

    def _forget(self):
        self.index = _Numbers()
        self.bytes = 0
        self.ids = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1, np.int64)  # of each piece in ids, and of the next one

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= CHUNK_PIECES and not self.pattern.groups:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(found, CHUNK_PIECES)):
            yield some

    def _learn(self):
        """Merges the new pieces, size class by size class."""
        new = [x.encode("utf-8") for x in self.index.new]
        self.index.new.clear()
        if not new:
            return
        lengths = np.array([len(x) for x in new])
        counts = np.ones(len(new), np.int64)
        whole = [self.ranks.get(x, -1) for x in new]
        known = np.array(whole) >= 0
        done = [(np.flatnonzero(known), np.array([x for x in whole if x >= 0], np.int64))]
        size = 1
        left = ~known
        while left.any():
            some = np.flatnonzero(left & (lengths <= size))
            left[some] = False
            if size == 1 or size > ROW_BYTES or len(some) < LEAST_ROWS:
                single = [merge_piece(new[k], self.ranks) for k in some]
                counts[some] = [len(x) for x in single]
                done.append((some, np.array([y for x in single for y in x], np.int64)))
            else:
                step = MOST_LEAVES // size
                for at in range(0, len(some), step):
                    part = some[at : at + step]
                    flat, counts[part] = merge_rows([new[k] for k in part], size, self.pairs)
                    done.append((part, flat))
            size *= 2
        first = self.first[-1] + np.concatenate([[0], np.cumsum(counts)])
        if first[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids[: first[0]], np.empty(2 * int(first[-1]) - int(first[0]), np.int32)])
        for at, flat in done:
            self.ids[_spread(first[at], counts[at])] = flat
        self.first = np.concatenate([self.first[:-1], first])
        self.bytes += int(lengths.sum() + 4 * counts.sum()) + 150 * len(new)

    def _ids(self, codes: list[int], owners: list[tuple[int, int]], counts: np.ndarray) -> np.ndarray:
        """The ids of pieces; ``owners`` (text, pieces) adds to the texts' ``counts``."""
        self._learn()
        codes = np.array(codes, np.int64)
        first = self.first[codes]
        n = self.first[codes + 1] - first
        text, pieces = np.array(owners, np.int64).T
        counts += np.bincount(np.repeat(text, pieces), n, minlength=len(counts)).astype(np.int64)
        ids = self.ids[_spread(first, n)]
        if self.bytes > MEMORY_BYTES:
            self._forget()
        return ids

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, how many each has)."""
        counts, parts, codes, owners = np.zeros(len(texts), np.int64), [], [], []
        for k, text in enumerate(texts):
            for some in self._pieces(text) if text else ():
                codes += map(self.index.__getitem__, some)
                owners.append((k, len(some)))
                if len(codes) >= CHUNK_PIECES:
                    parts.append(self._ids(codes, owners, counts))
                    codes, owners = [], []
        if codes:
            parts.append(self._ids(codes, owners, counts))
        return np.concatenate(parts) if parts else np.empty(0, np.int32), counts

    def encode(self, text: str) -> bytes:
        """The ids as little-endian int32 bytes."""
        return self.encode_all([text])[0].astype("<i4").tobytes()


@lru_cache(maxsize=2)
def _pairs(path: str) -> PairRanks:
    return PairRanks(load_ranks(path))


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def _decoded(ids: np.ndarray, tokens: dict[int, bytes]) -> bytes:
    try:
        return b"".join(map(tokens.__getitem__, ids.tolist()))
    except KeyError as none:
        raise ValueError("an id is not in the vocabulary") from none


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with a column ``out`` (array<int>) of the ids of ``text``."""
    at = df.columns.index(text)

    def make():
        encoder = Encoder(load_ranks(path), pattern, _pairs(path))
        return lambda part: [_lists(*encoder.encode_all(part.column(at).to_pylist()))]

    return add_columns(df, f"`{out}` array<int>", make)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a column ``out`` (binary) of the bytes of ``ids``. An id outside the vocabulary fails;
    null ids give null bytes."""
    at = df.columns.index(ids)

    def make():
        tokens = _tokens(path)

        def work(part):
            column = part.column(at)
            return [pa.array([_decoded(x.values.to_numpy(zero_copy_only=False), tokens) if x.is_valid else None for x in column], pa.binary())]

        return work

    return add_columns(df, f"`{out}` binary", make)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` of ``text`` and ``decoded``, the bytes that the ids decode to, in one pass."""
    at = df.columns.index(text)

    def make():
        encoder, tokens = Encoder(load_ranks(path), pattern, _pairs(path)), _tokens(path)

        def work(part):
            ids, counts = encoder.encode_all(part.column(at).to_pylist())
            ends = np.cumsum(counts)
            decoded = [_decoded(ids[b - n : b], tokens) for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            return [_lists(ids, counts), pa.array(decoded, pa.binary())]

        return work

    return add_columns(df, "ids array<int>, decoded binary", make)


def op9(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = round_trip(documents.select("doc_id", "text"), path, pattern)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
