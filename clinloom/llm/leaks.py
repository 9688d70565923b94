"""Benchmark decontamination by latent semantic retrieval.

Texts are lower-cased word sequences. For a block of benchmark items (``BLOCK_WORDS`` words at most, or one item;
a larger benchmark is worked off block by block) every document is turned once into the numbers of the
block's words (one for all others) and stored. Then

1. document frequencies of the words over all segments of ``SEGMENT`` words give the TF-IDF weights;
   words in more than ``MAX_SHARE`` of the segments have weight 0; an item that could be held with none of
   its weighted words, so that this search could miss it, is left out of it and goes to step 4;
2. a randomised SVD of the matrix of all passages (two neighbouring segments, of the documents and of
   the items): each task sums A'(A.Omega) over its passages, Spark adds the sums by blocks of words, first those
   of ``ADDED_TASKS`` tasks and then their sums, and the Nystroem form of that one product gives the latent
   directions;
3. passages and items are projected, cosines of at least ``COSINE`` make candidates; those that share
   ``OVERLAP`` of the item passage's squared weights are checked by the longest common subsequence of the item
   and the text around the passage (by bit parallelism), and by the share of the item's answer, its words after
   the last "answer:" or else its last sentence, that lies there too. Paraphrases drop and change words, so the
   subsequence need not be whole. An item that stands in a text word for word is found beside this by the hash of
   its rarest run of words, whatever lies around it; where the latent search doesn't see it, its cosine is null;
4. the items left out in step 1 are checked in all texts that have enough of their words, without weights, and
   with a null cosine.

What a task sends on is a sum over the block's words, or one row for each confirmed pair. No table of
the corpus is broadcast; the block's vocabulary and projection are, bounded by ``BLOCK_WORDS``.

Nulls and edge cases: null or empty texts match nothing; a null doc_id or item_id is carried; items of
fewer than ``SHORT`` words must appear whole; repeated rows give repeated pairs, and so do repeated items; of several
places of an item in a text the one with the largest shares is told, of equal ones the latest; very long texts are
searched whole; other columns are not read, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import Memory, add_columns, rows_in_slices
from clinloom.session import discard, ship_package, store

#: Words of the items of a block.
BLOCK_WORDS = 400_000
#: Tasks whose sums are added first, and words of a block of sums.
ADDED_TASKS, SUM_WORDS = 256, 64
#: Words of the run by which an item that stands word for word is looked up.
RUN = 4
SEGMENT = 16
MAX_SHARE = 0.005
RANK = 64
COSINE = 0.45
#: Cosines that a task holds at once (16 MB): passages by the item passages of a block.
CELLS = 4_000_000
#: Least share of an item passage's squared weights that a candidate must hold; a word that it repeats counts
#: again, which only lets more through.
OVERLAP = 0.25
LCS_SHARE, ANSWER_SHARE = 0.7, 0.5
SHORT = 8
_WORD = re.compile(r"\w+").findall
RESULT = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, start_word long, end_word long"


def words_of(text: str | None) -> list[str]:
    return _WORD(text.lower()) if text else []


def answer_of(text: str) -> list[str]:
    """The words after the last "answer:", or else of the last sentence."""
    _, mark, tail = text.lower().rpartition("answer:")
    if not mark:
        tail = re.split(r"(?<=[.!?])\s+", text.strip())[-1]
    return words_of(tail)


def common_subsequence(item: list[int], region: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region.tolist():
        hit = where.get(w)
        if hit:
            both = row & hit
            row = (row + both | row - both) & full
    return len(item) - row.bit_count()


class _Block:
    """A block of items: their word numbers, passages and answers."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.index: dict[str, int] = {}
        self.ids, self.words, self.answers = [], [], []
        for item, text in items:
            words = [self.index.setdefault(w, len(self.index)) for w in words_of(text)]
            if words:
                self.ids.append(item)
                self.words.append(words)
                self.answers.append([self.index[w] for w in answer_of(text)])

    def passages(self) -> Iterator[tuple[int, np.ndarray]]:
        for k, words in enumerate(self.words):
            for at in range(0, max(1, len(words) - SEGMENT), SEGMENT):
                yield k, np.array(words[at : at + 2 * SEGMENT])


def _stretches(index: dict[str, int]) -> Memory:
    """From a stretch between ASCII white space, which no word crosses, to its words' numbers."""
    get, none = {w: k.to_bytes(4, "little") for w, k in index.items()}.get, b"\xff\xff\xff\xff"

    def numbers(stretch: bytes) -> bytes:
        text = stretch.decode("utf-8").lower()
        return get(text, none) if text.isalnum() else b"".join([get(w, none) for w in _WORD(text)])

    return Memory(numbers)


def _blocks(benchmark: DataFrame) -> Iterator[_Block]:
    """The items in order, block by block; the driver holds one block."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    texts, size = [], 0
    for row in rows.toLocalIterator():
        n = len(words_of(row[1]))
        if texts and size + n > BLOCK_WORDS:
            yield _Block(texts)
            texts, size = [], 0
        texts.append((row[0], row[1]))
        size += n
    if texts:
        yield _Block(texts)


def _numbers(documents: DataFrame, block: _Block) -> DataFrame:
    """doc_id and ``words``: the documents as int32 word numbers, -1 for words outside the block."""
    shared = documents.sparkSession.sparkContext.broadcast(block.index)

    def make():
        get = _stretches(shared.value).__getitem__

        def work(part):
            return [pa.array([b"".join(map(get, text.encode("utf-8").split())) if text else b"" for text in part.column(1).to_pylist()], pa.binary())]

        return work

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return add_columns(docs, "words binary", make).drop("text")


class _Slice:
    """Documents of a slice laid end to end in segments; ``hits`` are places of words with weight."""

    def __init__(self, blobs: list[bytes], weight: np.ndarray):
        self.words = [np.frombuffer(b, np.int32) for b in blobs]
        lengths = np.array([len(w) for w in self.words])
        segments = -(-lengths // SEGMENT)
        self.first = np.concatenate([[0], np.cumsum(segments)])  # segment of each document's start
        flat = np.concatenate(self.words) if len(self.words) else np.empty(0, np.int32)
        start = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.empty(0, np.int64)
        inside = np.arange(len(flat)) - np.repeat(start, lengths)
        segment = np.repeat(self.first[:-1], lengths) + inside // SEGMENT
        keep = flat >= 0
        keep[keep] = weight[flat[keep]] > 0
        self.word, self.segment = flat[keep], segment[keep]

    def passage_sums(self, table: np.ndarray) -> np.ndarray:
        """Column by passage: sums of the table's rows; a passage is a segment and the next of its document."""
        n = int(self.first[-1])
        sums = np.zeros((table.shape[1], n), np.float32)
        if len(self.word):
            at = np.flatnonzero(np.diff(self.segment, prepend=-1))
            to = self.segment[at]
            for k, column in enumerate(np.ascontiguousarray(table.T)):
                sums[k, to] = np.add.reduceat(column[self.word], at)
        goes_on = self.goes_on()
        sums[:, :-1] += sums[:, 1:] * goes_on[:-1]
        return sums

    def goes_on(self) -> np.ndarray:
        """1 for a segment that another of its document follows, else 0."""
        out = np.ones(int(self.first[-1]), np.float32)
        out[self.first[1:][np.diff(self.first) > 0] - 1] = 0
        return out


def _slices(batches, weight):
    for part in rows_in_slices(batches, 256):
        blobs = [b or b"" for b in part.column(1).to_pylist()]
        yield part, _Slice(blobs, weight)


SUMS = "part int, rows int, sums binary"


def _sums(part: int, rows: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([rows], pa.int32()), pa.array([values.tobytes()], pa.binary())], names=["part", "rows", "sums"])


def _document_frequency(numbers: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Segments that hold each word, and all segments."""

    def count(batches):
        total, n = np.zeros(size, np.int64), 0
        for _, piece in _slices(batches, np.ones(size)):
            pairs = np.unique(piece.segment * size + piece.word)
            total += np.bincount(pairs % size, minlength=size)
            n += int(piece.first[-1])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], names=["word", "n"])

    rows = numbers.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(size, np.int64), 0
    for word, k in rows:
        if word < 0:
            n = k
        else:
            df[word] = k
    return df, n


def _latent(numbers: DataFrame, block: _Block, weight: np.ndarray, seed: int = 7) -> np.ndarray:
    """Word by direction: the latent space of all passages, by a one-pass randomised SVD."""
    size, rank = len(weight), min(RANK, len(weight))
    omega = np.random.default_rng(seed).standard_normal((size, rank)).astype(np.float32)
    table = omega * weight[:, None].astype(np.float32)
    shared = numbers.sparkSession.sparkContext.broadcast((weight, table))
    step = SUM_WORDS

    def add(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() // ADDED_TASKS
        weight, table = shared.value
        total = np.zeros((size, rank), np.float32)
        for _, piece in _slices(batches, weight):
            projected = piece.passage_sums(table)
            # a word adds its passage's projection, for each passage that covers its segment
            reach = projected.copy()
            reach[:, 1:] += projected[:, :-1] * piece.goes_on()[:-1]
            for k, one in enumerate(reach):
                total[:, k] += np.bincount(piece.word, one[piece.segment], minlength=size)
        for k in range(0, size, step):
            one = total[k : k + step]
            if one.any():
                yield _sums(part, k // step, one.astype(np.float64))

    def join_up(key, table):
        total = sum(np.frombuffer(blob.as_buffer(), np.float64) for blob in table.column("sums"))
        return pa.Table.from_batches([_sums(-1 if len(key) == 1 else key[1].as_py(), key[0].as_py(), total)])

    # a group has ADDED_TASKS rows at most, then as many as there are such groups
    sums = numbers.mapInArrow(add, SUMS).groupBy("rows", "part").applyInArrow(join_up, SUMS).groupBy("rows").applyInArrow(join_up, SUMS)
    product = np.zeros((size, rank))
    for _, rows, blob in sums.collect():  # word by direction, bounded by the block
        one = np.frombuffer(blob, np.float64).reshape(-1, rank)
        product[rows * step : rows * step + len(one)] += one
    product *= weight[:, None]
    # the items' passages together weigh as much as all others, so that the space keeps what tells items apart
    items = np.zeros((size, rank))
    energy = 0.0
    for _, words in block.passages():
        own, n = np.unique(words, return_counts=True)  # of the block's words a passage has a few
        v = weight[own] * n
        items[own] += np.outer(v, v @ omega[own])
        energy += float(v @ v)
    whole = float((omega * product).sum()) / rank  # of A'A's trace, by Hutchinson's estimate
    product += items * (whole / energy if whole > 0 and energy > 0 else 1.0)
    # Nystroem: A'A is near P (O'P)^+ P', so its directions are those of P (O'P)^(-1/2)
    core = omega.T.astype(float) @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(), 1e-300)
    root = vectors[:, good] / np.sqrt(values[good])
    directions, _, _ = np.linalg.svd(product @ root, full_matrices=False)
    return directions.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class _Overlap:
    """The weighted words of each item passage, to look up what a candidate really shares with it."""

    def __init__(self, block: _Block, weight: np.ndarray):
        self.size, self.square = len(weight), weight**2
        sets = [np.unique(words) for _, words in block.passages()]
        self.keys = np.concatenate([k * self.size + words for k, words in enumerate(sets)])
        self.whole = np.array([self.square[words].sum() for words in sets])

    def keep(self, piece: _Slice, chunk: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the candidates (passage chunk[p], item passage q) that share ``OVERLAP`` of the item
        passage's squared weight."""
        low = np.searchsorted(piece.segment, chunk[p])
        last = chunk[p] + piece.goes_on()[chunk[p]].astype(np.int64)
        n = np.searchsorted(piece.segment, last, side="right") - low
        owner = np.repeat(np.arange(len(p)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        key = q[owner] * self.size + piece.word[place]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        shared = np.where(self.keys[at] == key, self.square[piece.word[place]], 0.0)
        total = np.bincount(owner, shared, minlength=len(p))
        good = total >= OVERLAP * self.whole[q]
        return p[good], q[good]


class _Runs:
    """Where texts hold an item word for word: its rarest run of ``RUN`` words (of all its words if it has fewer)
    is looked up by hash, and the whole item is compared there."""

    def __init__(self, items: list[list[int]], df: np.ndarray):
        self.items = [np.array(words, np.int32) for words in items]
        of_length: dict[int, list[tuple[int, int, int]]] = {}
        for k, words in enumerate(items):
            n = min(RUN, len(words))
            at = min(range(len(words) - n + 1), key=lambda i: sorted(df[words[i : i + n]].tolist()))
            of_length.setdefault(n, []).append((int(self._hash(self.items[k][at : at + n], n)[0]), k, at))
        self.tables = []
        for n, rows in of_length.items():
            key, item, at = np.array(sorted(rows), np.int64).T
            mark = np.zeros(1 << 20, bool)
            mark[key & 0xFFFFF] = True
            self.tables.append((n, key, item, at, mark))

    @staticmethod
    def _hash(words: np.ndarray, n: int) -> np.ndarray:
        """Of each run of ``n`` words, 62 bits."""
        h = np.zeros(max(0, len(words) - n + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = (h + words[k : len(words) - n + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        return (h >> np.uint64(2)).astype(np.int64)

    def found(self, documents: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, int]]:
        """(document, item) to the first place where it stands, as a range of words."""
        out: dict[tuple[int, int], tuple[int, int]] = {}
        flat = np.concatenate(documents) if documents else np.empty(0, np.int32)
        start = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype(np.int64)
        for n, key, item, offset, mark in self.tables:
            h = self._hash(flat, n)
            some = np.flatnonzero(mark[h & 0xFFFFF])
            low, high = np.searchsorted(key, h[some]), np.searchsorted(key, h[some], side="right")
            some, low, high = some[high > low], low[high > low], high[high > low]
            docs = np.searchsorted(start, some, side="right") - 1
            for place, doc, a, b in zip(some.tolist(), docs.tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, b):
                    which = int(item[k])
                    if (doc, which) not in out:
                        words, at = self.items[which], place - int(offset[k])
                        if at >= start[doc] and at + len(words) <= start[doc + 1] and np.array_equal(flat[at : at + len(words)], words):
                            out[doc, which] = (at - int(start[doc]), at - int(start[doc]) + len(words))
        return out


def _checked(words: list[int], answer: list[int], document: np.ndarray, at: int, cosine: float) -> tuple | None:
    """(LCS share, answer share, cosine, region) if the text around a passage holds the item."""
    n = len(words)
    low, high = max(0, at - n), min(len(document), at + 2 * SEGMENT + n)
    region = document[low:high]
    share = common_subsequence(words, region) / n
    if share < (LCS_SHARE if n >= SHORT else 1.0):
        return None
    if n < SHORT and np.array(words, np.int32).tobytes() not in region.tobytes():
        return None
    told = common_subsequence(answer, region) / len(answer) if answer else 1.0
    return (share, told, cosine, low, high) if told >= ANSWER_SHARE else None


def _search(numbers: DataFrame, block: _Block, weight: np.ndarray, directions: np.ndarray, df: np.ndarray) -> DataFrame:
    table = directions * weight[:, None].astype(np.float32)
    owners, vectors = [], []
    for k, words in block.passages():
        owners.append(k)
        vectors.append(table[words].sum(axis=0))
    shared = numbers.sparkSession.sparkContext.broadcast(
        (weight, table, np.array(owners), _unit(np.array(vectors)).astype(np.float32).T.copy(), _Overlap(block, weight), _Runs(block.words, df), block.ids, block.words, block.answers)
    )
    # weighted words that every item has; a passage with fewer than two or so many is no candidate
    least = min(2, min(int((weight[w] > 0).sum()) for w in block.words))

    def find(batches):
        weight, table, owners, items, overlap, runs, ids, item_words, answers = shared.value
        for part, piece in _slices(batches, weight):
            doc_ids = part.column(0).to_pylist()
            hits = np.bincount(piece.segment, minlength=int(piece.first[-1]))
            sums = piece.passage_sums(table)
            near = hits.copy()
            near[:-1] += hits[1:] * piece.goes_on()[:-1].astype(near.dtype)
            some = np.flatnonzero(near >= least)
            best: dict[tuple[int, int], tuple] = {k: (1.0, 1.0, -1.0, *place) for k, place in runs.found(piece.words).items()}
            side = max(16, CELLS // items.shape[1])
            for at in range(0, len(some), side):
                chunk = some[at : at + side]
                cosines = _unit(sums[:, chunk].T) @ items
                p, q = np.nonzero(cosines >= COSINE)
                p, q = overlap.keep(piece, chunk, p, q)
                docs = np.searchsorted(piece.first, chunk[p], side="right") - 1
                for doc, passage, item, cosine in zip(docs.tolist(), chunk[p].tolist(), owners[q].tolist(), cosines[p, q].tolist(), strict=True):
                    at_word = (passage - int(piece.first[doc])) * SEGMENT
                    row = _checked(item_words[item], answers[item], piece.words[doc], at_word, cosine)
                    if row and row > best.get((doc, item), (-1.0,)):
                        best[doc, item] = row
            if best:
                yield _as_batch([(doc_ids[d], ids[i], c if c >= 0 else None, s, t, a, b) for (d, i), (s, t, c, a, b) in sorted(best.items())])

    return numbers.mapInArrow(find, RESULT)


def _needed(n: int) -> int:
    """Words of an item of ``n`` words that a text which holds it has at least."""
    return next(k for k in range(n + 1) if k / n >= LCS_SHARE) if n >= SHORT else n


def _split(block: _Block, weight: np.ndarray) -> tuple[_Block, _Block]:
    """The block's items for the latent search, and those that a text could hold without two of their weighted
    words in one of the segments that they lie in."""
    parts = []
    weighted = [int((weight[w] > 0).sum()) for w in block.words]
    exact = [k < n - _needed(n) + n // SEGMENT + 3 for k, n in zip(weighted, map(len, block.words), strict=True)]
    for which in (False, True):
        part = _Block([])
        part.index = block.index
        part.ids, part.words, part.answers = ([x for x, e in zip(xs, exact, strict=True) if e == which] for xs in (block.ids, block.words, block.answers))
        parts.append(part)
    return parts[0], parts[1]


class _Holders:
    """Which documents hold enough of an item's words: lists of the items of each word."""

    def __init__(self, items: list[list[int]], size: int):
        self.size, self.items = size, len(items)
        self.needed = np.array([_needed(len(w)) for w in items])
        pairs = [np.unique(w, return_counts=True) for w in items]
        word = np.concatenate([w for w, _ in pairs])
        order = np.argsort(word, kind="stable")
        self.item = np.repeat(np.arange(len(items)), [len(w) for w, _ in pairs])[order]
        self.times = np.concatenate([n for _, n in pairs])[order]
        self.n = np.bincount(word, minlength=size)
        self.first = np.cumsum(self.n) - self.n

    def pairs(self, documents: list[np.ndarray]) -> list[tuple[int, int]]:
        """(document, item) for a list of documents."""
        flat = np.concatenate(documents)
        owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        some = flat >= 0
        some[some] = self.n[flat[some]] > 0
        key = np.unique(owner[some] * self.size + flat[some])
        doc, word = key // self.size, key % self.size
        n = self.n[word]
        total = int(n.sum())
        if total > 2_000_000 and len(documents) > 1:
            half = len(documents) // 2
            return self.pairs(documents[:half]) + [(d + half, k) for d, k in self.pairs(documents[half:])]
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[word], n)
        held = np.bincount(np.repeat(doc, n) * self.items + self.item[at], self.times[at], minlength=len(documents) * self.items)
        docs, items = np.nonzero(held.reshape(len(documents), self.items) >= self.needed)
        return list(zip(docs.tolist(), items.tolist(), strict=True))


def _search_exactly(numbers: DataFrame, block: _Block, size: int) -> DataFrame:
    """Pairs of the block's items, without weights."""
    shared = numbers.sparkSession.sparkContext.broadcast((_Holders(block.words, size), block.ids, block.words, block.answers))

    def find(batches):
        holders, ids, item_words, answers = shared.value
        mark = np.zeros(size + 1, bool)  # the last place is for words outside the block, -1
        # a widespread passage is checked once
        memory: dict[tuple[int, bytes], tuple | None] = {}

        def best(item: int, document: np.ndarray) -> tuple | None:
            words = item_words[item]
            n = len(words)
            mark[words] = True
            before = np.append(0, np.cumsum(mark[document]))
            mark[words] = False
            at = np.arange(0, len(document), SEGMENT)
            low, high = np.maximum(0, at - n), np.minimum(len(document), at + 2 * SEGMENT + n)
            found = None
            for k in np.flatnonzero(before[high] - before[low] >= holders.needed[item]).tolist():
                region = item, document[low[k] : high[k]].tobytes()
                if region not in memory:
                    if len(memory) >= 20_000:
                        memory.clear()
                    row = _checked(words, answers[item], document, int(at[k]), 0.0)
                    memory[region] = row and row[:2]
                row = memory[region]
                if row and (found is None or row > found[:2]):
                    found = (*row, int(low[k]), int(high[k]))
                    if row == (1.0, 1.0):
                        break
            return found

        for part in rows_in_slices(batches, 256):
            documents = [np.frombuffer(b or b"", np.int32) for b in part.column(1).to_pylist()]
            doc_ids, rows = part.column(0).to_pylist(), []
            for doc, item in holders.pairs(documents) if documents else ():
                if row := best(item, documents[doc]):
                    rows.append((doc_ids[doc], ids[item], None, *row))
            if rows:
                yield _as_batch(rows)

    return numbers.mapInArrow(find, RESULT)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The pairs of a document and a benchmark item that it holds, with the region's words."""
    spark = documents.sparkSession
    ship_package(spark)
    result = spark.createDataFrame([], RESULT)
    for block in _blocks(benchmark):
        size = len(block.index)
        if not size:
            continue
        numbers = store(_numbers(documents, block), "numbers")
        df, n = _document_frequency(numbers, size)
        weight = np.where(df <= max(MAX_SHARE * n, 2), np.log((n + 1) / (df + 1)), 0.0)
        latent, exact = _split(block, weight)
        if latent.words:
            result = result.unionByName(store(_search(numbers, latent, weight, _latent(numbers, block, weight), df), "leaks"))
        if exact.words:
            result = result.unionByName(store(_search_exactly(numbers, exact, size), "leaks"))
        discard(numbers)  # a block's copy of the corpus goes before the next one's is made
    return result


def op5(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, cosine, lcs_share, answer_share, start_word, end_word."""
    return find_leaks(documents, benchmark)
