"""Ranked lexical search by two trees: the best documents of each item, exactly.

A document's term has an impact, an item's term a weight, and a score sums weight times impact over the item's terms.
Items stand in a tree whose nodes hold each term that any item below has; each batch of documents in a task
stands in a tree whose nodes hold each term's greatest impact below. As all terms of the sum are at least 0, weight times
greatest impact, summed over a node's terms, bounds the score of every pair below the two nodes. A pair of nodes
whose bound is under the weakest k-th score of the node's items goes with all that is below it; no other goes, so the
result is exact. Both trees are walked down together; documents with like strongest terms are neighbours.

In Spark: one pass turns whole texts into the terms that items have (a stored table), sums give the corpus's statistics.
A sixty-fourth of the documents, by hash, is searched first, for k-th scores that the search of all documents
starts from; they steer how much is pruned, never what is found. Each task returns at most k rows an item; a
window takes the best of them. Items come in blocks of about ``BLOCK_TERMS`` terms, of which one at a time is
sent to the tasks, so what is broadcast does not grow with the documents or the items; each block reads all documents.

Nulls and edge cases: a null or empty text has no term, is not counted and never found, as item it has no rows; equal
items (id and text) are one, several texts of one item_id are ranked each for themselves; repeated documents are
ranked each, those without doc_id after others of their score; ties go by doc_id; a very long text is counted whole;
columns besides id and text are not read; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import give_back, rows_in_slices
from clinloom.session import ship_package, store

#: Terms of items, counted once an item, that one block holds, about; an item is never split.
BLOCK_TERMS = 400_000
#: Children of a node, documents of a batch (fewer where they hold more than so many terms), and the share of
#: documents that are searched first: one of so many.
FAN, BATCH_ROWS, BATCH_TERMS, SEED_SHARE = 8, 1_024, 2_000_000, 64
#: A term is a stretch of ASCII letters, digits and whatever is not ASCII; only A-Z are folded.
_FOLD = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def impact(tf, n, documents: int, total: int):
    """Of a term that a document of ``n`` terms has ``tf`` times; integers or integer arrays."""
    m = 100 - 90 + (90 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# ---- trees


@dataclass(frozen=True)
class Level:
    """Nodes of one depth: node i has the entries ptr[i] to ptr[i + 1] of ``term``, and of ``most`` beside it."""

    ptr: np.ndarray
    term: np.ndarray
    most: np.ndarray

    @property
    def size(self) -> int:
        return len(self.ptr) - 1

    def entries(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all entries of ``nodes``, one node after the other, and where each node's begin."""
        length = self.ptr[nodes + 1] - self.ptr[nodes]
        starts = np.concatenate([[0], np.cumsum(length)[:-1]])
        return np.arange(length.sum()) + np.repeat(self.ptr[nodes] - starts, length), starts


def level_of(owner: np.ndarray, term: np.ndarray, most: np.ndarray, nodes: int) -> Level:
    """A level from entries in any order; of one term of a node the greatest counts."""
    order = np.lexsort((term, owner))
    owner, term, most = owner[order], term[order], most[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    most = np.maximum.reduceat(most, at) if len(at) else most
    return Level(np.searchsorted(owner[at], np.arange(nodes + 1)), term[at], most)


def tree(owner: np.ndarray, term: np.ndarray, most: np.ndarray, nodes: int) -> list[Level]:
    """Levels from the leaves up to one node, each of ``FAN`` neighbours below."""
    levels = [level_of(owner, term, most, nodes)]
    while levels[-1].size > 1:
        low = levels[-1]
        owner = np.repeat(np.arange(low.size), np.diff(low.ptr)) // FAN
        levels.append(level_of(owner, low.term, low.most, -(-low.size // FAN)))
    return levels


def like_order(owner: np.ndarray, term: np.ndarray, worth: np.ndarray, nodes: int) -> np.ndarray:
    """An order of the leaves in which those of the same strongest terms are neighbours."""
    order = np.lexsort((term, -worth, owner))
    first = np.searchsorted(owner[order], np.arange(nodes + 1))
    keys = []
    for k in (2, 1, 0):
        at = first[:-1] + k
        has = at < first[1:]
        keys.append(np.where(has, term[order][np.where(has, at, 0)], -1) if len(order) else np.full(nodes, -1))
    return np.lexsort(keys)


@dataclass(frozen=True)
class Items:
    """A block of items as a tree; ``keys`` are the items in the tree's order, ``weights`` those of the block's terms."""

    keys: list[int]
    levels: list[Level]
    weights: np.ndarray


def plant_items(found: list[tuple[int, list[int]]], weights: np.ndarray) -> Items:
    """From (key, distinct terms) of each item; items whose terms all weigh nothing are never found and left out."""
    found = [(k, t) for k, t in ((k, [x for x in t if weights[x] > 0]) for k, t in found) if t]
    owner = np.repeat(np.arange(len(found)), [len(t) for _, t in found]).astype(np.int64)
    term = np.array([x for _, t in found for x in t], np.int64)
    order = like_order(owner, term, weights[term], len(found))
    place = np.empty(len(found), np.int64)
    place[order] = np.arange(len(found))
    return Items([found[i][0] for i in order], tree(place[owner], term, weights[term], len(found)) if found else [], weights)


class Search:
    """The walk over one batch of documents after the other, with the k best of each item so far."""

    def __init__(self, items: Items, k: int, floors: np.ndarray | None = None):
        self.items, self.k = items, k
        self.best: list[list[tuple]] = [[] for _ in items.keys]
        #: of each level of items, the least score that may still enter below a node
        self.least = [np.ones(len(items.keys), np.int64) if floors is None else np.maximum(floors, 1)]
        while len(self.least[-1]) > 1:
            self.least.append(np.minimum.reduceat(self.least[-1], np.arange(0, len(self.least[-1]), FAN)))
        self.scratch = np.zeros((FAN, len(items.weights)), np.int64)
        self.pairs = self.pruned = 0

    def add(self, ids: list, owner: np.ndarray, term: np.ndarray, impacts: np.ndarray) -> None:
        """Documents ``ids`` with the impacts of their terms, which the block has."""
        if not self.items.keys or not len(term):
            return
        order = like_order(owner, term, impacts * self.items.weights[term], len(ids))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        docs = tree(place[owner], term, impacts, len(ids))
        top = len(self.items.levels) - 1
        todo = [(len(docs) - 1, 0, 1, top, np.zeros(1, np.int64))]
        while todo:
            depth, first, count, level, nodes = todo.pop()
            bound = self.bounds(docs[depth], first, count, level, nodes)
            stays = bound >= self.least[level][nodes][:, None]
            self.pairs += bound.size
            self.pruned += bound.size - int(stays.sum())
            if depth == level == 0:
                for i, d in zip(*np.nonzero(stays), strict=True):
                    self.enter(int(nodes[i]), int(bound[i, d]), ids[order[first + d]])
                continue
            for d in range(count):
                left = nodes[stays[:, d]]
                if not len(left):
                    continue
                below = max(level - 1, 0)
                if level:
                    left = (left[:, None] * FAN + np.arange(FAN)).ravel()
                    left = left[left < self.items.levels[below].size]
                if depth:
                    start = (first + d) * FAN
                    todo.append((depth - 1, start, min(FAN, docs[depth - 1].size - start), below, left))
                else:
                    todo.append((0, first + d, 1, below, left))

    def bounds(self, docs: Level, first: int, count: int, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of items by ``count`` nodes of documents from ``first``."""
        for d in range(count):
            a, b = docs.ptr[first + d], docs.ptr[first + d + 1]
            self.scratch[d, docs.term[a:b]] = docs.most[a:b]
        items = self.items.levels[level]
        at, starts = items.entries(nodes)
        out = np.add.reduceat(self.scratch[:count, items.term[at]] * items.most[at], starts, axis=1).T
        for d in range(count):
            a, b = docs.ptr[first + d], docs.ptr[first + d + 1]
            self.scratch[d, docs.term[a:b]] = 0
        return out

    def enter(self, item: int, score: int, doc_id: int | None) -> None:
        best, entry = self.best[item], (score, doc_id is not None, -(doc_id or 0))
        if len(best) < self.k:
            heapq.heappush(best, entry)
        else:
            heapq.heappushpop(best, entry)
        if len(best) == self.k and best[0][0] > self.least[0][item]:
            self.least[0][item] = best[0][0]
            for low, up in zip(self.least, self.least[1:]):
                item //= FAN
                up[item] = low[item * FAN : (item + 1) * FAN].min()

    def found(self) -> Iterator[tuple[int, int | None, int]]:
        for key, best in zip(self.items.keys, self.best, strict=True):
            for score, named, minus in best:
                yield key, -minus if named else None, score


# ---- Spark


def item_blocks(items: DataFrame) -> Iterator[tuple[list[tuple[int, list[int]]], dict[bytes, int], DataFrame]]:
    """Per block (key, distinct terms) of its items, the numbers of its terms, and its rows (item, item_id)."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    rows = store(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // (6 * BLOCK_TERMS))  # a term has some six bytes
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        index: dict[bytes, int] = {}
        found = []
        for row in block.select("item", "text").toLocalIterator():
            found.append((row.item, [index.setdefault(t, len(index)) for t in dict.fromkeys(terms(row.text.encode()))]))
        yield found, index, block.select("item", "item_id")


def vectors(documents: DataFrame, index: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: all its terms counted, and those that ``index`` numbers."""
    ship_package(documents.sparkSession)
    schema = pa.schema({"doc_id": pa.int64(), "n": pa.int64(), "terms": pa.list_(pa.int32()), "counts": pa.list_(pa.int32())})

    def run(batches):
        of = index.get
        for part in rows_in_slices(batches):
            n, ends, all_terms, all_counts = [], [0], [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                words = terms(text)
                n.append(len(words))
                count = Counter(map(of, words))
                count.pop(None, None)
                all_terms.extend(count)
                all_counts.extend(count.values())
                ends.append(len(all_terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (all_terms, all_counts)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], schema=schema)
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in rows_in_slices(parts, BATCH_ROWS):
        ends = part.column(2).offsets.to_numpy()
        start = 0
        while start < part.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + BATCH_TERMS, "right")) - 1)
            yield part.slice(start, stop - start)
            start = stop


def best_of(found: DataFrame, items: Items, k: int, documents: int, total: int, floors: np.ndarray | None = None) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item, of those that reach the item's floor."""
    schema = pa.schema({"item": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()})

    def run(parts):
        search = Search(items, k, floors)
        for part in _batches(parts):
            lists, counts = part.column(2), part.column(3)
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            tf, n = counts.flatten().to_numpy().astype(np.int64), part.column(1).to_numpy()
            term = lists.flatten().to_numpy().astype(np.int64)
            search.add(part.column(0).to_pylist(), owner, term, impact(tf, n[owner], documents, total))
        rows = list(search.found())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
        give_back()

    return found.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item (item_id, text) the ``k`` best of ``documents`` (doc_id, text)."""
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for found, index, names in item_blocks(items):
        docs = store(vectors(documents, index), "vectors")
        n, total = docs.agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.full(len(index), weight(0, n), np.int64)
        # at most a row for each of the block's terms
        for row in docs.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            weights[row.term] = weight(row["count"], n)
        planted = plant_items(found, weights)
        if not planted.keys or not total:
            continue
        first = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEED_SHARE)) == 0)
        seeds = ranked(best_of(first, planted, k, n, total), k).where(F.col("rank") == k)
        known = {r.item: r.score for r in seeds.toLocalIterator()}
        floors = np.array([known.get(key, 0) for key in planted.keys], np.int64)
        best = ranked(best_of(docs, planted, k, n, total, floors), k)
        best = store(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        out = out.unionByName(best)
    return out


def op12(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(documents, benchmark, 10)


#: DuckDB, by counting every term of every document.
ORACLE = r"""
with d as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
q as (
  select distinct item_id, term from (select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)),
f as (select doc_id, term, count(*) as tf from d group by all),
s as (select doc_id, count(*) as n from d group by all),
c as (select count(*) as docs, sum(n)::bigint as total from s),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from f, c group by term, docs),
r as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::bigint as score
  from q join f using (term) join w using (term) join s using (doc_id), c group by all)
select item_id, rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from r where score > 0)
where rank <= 10
"""
