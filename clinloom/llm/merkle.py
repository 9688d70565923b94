"""Merkle dataset manifest: an append log of nodes in postorder, and proofs addressed by closed-form positions.

Rows become leaves (``leaf_digest``). The leaves of each tree (a source, say) get their place by one range
partitioned sort and prefix sums of its partitions' counts. Aligned builders then take runs of
``WIDTH ** levels`` leaves: a builder streams its leaves in order and appends each node the moment its last
child is there, so its nodes are one run of the tree's postorder log. The runs' top nodes are the leaves of the
next round, until a tree has one node. The subroots are the leaves of one more tree by the same code.

Nothing but digests is needed to find a sibling: ``position`` gives the place of node (level, index) in the log
of a tree from the sizes of the subtrees before it. Proofs go down again: each round joins a run's nodes with the
steps above the run, a few hundred bytes a level, and hands every child its own steps. A tree with a third
of all rows is many runs, dealt by (tree, run); no task holds more than one run, and nothing is collected.

Nulls and edge cases: a null field counts as ``-``; a null tree name is a tree of its own, before the others;
rows of one doc_id stand in the order of their digests, null doc_ids first, and equal rows are leaves each; an empty text
differs from none; a tree of one leaf has the leaf as its subroot; columns besides those named are not
read, whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import crc32_mod
from clinloom.session import ship_package, store

WIDTH = 16
#: A builder's run holds WIDTH ** LEVELS leaves, 4,096.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*fields: Column) -> Column:
    """Binary SHA-256 of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_digest(children: bytes) -> bytes:
    """The digest of a run of children, given as their joined binary digests."""
    return sha256(children.hex().encode()).digest()


# ---- a tree's shape


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    h = 0
    while leaves > WIDTH**h:
        h += 1
    return h


def width(level: int, leaves: int) -> int:
    return -(-leaves // WIDTH**level)


def position(level: int, index: int, leaves: int, top: int) -> int:
    """Place of a node in the postorder log of a tree of ``leaves`` leaves and ``top`` levels above them: what is
    complete by then is every node at or below its level up to its last leaf, and above it those that end before it."""
    first, end = index * WIDTH**level, min((index + 1) * WIDTH**level, leaves)
    below = sum(-(-end // WIDTH**j) for j in range(level + 1))
    above = sum(first // WIDTH**j for j in range(level + 1, top + 1))
    return below + above - 1


def append_log(leaves: list[bytes], top: int) -> list[bytes]:
    """All nodes over ``leaves`` in the order of their completion; ``top`` levels, the last runs shorter."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(top + 1)]

    def append(level, digest):
        log.append(digest)
        if level < top:
            runs[level].append(digest)
            if len(runs[level]) == WIDTH:
                close(level)

    def close(level):
        children = b"".join(runs[level])
        runs[level] = []
        append(level + 1, node_digest(children))

    for leaf in leaves:
        append(0, leaf)
    for level in range(top):
        if runs[level]:
            close(level)
    return log


def stepper(log: bytes, leaves: int, top: int) -> Callable[[int], list[dict]]:
    """From a leaf's index to its steps: per level, how many siblings stand left of it, and all of them."""

    @cache
    def run(level: int, at: int) -> bytes:
        last = min((at + 1) * WIDTH, width(level, leaves))
        places = (position(level, i, leaves, top) for i in range(at * WIDTH, last))
        return b"".join(log[32 * p : 32 * p + 32] for p in places)

    def steps(index: int) -> list[dict]:
        out = []
        for level in range(top):
            at, left = divmod(index, WIDTH)
            all_of = run(level, at)
            out.append({"left": left, "others": all_of[: 32 * left] + all_of[32 * left + 32 :]})
            index = at
        return out

    return steps


def fold(leaf: bytes, steps: list[dict]) -> bytes:
    """The root that ``leaf`` and its siblings give."""
    for step in steps:
        cut = 32 * step["left"]
        leaf = node_digest(step["others"][:cut] + leaf + step["others"][cut:])
    return leaf


# ---- places of leaves

_PLACED = "tree string, n long, idx long"
STEPS = "array<struct<left: int, others: binary>>"


def _named(tree: Column) -> Column:
    """A tree's name that is never null and sorts as the names do bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))


def place(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (tree, digest, others) with ``n``, their tree's size, and ``idx``, their place in it by ``order``,
    ties by digest. The partitions' counts, a row for each partition and tree in it, are summed by windows."""
    given = store(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-rows")
    keys = ["tree", *order, "digest", "_tie"]  # equal rows are told apart, so that many of them are dealt out
    parts = max(1, int(given.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = given.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = store(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), f"{name}-sorted")
    counts = dealt.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    all_of = Window.partitionBy("tree")
    before = all_of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "_part", "_first", F.sum("_n").over(all_of).alias("n"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    idx = (F.col("_at") - F.col("_first") + F.col("_base")).alias("idx")
    kept = [c for c in rows.columns if c != "tree"]
    return dealt.join(store(counts, f"{name}-counts"), ["tree", "_part"]).select("tree", "n", idx, *kept)


# ---- builders


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of equal (tree, run), which come together and in order."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["run"]) != key:
                if rows:
                    yield rows
                key, rows = (row["tree"], row["run"]), []
            rows.append(row)
    if rows:
        yield rows


def _levels_of(n: int, levels: int) -> int:
    """Levels that a builder adds in a tree of ``n``: all there are, or as many as a run has."""
    return height(n) if n <= WIDTH**levels else levels


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "run").sortWithinPartitions("tree", "run", *order)


def grow(placed: DataFrame, levels: int) -> DataFrame:
    """One round: (tree, n, run, start, leaves, log, top) for each aligned run of ``placed`` (tree, n, idx, digest):
    its nodes in completion order as one binary, the place of the first of them in the log of this round's
    tree, and the last one, which stands for the run in the next round."""
    ship_package(placed.sparkSession)
    size = WIDTH**levels
    rows = placed.select("tree", "n", F.floor(F.col("idx") / size).alias("run"), "idx", "digest")

    def build(batches):
        for run in _runs(batches):
            n, first = run[0]["n"], run[0]["idx"]
            log = append_log([r["digest"] for r in run], _levels_of(n, levels))
            start = position(0, first, n, height(n))
            yield pa.RecordBatch.from_pylist([{"tree": run[0]["tree"], "n": n, "run": run[0]["run"], "start": start, "leaves": len(run), "log": b"".join(log), "top": log[-1]}], schema=schema)

    schema = pa.schema({"tree": pa.string(), "n": pa.int64(), "run": pa.int64(), "start": pa.int64(), "leaves": pa.int64(), "log": pa.binary(), "top": pa.binary()})
    return _dealt(rows, "idx").mapInArrow(build, "tree string, n long, run long, start long, leaves long, log binary, top binary")


@dataclass(frozen=True)
class Forest:
    """The rounds of all trees: ``rounds[k]`` holds runs of ``levels`` levels over the tops of round k - 1."""

    placed: DataFrame
    rounds: list[DataFrame]
    levels: int

    @property
    def subroots(self) -> DataFrame:
        """(tree, n, digest): the one node that remains of each tree, ``n`` being its leaves."""
        done = [r.where(F.col("n") <= WIDTH**self.levels).select("tree", F.col("top").alias("digest")) for r in self.rounds]
        all_of = done[0]
        for more in done[1:]:
            all_of = all_of.unionByName(more)
        return all_of


def build(placed: DataFrame, levels: int = LEVELS, name: str = "log") -> Forest:
    """Rounds until every tree has one node; each is written before the next one reads it."""
    rounds, rows = [], placed
    while True:
        rounds.append(store(grow(rows, levels), f"{name}-{len(rounds)}"))
        more = rounds[-1].where(F.col("n") > WIDTH**levels)
        if more.isEmpty():
            return Forest(placed, rounds, levels)
        rows = more.select("tree", F.ceil(F.col("n") / WIDTH**levels).cast("long").alias("n"), F.col("run").alias("idx"), F.col("top").alias("digest"))


def hand_down(children: DataFrame, runs: DataFrame, above: DataFrame, levels: int, give: Callable[[list[dict], Iterator[tuple[int, list[dict]]]], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``give`` makes of the children of each run and their steps to the end of the tree. ``runs`` is a
    round, ``above`` (tree, run, steps) has the steps of the runs' tops; children are (tree, idx, others)."""
    size = WIDTH**levels
    heads = runs.select("tree", "run", "n", "leaves", "log").join(above, ["tree", "run"])
    below = children.withColumn("run", F.floor(F.col("idx") / size))
    # one stream of rows: a run's head comes before its children
    both = heads.withColumn("idx", F.lit(-1).cast("long")).unionByName(below.drop("n"), allowMissingColumns=True)

    def run(batches):
        for head, *rows in _runs(batches):
            steps = stepper(head["log"], head["leaves"], _levels_of(head["n"], levels))
            yield from give(rows, ((steps(r["idx"] % size) + head["steps"]) for r in rows))

    return _dealt(both, "idx").mapInArrow(run, schema)


def steps_of_runs(forest: Forest, last: DataFrame) -> DataFrame:
    """(tree, run, steps) for the runs of the first round; ``last`` (tree, steps) has the steps of the subroots."""
    schema = pa.schema({"tree": pa.string(), "run": pa.int64(), "steps": pa.list_(pa.struct({"left": pa.int32(), "others": pa.binary()}))})

    def give(rows, steps):
        yield pa.RecordBatch.from_pylist([{"tree": r["tree"], "run": r["idx"], "steps": s} for r, s in zip(rows, steps, strict=True)], schema=schema)

    above = None
    for k in range(len(forest.rounds) - 1, -1, -1):
        whole = forest.rounds[k].where(F.col("n") <= WIDTH**forest.levels).select("tree", "run").join(last, "tree")
        if above is not None:
            upper = forest.rounds[k + 1]
            tops = forest.rounds[k].where(F.col("n") > WIDTH**forest.levels).select("tree", F.col("run").alias("idx"))
            whole = whole.unionByName(hand_down(tops, upper, above, forest.levels, give, f"tree string, run long, steps {STEPS}"))
        above = store(whole, f"steps-{k}")
    return above


# ---- the manifest


@dataclass(frozen=True)
class Manifest:
    """``trees`` over the rows and ``top`` over their subroots, whose own one subroot is the root."""

    trees: Forest
    top: Forest

    @property
    def root(self) -> DataFrame:
        """One row (digest), none for an empty table."""
        return self.top.subroots.select("digest")


def manifest(rows: DataFrame, order: list[str], levels: int = LEVELS) -> Manifest:
    """The trees of ``rows`` (tree, digest, columns of ``order``, others), tree being a name or null."""
    named = rows.withColumn("tree", _named(F.col("tree")))
    trees = build(store(place(named, order, "leaves"), "placed"), levels, "log")
    tops = trees.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(trees, build(store(place(tops, ["name"], "subroots"), "placed-top"), levels, "log-top"))


def proofs(made: Manifest, give: Callable, schema: str) -> DataFrame:
    """What ``give(rows, steps)`` yields as Arrow batches, for rows of ``made.trees.placed`` run by run and the
    steps of each, up to the root."""
    top = steps_of_runs(made.top, made.top.subroots.select("tree", F.array().cast(STEPS).alias("steps")))
    named = pa.schema({"tree": pa.string(), "steps": pa.list_(pa.struct({"left": pa.int32(), "others": pa.binary()}))})

    def subroot_steps(rows, steps):
        yield pa.RecordBatch.from_pylist([{"tree": r["name"], "steps": s} for r, s in zip(rows, steps, strict=True)], schema=named)

    tops = made.top.placed.drop("digest")
    last = store(hand_down(tops, made.top.rounds[0], top, made.top.levels, subroot_steps, f"tree string, steps {STEPS}"), "steps-top")
    return hand_down(made.trees.placed, made.trees.rounds[0], steps_of_runs(made.trees, last), made.trees.levels, give, schema)


def op13(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per document its leaf, its source's subroot, the root, a digest of its proof, and whether the leaf, tampered
    with where 5 divides the id's crc32, still folds to the root."""
    text = F.col("text").cast("string")
    fields = {f: F.col(f) for f in FIELDS}
    tampered = F.when(crc32_mod(F.col("doc_id"), 5) == 0, leaf_digest(*(fields | {"text": F.translate(text, _UPPER, _LOWER)}).values()))
    rows = documents.select(F.col("source").cast("string").alias("tree"), "doc_id", leaf_digest(*fields.values()).alias("digest"), tampered.alias("seen"))
    made = manifest(rows, ["doc_id"], levels)
    kinds = {"tree": pa.string(), "doc_id": pa.int64(), "leaf": pa.string(), "proof_sha256": pa.string(), "folded_root": pa.string()}
    schema = pa.schema(kinds)

    def give(rows, steps):
        out = []
        for r, s in zip(rows, steps, strict=True):
            proof = sha256(b"".join(x["others"] for x in s).hex().encode()).hexdigest()
            out.append((r["tree"], r["doc_id"], r["digest"].hex(), proof, fold(r["seen"] or r["digest"], s).hex()))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    found = proofs(made, give, "tree string, doc_id long, leaf string, proof_sha256 string, folded_root string")
    subroots = store(made.trees.subroots.select("tree", F.lower(F.hex("digest")).alias("subroot")), "subroots")
    root = F.lower(F.hex("digest")).alias("root")
    whole = found.join(subroots, "tree").crossJoin(F.broadcast(made.root.select(root)))  # the root is one row
    return whole.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
