"""The manifest against trees built in the plainest way."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from clinloom.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def H(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, low=False):
    doc_id, text, lang, source, n = row
    if low and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def climb(nodes):
    """The root and each leaf's siblings, left and right, level by level."""
    paths, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        starts = range(0, len(nodes), 16)
        for a in starts:
            run = nodes[a : a + 16]
            for k in range(len(run)):
                for i in owner[a + k]:
                    paths[i].append((run[:k], run[k + 1 :]))
        nodes, owner = [H("".join(nodes[a : a + 16])) for a in starts], [sum(owner[a : a + 16], []) for a in starts]
    return nodes[0], paths


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[3]].append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for rows in trees.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    built = [climb([leaf(r) for r in trees[s]]) for s in names]
    root, tops = climb([b[0] for b in built])
    for s, (subroot, paths), top in zip(names, built, tops):
        for row, path in zip(trees[s], paths):
            path = path + top
            x = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for a, b in path:
                x = H("".join(a) + x + "".join(b))
            proof = H("".join("".join(a + b) for a, b in path))
            yield row[0], leaf(row), subroot, root, proof, x, x == root


def rows_of(sizes, seed):
    r, out = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            text = r.choice([None, "", "Abc É X", " hello World", "x" * 3000 + "Y"])
            out.append((len(out), text, r.choice([None, "en"]), source, r.choice([None, 3])))
    out += [out[0]] * 3 + [(None, "X", "en", "a", 1)]  # repeated rows, a row without doc_id
    r.shuffle(out)
    return out


@pytest.mark.parametrize("levels,more", [(1, 0), (1, 40), (2, 0), (3, 0)])
def test_same_as_plain_trees(spark, levels, more):
    sizes = {None: 5, "": 1, "a": 17, "b": 16, "c": 1, "d": 257, "é": 300, "z": 520} | {f"s{k}": k % 19 + 1 for k in range(more)}
    rows = rows_of(sizes, levels)
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], COLUMNS + ", root int, digest int")  # clashing names
    got = merkle.op13(df, levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_empty_and_single(spark):
    assert merkle.op13(spark.createDataFrame([], COLUMNS)).collect() == []
    one = [(1, None, None, None, None)]
    (row,) = merkle.op13(spark.createDataFrame(one, COLUMNS)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf(one[0]) and row.proof_sha256 == H("")


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 256, 257, 300, 4097])
def test_positions_are_the_order_of_completion(leaves):
    top = merkle.height(leaves)
    digests = [sha256(str(i).encode()).digest() for i in range(leaves)]
    log = merkle.append_log(digests, top)
    seen, nodes = {}, digests
    for level in range(top + 1):
        for i, d in enumerate(nodes):
            seen[merkle.position(level, i, leaves, top)] = d
        nodes = [merkle.node_digest(b"".join(nodes[a : a + 16])) for a in range(0, len(nodes), 16)]
    assert [seen[p] for p in range(len(seen))] == log


def test_runs_are_stretches_of_the_log(spark):
    """The builders' logs, each put at its start, make up the log of the whole tree but for the nodes above runs."""
    rows = spark.range(300).selectExpr("'' tree", "id k", "unhex(sha2(string(id), 256)) digest")
    made = merkle.build(merkle.place(rows, ["k"], "t"), 1)
    leaves = [sha256(str(i).encode()).digest() for i in range(300)]
    whole = merkle.append_log(leaves, merkle.height(300))
    for run in made.rounds[0].collect():
        log = [bytes(run.log[i : i + 32]) for i in range(0, len(run.log), 32)]
        assert whole[run.start : run.start + len(log)] == log
    assert bytes(made.subroots.first().digest) == whole[-1]
