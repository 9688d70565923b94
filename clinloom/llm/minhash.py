"""MinHash near-duplicate groups with odd sketches.

1. A task hashes the distinct five-word shingles of each text, takes ``BANDS * ROWS`` MinHash values,
   and folds the numbered values into a parity bitmap (odd sketch) of 256 bits. The whole set is folded
   into a second parity bitmap, of 512 bits: the population count of two sets' XOR there is never above
   the size of their symmetric difference, so it rules pairs out without error.
2. Texts with equal shingle sets form one class (a grouped minimum). Only classes go on.
3. Bands put classes into buckets. Two classes of a bucket are compared by size and by both XOR counts;
   the first estimates similarities near one precisely, whatever the sets' sizes. What may reach the
   threshold is confirmed on the full sets, which are made once, of the classes that share a bucket.
4. Each class first meets one class of each of its buckets, and the nearest of those by the bitmaps is
   confirmed. These links give provisional groups, which some turns of delegates, one of a group in a
   bucket against one of the bucket's largest group, join further. Then, in each bucket, every class outside the bucket's
   largest group meets all classes of other groups, the nearest pairs are confirmed first, and of the
   others those that are still in different groups. So all pairs of a bucket are settled, by a link,
   by a common group or by a comparison, while the members of a large group of near copies are not
   compared with one another. A large bucket is dealt out over many partitions by a hash of the class.
5. Connected components of the links give component_id.

With 32 bands of 4 rows a pair of similarity 0.75 shares no band with probability 5e-6. A sketch of
128 values estimates 0.75 with a standard deviation of 0.04; pairs estimated below 0.52 are dropped.

Nulls and edge cases: a null, empty or blank text has no shingles, n_shingles 0 and links with nothing;
fewer than five words form one shingle; rows that share a doc_id are one node, which has the links of
each of its texts; a row without doc_id links with nothing, has a null component_id and is kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import Memory, add_columns
from clinloom.llm.components import connected_components
from clinloom.session import store

WIDTH = 5
BANDS, ROWS = 32, 4
SKETCH_WORDS = 4  # of 64 bits, of the MinHash values' bitmap
PARITY_WORDS = 8  # of the whole set's
#: Least estimated similarity that is confirmed on full sets, for a threshold of 0.75.
ESTIMATE_FLOOR = 0.52
#: Most turns of joining groups by delegates; whatever they leave apart is settled after them.
TURNS = 2
#: Classes of a bucket that share a partition of the second step.
CHUNK = 256
#: Bits of the bitmap by which rows that are not asked for are dropped where they are read.
MARKS = 1 << 23
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # bytes.split() cuts at \x20 and \x09-\x0D, no more
    found = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(width, len(h))
    with np.errstate(over="ignore"):
        total = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            total = _mix(total + h[k : len(h) - n + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(total)


_SALTS = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = _mix(_SALTS) | np.uint64(1)


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(_SALTS)), np.uint64)
    with np.errstate(over="ignore"):
        for k, (salt, odd) in enumerate(zip(_SALTS, _ODD, strict=True)):
            out[:, k] = np.minimum.reduceat((flat ^ salt) * odd, starts)
    return out


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows of 64-bit words): each numbered value flips one bit."""
    bits = 64 * SKETCH_WORDS
    with np.errstate(over="ignore"):
        at = (_mix(values + _SALTS[None, :]) >> np.uint64(40)).astype(np.int64) % bits
    rows = np.repeat(np.arange(len(values)), values.shape[1])
    parity = np.bincount(rows * bits + at.ravel(), minlength=len(values) * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(values), bits), axis=1).view(">i8").astype(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set, as 64-bit words."""
    bits = 64 * PARITY_WORDS
    flips = np.bincount((_mix(hashes) >> np.uint64(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(">i8").astype(np.int64)


def band_hashes(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(values), BANDS)).copy()
        for k in range(ROWS):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + values[:, k::ROWS])
    return out.view(np.int64)


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the set), sketch (both bitmaps) and bands; null where
    empty."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make():
        words = Memory(xxhash.xxh3_64_intdigest)

        def work(part):
            sets = [shingle_hashes(t, words) for t in part.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            sketch, bands, keys = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for at in range(0, len(full), 64):
                some = full[at : at + 64]
                values = min_hashes([sets[i] for i in some])
                for i, s, b in zip(some, odd_sketch(values), band_hashes(values), strict=True):
                    sketch[i], bands[i] = s.tolist() + parity(sets[i]).tolist(), b
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            return [pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sketch, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))]

        return work

    return add_columns(docs, "n_shingles long, set_key binary, sketch array<long>, bands array<long>", make).drop("text")


def _differ(a: str, b: str, words: range):
    return sum(F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in words)


def _estimate(a: str, b: str):
    """Similarity of two classes' sets from their sketches; -1 where the sketches differ in half of the
    bits or more."""
    bits, samples = 64 * SKETCH_WORDS, BANDS * ROWS
    inside = 1 - 2 * _differ(a, b, range(SKETCH_WORDS)) / F.lit(float(bits))
    return F.when(inside > 0, 1 + F.log(inside) * F.lit(bits / (4.0 * samples))).otherwise(-1.0)


def _distance(a: str, b: str):
    """Least size of the symmetric difference, by both sizes together."""
    return _differ(a, b, range(SKETCH_WORDS, SKETCH_WORDS + PARITY_WORDS)) / (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles"))


def _possible(a: str, b: str):
    """Sizes allow 100 * common >= 75 * union, which is a symmetric difference of at most a seventh of
    both sizes, and so do both bitmaps."""
    small = F.least(f"{a}.n_shingles", f"{b}.n_shingles")
    large = F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    apart = 7 * _differ(a, b, range(SKETCH_WORDS, SKETCH_WORDS + PARITY_WORDS)) <= small + large
    return (100 * small >= 75 * large) & apart & (_estimate(a, b) >= ESTIMATE_FLOOR)


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is among ``ids`` (doc_id, a stored table of distinct ids). A bitmap of the ids' hashes, of ``MARKS`` bits whatever
    their number, goes to every task and drops most other rows before any is sent; the join settles what it lets through."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    word, bit = F.shiftright(at, 6).alias("_word"), at.bitwiseAND(F.lit(63)).cast("int").alias("_bit")
    marks = ids.select(word, bit).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_mask"))
    met = rows.select("*", word, bit).join(F.broadcast(marks), "_word").where(F.bit_get("_mask", "_bit") == 1)
    # an inner join, as a semi-join would be moved below the bitmap
    return met.select(*rows.columns).join(ids, "doc_id")


def full_sets(reps: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, hashes): the whole sets of the documents ``reps`` (doc_id), sent and hashed once for all comparisons."""
    docs = _among(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), reps)

    def make():
        words = Memory(xxhash.xxh3_64_intdigest)

        def work(part):
            found = [shingle_hashes(t, words).view(np.int64) for t in part.column(1).to_pylist()]
            return [pa.array(found, pa.list_(pa.int64()))]

        return work

    return store(add_columns(docs, "hashes array<long>", make).select("doc_id", "hashes").where("size(hashes) > 0"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (u, v: doc_id) whose full sets link."""
    wanted = store(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "wanted")
    sets = _among(sets, wanted)
    left = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("hashes").alias("hu")), "u")
    both = left.join(sets.select(F.col("doc_id").alias("v"), F.col("hashes").alias("hv")), "v")
    common = F.size(F.array_intersect("hu", "hv"))
    return both.where(100 * common >= 75 * (F.size("hu") + F.size("hv") - common)).select("u", "v")


def _groups(shared: DataFrame, label_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, n, rep, label) with each class's group, its own where it has none, and (bucket, main) with
    the largest group of each bucket that has several."""
    labelled = shared.select("bucket", "n", "rep").join(label_of, "rep", "left")
    labelled = store(labelled.select("bucket", "n", "rep", F.coalesce("label", "rep").alias("label")), "labelled")
    sizes = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "label")).alias("top"), F.count(F.lit(1)).alias("groups"))
    return labelled, store(main.where("groups > 1").select("bucket", F.col("top.label").alias("main")), "main")


def _lower(joined: DataFrame, name: str) -> DataFrame:
    """(label, to): groups that links join (x, y: labels) under smaller labels. Each label takes its least
    neighbour, and eight steps along those; longer chains stay apart here and are joined at the end."""
    both = joined.select(F.greatest("x", "y").alias("label"), F.least("x", "y").alias("to")).where("label <> to")
    least = store(both.groupBy("label").agg(F.min("to").alias("to")), name)
    out = least
    for _ in range(3):
        further = out.select(F.col("label").alias("to"), F.col("to").alias("next"))
        out = out.join(further, "to", "left").select("label", F.coalesce("next", "to").alias("to"))
    return store(out, name)


def _moved(label_of: DataFrame, moves: DataFrame) -> DataFrame:
    """``label_of`` with the groups of ``moves`` (label, to) under their new labels; a class alone has its
    own label and moves too."""
    known = label_of.join(moves, "label", "left").select("rep", F.coalesce("to", "label").alias("label"))
    alone = moves.join(label_of.select(F.col("rep").alias("label")), "label", "left_anti").select(F.col("label").alias("rep"), F.col("to").alias("label"))
    return store(known.unionByName(alone), "labels")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. See the module's text."""
    signed = store(signatures(documents), "signed")
    known = signed.where("set_key is not null and doc_id is not null")
    # classes: one per shingle set, named by its smallest doc_id
    classes = store(
        known.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    member = known.select("set_key", "doc_id").distinct().join(classes.select("set_key", "rep"), "set_key")
    member = store(member.select("doc_id", "rep"), "member")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    same_id = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))

    # buckets with two classes or more; the hub of a bucket is its least class by a hash that the band salts
    laid = classes.select("rep", F.explode("bands").alias("bucket"))
    hubs = store(
        laid.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("rep", "bucket").alias("h"), F.col("rep").alias("rep"))).alias("hub"))
        .where("n > 1")
        .select("bucket", "n", F.col("hub.rep").alias("hub")),
        "hubs",
    )
    words = range(SKETCH_WORDS + PARITY_WORDS)
    slim = classes.select("rep", "n_shingles", *[F.col("sketch")[k].alias(f"s{k}") for k in words])
    shared = store(laid.join(hubs, "bucket"), "buckets")
    # every pair is of classes that share a bucket
    sets = full_sets(store(shared.select(F.col("rep").alias("doc_id")).distinct(), "reps"), documents)
    a, b = slim.alias("a"), slim.alias("b")
    first = shared.where("rep <> hub").select("rep", "hub").distinct()
    first = first.alias("p").join(a, F.col("p.rep") == F.col("a.rep")).join(b, F.col("p.hub") == F.col("b.rep"))
    first = first.where(_possible("a", "b")).select(F.col("p.rep").alias("rep"), F.col("p.hub").alias("hub"), _distance("a", "b").alias("far"))
    first = first.groupBy("rep").agg(F.min(F.struct("far", "hub")).alias("best"))
    first = store(first.select(F.least("rep", "best.hub").alias("u"), F.greatest("rep", "best.hub").alias("v")).distinct(), "pairs")
    links = store(_confirmed(first, sets), "links").unionByName(same_id)

    # groups that share a bucket are joined by delegates, each to its nearest one, before all pairs are
    # settled; joining moves a group under another's label, which may be one step behind but never unites
    # what no link joins
    label_of = connected_components(links).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    label_of = store(label_of, "labels")
    tried = first
    for turn in range(TURNS):
        labelled, main = _groups(shared, label_of)
        pick = F.min(F.struct(F.xxhash64("rep", "bucket", F.lit(turn)).alias("h"), F.col("rep").alias("rep")))
        delegates = store(labelled.join(main, "bucket").groupBy("bucket", "label", "main").agg(pick["rep"].alias("rep")), "delegates")
        hosts = delegates.where("label = main").select("bucket", F.col("rep").alias("host"), F.col("label").alias("to"))
        ask = delegates.where("label <> main").select("bucket", "rep", "label").join(hosts, "bucket").select("rep", "host", "label", "to").distinct()
        ask = ask.alias("p").join(a, F.col("p.rep") == F.col("a.rep")).join(b, F.col("p.host") == F.col("b.rep")).where(_possible("a", "b"))
        ask = ask.select("p.label", "p.to", F.least("p.rep", "p.host").alias("u"), F.greatest("p.rep", "p.host").alias("v"), _distance("a", "b").alias("far"))
        ask = ask.join(tried, ["u", "v"], "left_anti").groupBy("label").agg(F.min(F.struct("far", "u", "v", "to")).alias("best"))
        ask = store(ask.select("label", "best.u", "best.v", "best.to"), "pairs")
        pairs = ask.select("u", "v").distinct()
        more = store(_confirmed(pairs, sets), "links")
        links, tried = links.unionByName(more), tried.unionByName(pairs)
        joined = ask.join(more, ["u", "v"], "left_semi").select(F.col("label").alias("x"), F.col("to").alias("y"))
        label_of = _moved(label_of, _lower(joined, "moves"))

    # what is still in different groups within a bucket
    labelled, main = _groups(shared, label_of)
    open_ = store(labelled.join(main, "bucket").join(slim, "rep"), "open")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    rows = open_.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks.cast("long")).cast("int")).alias("b")
    asks = open_.where("label <> main").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).alias("a")
    met = asks.join(
        rows,
        (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.chunk") == F.col("b.chunk")) & (F.col("a.label") != F.col("b.label")) & _possible("a", "b"),
    ).select(
        F.least(F.struct("a.rep", "a.label"), F.struct("b.rep", "b.label")).alias("x"), F.greatest(F.struct("a.rep", "a.label"), F.struct("b.rep", "b.label")).alias("y"), _distance("a", "b").alias("far")
    )
    met = met.groupBy(F.col("x.rep").alias("u"), F.col("y.rep").alias("v")).agg(F.first("x.label").alias("lu"), F.first("y.label").alias("lv"), F.min("far").alias("far"))
    met = store(met.join(tried, ["u", "v"], "left_anti"), "met")
    ends = met.select("u", "v", "far", "lu", "lv", F.explode(F.array("u", "v")).alias("of"))
    nearest = ends.groupBy("of").agg(F.min(F.struct("far", "u", "v", "lu", "lv")).alias("best")).select("best.u", "best.v", "best.lu", "best.lv").distinct()
    nearest = store(nearest, "pairs")
    found = store(_confirmed(nearest.select("u", "v"), sets), "links")
    moves = _lower(nearest.join(found, ["u", "v"], "left_semi").select(F.col("lu").alias("x"), F.col("lv").alias("y")), "moves")
    left = met.join(nearest.select("u", "v"), ["u", "v"], "left_anti")
    left = left.join(moves.select(F.col("label").alias("lu"), F.col("to").alias("mu")), "lu", "left").join(moves.select(F.col("label").alias("lv"), F.col("to").alias("mv")), "lv", "left")
    left = left.where(F.coalesce("mu", "lu") != F.coalesce("mv", "lv")).select("u", "v")
    links = links.unionByName(found).unionByName(store(_confirmed(store(left, "pairs"), sets), "links"))

    group = connected_components(links)
    named = member.join(group, member["rep"] == group["node"], "left")
    named = named.groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    named = store(named, "named").withColumnRenamed("doc_id", "of")
    out = signed.select("doc_id", "n_shingles").join(named, F.col("doc_id") == F.col("of"), "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
    )

