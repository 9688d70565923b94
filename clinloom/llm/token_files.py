"""Token-id files: flat unsigned integers with 64-bit document offsets.

Rows are ranged by (doc_id, a hash of the text) over partitions and sorted within them. Each task writes
one set of files, under names of its own attempt, so that a repeated attempt never touches what another
wrote: ``.ids`` has the ids as little-endian unsigned integers (16 bits when the vocabulary and the end id
fit, else 32), ``.offsets`` the uint64 starts of the documents and the closing length, ``.docs`` the
int64 doc_ids and then a byte for each that is 1 where the doc_id is not null. The rows that tasks return,
one for each partition, are the manifest. Prefix sums over the manifest give each partition's base; a
document's start is base plus local offset. Readers take ``READ_DOCS`` documents of a file and map the files into
memory; where a store cannot be mapped, they read the ranges that the offsets give.

Nulls and edge cases: a null text is empty and holds the end id alone; rows come in ascending doc_id,
null doc_ids first, equal doc_ids by text hash and text; an empty table writes no files and reads back
as no rows; very long texts are whole; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import Memory, rows_in_slices
from clinloom.session import shared_dir, ship_package, store

#: Stretches, and pieces, that a Python worker remembers (some 170 MB together; a task alone meets each of its
#: words too seldom for a memory of its own to pay); past it a memory starts anew.
CACHE_STRETCHES, CACHE_PIECES = 300_000, 600_000
#: Documents of a file that a reading task takes, and those that it has in hand at once.
READ_DOCS, READ_SLICE = 20_000, 512
MANIFEST = "part int, path string, docs long, tokens long, width int"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The settings of a tokenizer file that the short cut of ``WordEncoder`` holds for.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


def is_known(path: str) -> bool:
    """Whether a tokenizer file cuts texts as the short cut does; added tokens must begin with ``<|``."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    parts = [(given.get("normalizer") or {}).get("normalizers"), (given.get("pre_tokenizer") or {}).get("pretokenizers")]
    model = {k: given["model"].get(k) for k in MODEL}
    tokens = all(t["content"].startswith("<|") and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in given.get("added_tokens") or [])
    return parts == [NORMALIZER, [SPLIT, BYTES]] and model == MODEL and tokens and not given.get("truncation") and not given.get("padding")


class WordEncoder:
    """Encodes whole texts as the tokenizers library does. With a vocabulary whose settings are not those of ``is_known``
    each text goes through the library whole. With those, white space separates
    pieces there and is dropped, so stretches between white space are encoded apart and remembered. In a
    stretch of printable ASCII and Latin-1 letters, which its normaliser only lower-cases, the vocabulary's
    pattern is applied here and only the pieces go to the library's model, their bytes written as its byte
    alphabet has them; every other stretch, and any that may hold a special token, goes through the library
    whole."""

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        model = tokenizer.model
        four = [k.to_bytes(4, "little") for k in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        pack = lambda ids: b"".join([four[k] for k in ids])
        tokenize = model.tokenize
        self.whole = None if is_known(path) else lambda text: pack(tokenizer.encode(text, add_special_tokens=False).ids)
        # the byte alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
        table = [letter[b] for b in range(256)]

        def merge(x: str) -> bytes:
            written = x if x.isascii() else "".join(map(table.__getitem__, x.encode("utf-8")))
            return b"".join([four[t.id] for t in tokenize(written)])

        piece = Memory(merge, CACHE_PIECES)
        plain = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
        # the vocabulary's own pattern, for lower-case letters of that kind
        pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+").findall

        def stretch(x: bytes) -> bytes:
            text = x.decode("utf-8")
            if plain(text) and "<|" not in text:
                return b"".join(map(piece.__getitem__, pieces(text.lower())))
            return pack(tokenizer.encode(text, add_special_tokens=False).ids)

        self.stretches = Memory(stretch, CACHE_STRETCHES)
        self.vocabulary = tokenizer.get_vocab_size(with_added_tokens=True)

    def encode(self, text: str) -> bytes:
        return self.whole(text) if self.whole else b"".join(map(self.stretches.__getitem__, text.encode("utf-8").split()))


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write(documents: DataFrame, path: str, end_id: int, folder: str | None = None, partitions: int | None = None) -> DataFrame:
    """Writes the files of ``documents`` (doc_id, text) into ``folder`` and returns the stored manifest,
    one row for each partition; Spark sizes the ``partitions`` if they aren't given."""
    spark = documents.sparkSession
    ship_package(spark)
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order, "text")

    def run(batches):
        from pyspark import TaskContext

        task, encoder = TaskContext.get(), _encoder(path)
        width = 2 if max(encoder.vocabulary - 1, end_id) < 1 << 16 else 4
        kind, closing = f"<u{width}", np.array([end_id], "<u4").tobytes()
        store_, base = pafs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        ids_out, docs, valid, lengths = None, [], [], []
        for part in rows_in_slices(batches):
            if ids_out is None:
                store_.create_dir(base, recursive=True)
                ids_out = store_.open_output_stream(f"{base}/{name}.ids")
            done = [encoder.encode(t or "") + closing for t in part.column(1).to_pylist()]
            lengths.append(np.array([len(x) // 4 for x in done], np.uint64))
            ids_out.write(np.frombuffer(b"".join(done), "<u4").astype(kind).tobytes())
            column = part.column(0)
            docs.append(np.asarray(column.fill_null(0)).astype("<i8"))
            valid.append(np.asarray(column.is_valid()).astype(np.uint8))
        if ids_out is None:
            return
        ids_out.close()
        starts = np.concatenate([[np.uint64(0)], np.cumsum(np.concatenate(lengths))]).astype("<u8")
        with store_.open_output_stream(f"{base}/{name}.offsets") as out:
            out.write(starts.tobytes())
        with store_.open_output_stream(f"{base}/{name}.docs") as out:
            out.write(np.concatenate(docs).tobytes() + np.concatenate(valid).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([task.partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([len(starts) - 1]), pa.array([int(starts[-1])]), pa.array([width], pa.int32())],
            names=["part", "path", "docs", "tokens", "width"],
        )

    # stored, as another run of the tasks would write other files
    return store(ranged.mapInArrow(run, MANIFEST), "manifest")


class _Numbers:
    """A file of unsigned integers, by ranges: mapped into memory where the store is local."""

    def __init__(self, store_: pafs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        self.mapped = self.file = None
        if isinstance(store_, pafs.LocalFileSystem):
            self.mapped = np.memmap(path, dtype=kind, mode="r") if store_.get_file_info(path).size else np.empty(0, kind)
        else:
            self.file = store_.open_input_file(path)

    def take(self, start: int, stop: int) -> np.ndarray:
        if self.file is None:
            return self.mapped[start:stop]
        return np.frombuffer(self.file.read_at((stop - start) * self.kind.itemsize, start * self.kind.itemsize), self.kind)


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids (array<long>, the end id included)."""
    return _read(manifest, "doc_id long, start long, n_tokens long, ids array<long>", lambda one: one.astype(np.int64))


def read_digests(manifest: DataFrame) -> DataFrame:
    """As ``read``, with ids_crc32 of the ids as little-endian uint32 in place of the ids."""
    return _read(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda one: zlib.crc32(one.astype("<u4").tobytes()))


def _read(manifest: DataFrame, schema: str, of) -> DataFrame:
    spark = manifest.sparkSession
    ship_package(spark)
    # one small row for each partition written
    parts = sorted(manifest.collect(), key=lambda r: r["part"])
    bases, total = [], 0
    for p in parts:
        bases += [(p["path"], p["docs"], p["width"], total, at) for at in range(0, p["docs"], READ_DOCS)]
        total += p["tokens"]
    placed = spark.createDataFrame(bases, "path string, docs long, width int, base long, first long").repartition(max(1, len(bases)))

    def run(batches):
        for batch in batches:
            for one in batch.to_pylist():
                store_, base = pafs.FileSystem.from_uri(one["path"])
                ids = _Numbers(store_, f"{base}.ids", f"<u{one['width']}")
                starts = _Numbers(store_, f"{base}.offsets", "<u8")
                docs = _Numbers(store_, f"{base}.docs", "u1")
                n = one["docs"]
                stop = min(n, one["first"] + READ_DOCS)
                for at in range(one["first"], stop, READ_SLICE):
                    to = min(stop, at + READ_SLICE)
                    cut = starts.take(at, to + 1).astype(np.int64)
                    numbers, valid = docs.take(8 * at, 8 * to).view("<i8"), docs.take(8 * n + at, 8 * n + to)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(numbers), mask=np.array(valid) == 0),
                            pa.array(cut[:-1] + one["base"]),
                            pa.array(np.diff(cut)),
                            pa.array([of(ids.take(a, b)) for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False)]),
                        ],
                        names=[c.split()[0] for c in schema.split(", ")],
                    )

    return placed.mapInArrow(run, schema)


def op8(documents: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return read_digests(write(documents, path, end_id))
