"""Token-id shards compressed per document with one shared zstandard dictionary.

A store is a folder (any file system pyarrow can open, shared by all executors):

* `dictionary.bin`: the zstandard dictionary, trained on the serialised ids of a bounded sample of
  short documents (`SAMPLE_DOCS` of at most `SAMPLE_CHARS` characters); empty if the sample is too
  small to train on;
* `ids-*.bin`, one per partition, in ascending doc_id order: `MAGIC`, the dictionary's SHA-256,
  then one zstandard frame per document (ids as little-endian uint32), then the offset index (one
  `ENTRY` per document) and the `FOOTER`;
* `manifest/`: one Parquet row per shard, in order.

A reader checks the dictionary's hash, seeks by the index and unpacks only the frames asked for.
A shard is written under a name of its task attempt, and the manifest names the shards of the
attempts that were committed, so a task that runs twice leaves no second copy in the store.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblake.llm.tokens import TokenIds

MAGIC = b"IDSHARD1"
ENTRY = struct.Struct("<?qQQ")  # doc_id is null, doc_id, end of the frame, ids up to its end
FOOTER = struct.Struct("<QQ8s")  # documents, start of the index
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES, LEVEL = 1000, 8000, 1 << 16, 3
_BATCH_BYTES = 1 << 23
ROW = "doc_id long, start long, n_tokens long, tokens binary"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _get(path: str) -> bytes:
    f, p = _open(path)
    with f.open_input_stream(p) as s:
        return s.read()


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from at most SAMPLE_DOCS short documents, taken evenly by the hash of their ids."""
    every = max(1, docs.count() // (2 * SAMPLE_DOCS))
    sample = (docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) & F.length("text").between(1, SAMPLE_CHARS))
              .select("text").limit(SAMPLE_DOCS).collect())
    ids = TokenIds.of(tokenizer).ids
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [ids(r.text) for r in sample], level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def _zstd(dictionary: bytes) -> dict:
    """The dictionary, made ready once: else each document would pay for loading it."""
    if not dictionary:
        return {}
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return {"dict_data": loaded}


class ShardWriter:
    """Writes one shard file; documents are added in order."""

    def __init__(self, folder: str, name: str):
        dictionary = _get(f"{folder}/dictionary.bin")
        self.packer = zstandard.ZstdCompressor(**({} if dictionary else {"level": LEVEL}), **_zstd(dictionary))
        f, p = _open(f"{folder}/{name}")
        self.file = f.open_output_stream(p)
        self.file.write(MAGIC + hashlib.sha256(dictionary).digest())
        self.index, self.at, self.ids = [], 40, 0

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        frame = self.packer.compress(tokens)
        self.file.write(frame)
        self.at, self.ids = self.at + len(frame), self.ids + len(tokens) // 4
        self.index.append(ENTRY.pack(doc_id is None, doc_id or 0, self.at, self.ids))

    def __enter__(self) -> "ShardWriter":
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.file.write(b"".join(self.index))
            self.file.write(FOOTER.pack(len(self.index), self.at, MAGIC))
        self.file.close()


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
              doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, end each document with `end_id`, and write the store at `folder`.

    A null or empty text is the end id alone; null ids come first; equal ids lie next to each other
    by the hash of their texts; repeated rows are all kept; an empty table gives a store of no documents.
    Documents are dealt by ranges of (doc_id, text hash), so many rows of one id are spread as well.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(docs, tokenizer)
    f, p = _open(folder)
    f.create_dir(p, recursive=True)
    with f.open_output_stream(f"{p}/dictionary.bin") as s:
        s.write(dictionary)
    end = end_id.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = TokenIds.of(tokenizer).ids, TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.bin"
        with ShardWriter(folder, name) as shard:
            for b in batches:
                ids_, texts = b.column(0), b.column(1)
                for i in range(b.num_rows):
                    shard.add(ids_[i].as_py(), encode(texts[i].as_py()) + end)
        TokenIds.of(tokenizer).rest(keep=True)
        yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "docs": [len(shard.index)], "ids": [shard.ids]})

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    shards = (docs.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(work, "part long, name string, docs long, ids long").collect())  # a row per shard
    start, rows = 0, []
    for r in sorted(shards, key=lambda r: r.part):
        rows.append((len(rows), r.name, r.docs, r.ids, start))
        start += r.ids
    spark.createDataFrame(rows, "shard int, name string, docs long, ids long, start long").coalesce(1).write.parquet(f"{folder}/manifest")


class Shard:
    """One shard file: `get(i)` unpacks the i-th document alone; `find(doc_id)` gives its numbers."""

    def __init__(self, folder: str, name: str):
        dictionary = _get(f"{folder}/dictionary.bin")
        f, p = _open(f"{folder}/{name}")
        self.file = f.open_input_file(p)
        if self.file.read_at(8, 0) != MAGIC or self.file.read_at(32, 8) != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name}: not a shard of this store, or another dictionary's")
        self.unpacker = zstandard.ZstdDecompressor(**_zstd(dictionary))
        size = self.file.size()
        self.docs, at, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{name}: cut off")
        self.index = self.file.read_at(self.docs * ENTRY.size, at)

    def entry(self, i: int) -> tuple[int | None, int, int, int, int]:
        """doc_id, bytes from and to, ids before and up to the end of document i."""
        null, doc, end, total = ENTRY.unpack_from(self.index, i * ENTRY.size)
        _, _, begin, before = ENTRY.unpack_from(self.index, (i - 1) * ENTRY.size) if i else (0, 0, 40, 0)
        return None if null else doc, begin, end, before, total

    def get(self, i: int) -> bytes:
        _, begin, end, _, _ = self.entry(i)
        return self.unpacker.decompress(self.file.read_at(end - begin, begin))

    def find(self, doc_id: int) -> list[int]:
        """Numbers of the documents of this id, by binary search in the index."""
        def first(key) -> int:
            low, high = 0, self.docs
            while low < high:
                mid = (low + high) // 2
                at = self.entry(mid)[0]
                low, high = (mid + 1, high) if at is None or at < key else (low, mid)
            return low

        return list(range(first(doc_id), first(doc_id + 1)))


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a store: doc_id, start (ids of all documents before it), n_tokens, tokens."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(folder, row["name"])
                out, held = [], 0
                for i in range(shard.docs):
                    doc, _, _, before, total = shard.entry(i)
                    out.append((doc, row["start"] + before, total - before, shard.get(i)))
                    held += len(out[-1][-1])
                    if held >= _BATCH_BYTES or i == shard.docs - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, held = [], 0

    return manifest.select("name", "start").repartition(max(1, manifest.count())).mapInArrow(work, ROW)


def lookup(spark: SparkSession, folder: str, doc_id: int) -> list[bytes]:
    """The ids of one document, from the shards that can hold it: index and frame only, no scan."""
    out = []
    for row in spark.read.parquet(f"{folder}/manifest").where("docs > 0").orderBy("shard").toLocalIterator():
        shard = Shard(folder, row.name)
        first, last = shard.entry(0)[0], shard.entry(shard.docs - 1)[0]
        if last is not None and (first is None or first <= doc_id) and doc_id <= last:
            out += [shard.get(i) for i in shard.find(doc_id)]
    return out
