"""Token-id shards on disk with a minimal perfect hash index for keyed access.

write() encodes the documents, range-partitions their ids by key, and writes each partition as
shards of two files:
* NAME.ids: the raw ids, little-endian, 2 bytes each if the vocabulary allows it, else 4, nothing else;
* NAME.idx: the keys in order as an Arrow stream, the offsets of their ids, and the hash index.
A manifest (one entry for each shard: first and last key, counts, ids in all shards before) makes
the set whole. The index is a cascade of bit arrays: a key whose place in a level nobody shares
sets that bit and is done, the others go on to the next level; a bit's rank over all levels is
the key's slot, so n keys have n slots. A slot stores a fingerprint, so that unknown keys are told
from known ones, and the document's place. A lookup costs a few probes, however many keys there are.

File names follow from the partition; a file is written under a name of the attempt and then renamed,
so retried or speculative tasks leave the same bytes. Null text is empty; its document has the end
id alone. A null key sorts first and is found by None. Of rows that repeat a key all are in the
payload, in the order of their ids' bytes; the index finds the first; they go to one task, as a key is an id. Texts of any length are encoded whole. An empty table gives a manifest without shards. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .word_bpe import load

MAGIC = b"RLIDX001"
LEVELS = 48


def _hash(key) -> int:
    return xxhash.xxh3_64_intdigest(b"n" if key is None else b"k" + str(key).encode())


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit hash for each level."""
    with np.errstate(over="ignore"):
        x = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Index:
    """Minimal perfect hash from key hashes to the numbers 0 to n - 1, with fingerprints."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, values: np.ndarray):
        self.levels, self.prints, self.values = levels, prints, values
        self.ranks, before = [], 0
        for bits in levels:
            counts = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(counts - bits + before)
            before += int(counts[-1]) if len(counts) else 0

    @classmethod
    def build(cls, hashes: np.ndarray, values: np.ndarray) -> Index:
        left, levels = hashes, []
        while len(left) and len(levels) < LEVELS:
            at = (_mix(left, len(levels)) % np.uint64(2 * len(left))).astype(np.int64)
            bits = np.bincount(at, minlength=2 * len(left)) == 1
            levels.append(bits.astype(np.uint8))
            left = left[~bits[at]]
        if len(left):
            raise ValueError("two different keys have the same 64-bit hash")
        index = cls(levels, np.zeros(len(hashes), np.uint32), np.zeros(len(hashes), np.int64))
        slot = index.slots(hashes)
        index.prints[slot] = _mix(hashes, LEVELS).astype(np.uint32)
        index.values[slot] = values
        return index

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 if no level has its bit."""
        out = np.full(len(hashes), -1, np.int64)
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            todo = np.flatnonzero(out < 0)
            if not len(todo):
                break
            at = (_mix(hashes[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[todo[hit]] = ranks[at[hit]]
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Stored value of each hash, -1 for a key that isn't there."""
        if not len(self.prints):
            return np.full(len(hashes), -1, np.int64)
        slot = self.slots(hashes)
        known = (slot >= 0) & (self.prints[slot] == _mix(hashes, LEVELS).astype(np.uint32))
        return np.where(known, self.values[slot], -1)

    def dump(self) -> bytes:
        head = struct.pack("<II", len(self.levels), len(self.prints)) + np.array([len(b) for b in self.levels], "<u4").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.levels) + self.prints.astype("<u4").tobytes() + self.values.astype("<i8").tobytes()

    @classmethod
    def parse(cls, raw: memoryview) -> Index:
        n_levels, n = struct.unpack_from("<II", raw)
        sizes, at, levels = np.frombuffer(raw, "<u4", n_levels, 8), 8 + 4 * n_levels, []
        for size in sizes.tolist():
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8), at), count=size))
            at += -(-size // 8)
        return cls(levels, np.frombuffer(raw, "<u4", n, at), np.frombuffer(raw, "<i8", n, at + 4 * n))


def _width(size: int, end_id: int) -> int:
    """Bytes of an id."""
    return 2 if max(size, end_id + 1) <= 1 << 16 else 4


def _put(fs: pafs.FileSystem, path: str, data: bytes, attempt: str) -> None:
    with fs.open_output_stream(f"{path}.{attempt}") as f:
        f.write(data)
    fs.move(f"{path}.{attempt}", path)


def _get(fs: pafs.FileSystem, path: str) -> bytes:
    with fs.open_input_stream(path) as f:
        return f.read()


class Shard:
    """An open shard: its index, keys and offsets are read; ids come by key or by number."""

    def __init__(self, fs: pafs.FileSystem, path: str, width: int):
        self.fs, self.path, self.width = fs, path, width
        raw = memoryview(_get(fs, path + ".idx"))
        if raw[:8] != MAGIC:
            raise ValueError(f"{path}.idx is not an index file")
        n_keys, n_offsets = struct.unpack_from("<QQ", raw, 8)
        self.keys = pa.ipc.open_stream(raw[24 : 24 + n_keys]).read_all().column(0)
        self.offsets = np.frombuffer(raw, "<i8", n_offsets, 24 + n_keys)
        self.index = Index.parse(raw[24 + n_keys + 8 * n_offsets :])

    def number(self, keys: list) -> np.ndarray:
        return self.index.find(np.array([_hash(k) for k in keys], np.uint64))

    def ids(self, number: int) -> np.ndarray:
        a, b = int(self.offsets[number]), int(self.offsets[number + 1])
        with self.fs.open_input_file(self.path + ".ids") as f:
            return np.frombuffer(f.read_at((b - a) * self.width, a * self.width), f"<u{self.width}")


def write(df: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", *, end_id: int = 2, partitions: int | None = None, shard_ids: int = 1 << 25) -> dict:
    """Write the documents under path; returns the manifest. A partition rolls over to a new shard after shard_ids ids."""
    spark = df.sparkSession
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        width = _width(bpe.size, end_id)
        for batch in batches:
            ids = [np.append(x, end_id).astype(f"<u{width}").tobytes() for x in bpe.encode([t or "" for t in batch.column(1).to_pylist()])]
            part = [0 if k is None else max(0, bisect_right(bounds, k) - 1) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(part, pa.int32()), pa.array(ids, pa.binary())], ["k", "part", "ids"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, task = _width(load(tokenizer).size, end_id), TaskContext.get()
        out, base = pafs.FileSystem.from_uri(path)
        keys, payload, lengths, total, count = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, payload, lengths, total, count
            name = f"{base}/part-{task.partitionId():06d}-{count:04d}"
            column = pa.chunked_array(keys)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("key", column.type)])) as stream:
                stream.write_table(pa.table({"key": column}))
            stored = column.to_pylist()
            hashes, places = np.unique(np.array([_hash(k) for k in stored], np.uint64), return_index=True)
            if len(set(stored)) != len(hashes):
                raise ValueError("two different keys have the same 64-bit hash")
            offsets = np.append(0, np.cumsum(np.concatenate(lengths))).astype("<i8")
            head = sink.getvalue().to_pybytes()
            attempt = f"try-{task.taskAttemptId()}"
            _put(out, name + ".ids", b"".join(payload), attempt)
            _put(out, name + ".idx", MAGIC + struct.pack("<QQ", len(head), len(offsets)) + head + offsets.tobytes() + Index.build(hashes, places).dump(), attempt)
            row = [[name.rsplit("/", 1)[1]], [task.partitionId()], [count], [json.dumps(stored[0])], [json.dumps(stored[-1])], [len(stored)], [int(offsets[-1])], [width]]
            keys, payload, lengths, total, count = [], [], [], 0, count + 1
            return pa.RecordBatch.from_arrays([pa.array(r) for r in row], ["name", "part", "roll", "first", "last", "n_docs", "n_ids", "width"])

        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = part.column(1).to_pylist()
                keys.append(part.column(0))
                payload += ids
                lengths.append(np.array([len(x) // width for x in ids]))
                total += int(lengths[-1].sum())
                if total >= shard_ids:
                    yield flush()
        if lengths:
            yield flush()

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[doc_id].dataType.simpleString()
    # the ranges come from the keys alone, so that texts are encoded once and only ids are shuffled; a bound for each partition
    ranges = df.select(F.col(doc_id).alias("k")).filter("k is not null").repartitionByRange(n, "k").groupBy(F.spark_partition_id().alias("part")).agg(F.min("k").alias("k"))
    bounds = sorted(r["k"] for r in ranges.collect())
    made = df.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).mapInArrow(encoded, f"k {kind}, part int, ids binary")
    dealt = made.repartitionById(max(1, len(bounds)), F.col("part")).sortWithinPartitions("k", "ids").select("k", "ids")
    rows = dealt.mapInArrow(shards, "name string, part long, roll long, first string, last string, n_docs long, n_ids long, width long").collect()
    manifest = {"end_id": end_id, "shards": [], "key": kind}
    before = 0
    for r in sorted(rows, key=lambda r: (r["part"], r["roll"])):
        manifest["shards"].append({"name": r["name"], "first": json.loads(r["first"]), "last": json.loads(r["last"]), "n_docs": r["n_docs"], "n_ids": r["n_ids"], "before": before, "width": r["width"]})
        before += r["n_ids"]
    _put(fs, f"{root}/manifest.json", json.dumps(manifest).encode(), "try")
    return manifest


class Reader:
    """Keyed access to a written set: reader[key] gives the ids of a document."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path)
        self.manifest = json.loads(_get(self.fs, f"{self.root}/manifest.json"))
        self.firsts = [(s["first"] is not None, s["first"] if s["first"] is not None else 0) for s in self.manifest["shards"]]
        self.opened: dict[int, Shard] = {}

    def shard(self, i: int) -> Shard:
        if i not in self.opened:
            s = self.manifest["shards"][i]
            self.opened[i] = Shard(self.fs, f"{self.root}/{s['name']}", s["width"])
        return self.opened[i]

    def __getitem__(self, key) -> np.ndarray:
        i = max(0, bisect_right(self.firsts, (key is not None, key if key is not None else 0)) - 1)
        while i > 0 and self.manifest["shards"][i]["first"] == key and self.manifest["shards"][i - 1]["last"] == key:
            i -= 1
        if self.manifest["shards"] and (n := int(self.shard(i).number([key])[0])) >= 0:
            return self.shard(i).ids(n)
        raise KeyError(key)


def places(shard: Shard) -> np.ndarray:
    """Where the index finds the document of each stored key; rows that repeat a key follow the first, which it finds."""
    keys = shard.keys.to_pylist()
    at = np.arange(len(keys))
    first = np.array([i == 0 or keys[i] != keys[i - 1] for i in at.tolist()], bool)
    found = shard.number(keys) + at - np.maximum.accumulate(np.where(first, at, 0))
    if (np.sort(found) != at).any():
        raise ValueError(f"{shard.path}: the index doesn't lead to each stored document once")
    return found


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each stored document: doc_id, start, n_tokens, ids_crc32. Each key is looked up in its shard's index, and its ids are read where that
    says. Each shard is a row of the plan's input."""
    manifest = Reader(path).manifest
    kind = manifest["key"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for s in batch.to_pylist():
                shard = Shard(fs, f"{root}/{s['name']}", s["width"])
                found = places(shard)
                raw = _get(fs, shard.path + ".ids")
                starts, ends = shard.offsets[found], shard.offsets[found + 1]
                crc = [zlib.crc32(np.frombuffer(raw, f"<u{shard.width}", b - a, a * shard.width).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([shard.keys.combine_chunks(), pa.array(starts + s["before"]), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = [(s["name"], s["before"], s["width"]) for s in manifest["shards"]]
    listed = spark.createDataFrame(shards, "name string, before long, width long").repartition(max(1, len(shards)), "name")
    return listed.mapInArrow(rows, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
