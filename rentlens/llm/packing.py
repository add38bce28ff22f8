"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become ids (and an end id); only those longer than a sequence are cut, into full pieces
and a rest. Pieces, a few numbers each, are dealt by a hash to groups of at most about
group_pieces and packed there by bounded-space best fit: at most open_bins bins are open; a
bitset with a bit for each amount of free space finds the tightest bin that a piece fits in with one
shift; a piece that fits nowhere opens a bin, and if that is one too many the fullest is closed.
A group's pieces come in hash order, in blocks of open_bins; each block comes longest first, so that
short ones fill what long ones left. A block can't open more bins than may be open, so a group of any
size stays tight: with a whole group longest first, the bound would close bins before its short pieces came.

Null text counts as empty (the end id alone). Null ids, repeated rows and ties are kept: each input row
gets its own pieces; equal rows get equal pieces in places of their own. An empty table gives an
empty result. The output has its own columns only, so clashing names of other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .word_bpe import load


class Bins:
    """Bounded-space best fit over bins of one size."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = 0
        self.n_open = self.n_bins = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to size tokens."""
        fits = self.bits >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            number, room = self.n_bins, self.size
            self.n_bins += 1
        left = room - length
        if left:
            self.free[left].append(number)
            self.bits |= 1 << left
            self.n_open += 1
            if self.n_open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.size - room

    def _take(self, room: int) -> int:
        number = self.free[room].pop()
        if not self.free[room]:
            self.bits &= ~(1 << room)
        self.n_open -= 1
        return number


def tokenise(df: DataFrame, tokenizer: str, doc_id: str, text: str, size: int, end_id: int) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32."""
    kind = df.schema[doc_id].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, last = load(tokenizer), np.array([end_id], np.uint32)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(bpe.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.append(ids, last).astype("<u4")
                for k, a in enumerate(range(0, len(ids), size)):
                    part = ids[a : a + size]
                    row.append(i), piece.append(k), start.append(a), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of all batches again, in tables of rows rows; the last may have fewer."""
    held, n = [], 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            yield pa.Table.from_batches([*held, batch.slice(0, rows - n)])
            batch, held, n = batch.slice(rows - n), [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def pack(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", *, size: int = 2048, end_id: int = 0, open_bins: int = 4096, group_pieces: int = 200_000) -> DataFrame:
    """The pieces of tokenise() with sequence_id and offset."""
    pieces = cut(tokenise(df, tokenizer, doc_id, text, size, end_id))
    groups = max(1, -(-pieces.count() // group_pieces))
    order = F.xxhash64("doc_id", "piece", "ids_crc32")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, group = Bins(size, open_bins), TaskContext.get().partitionId()
        for block in blocks(batches, open_bins):
            block = block.take(np.argsort(-block.column("length").to_numpy(), kind="stable")).combine_chunks()
            number, offset = zip(*(bins.place(n) for n in block.column("length").to_pylist()))
            names = [n for n in block.column_names if n != "o"]
            out = [*(block.column(n) for n in names), pa.array([(group << 40) + b for b in number], pa.int64()), pa.array(offset, pa.int64())]
            yield from pa.table(out, [*names, "sequence_id", "offset"]).to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.withColumn("o", order).repartition(groups, "o").sortWithinPartitions("o", "doc_id", "piece")
    return dealt.mapInArrow(packed, f"{kinds}, sequence_id long, offset long")
