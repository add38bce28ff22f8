"""Byte-level BPE encoding and decoding as a monoid tree reduction.

An encoding is built like a sum: encode halves, then join neighbours.

Text level: a text's parts are the matches of the pattern. A text of up to LEAF characters is matched
directly. Of two neighbours' parts, the left one's last may change, as their match could go on or
look ahead past its end; those (within LOOK characters of the end) are matched again with a
growing window of the right one's parts, until a match ends where a part of the right one does and
LOOK characters of the window follow. A match depends only on what follows its start, so all parts
beyond are what they would be in the whole text.

Byte level: a part that is a token is that token. Else byte strings of up to UNIT bytes are merged by rank (and remembered); longer
ones are halved, and joined by merging a window of tokens at the border anew, growing until its
outermost tokens come out as they were. Every neighbouring pair of the result then stands next to each other
in some right encoding; an encoding all of whose neighbouring pairs do is the right one, so
the tokens outside can't change.

Decoding concatenates the tokens' bytes up the same tree. Nulls: a null text is an empty one (no
ids, no bytes); null ids decode to nothing. Rows are independent, so ties and repeated rows get equal results; an empty table gives an empty result. Texts of
any length are encoded whole, in time that grows like their length (a run of one letter costs some eight times as much as prose, as its windows
double before they settle); the longest text is held once. Other columns pass through, and columns named like an output are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF, LOOK, UNIT, SHORT, KEPT = 4096, 4, 6, 24, 400_000
NONE = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Memo(dict):
    """Ids of strings already met; at most KEPT of them, and no long ones."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.make(part)
        if len(self) >= KEPT:
            self.clear()
        if len(part) <= SHORT:
            self[part] = ids
        return ids


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.tokens = ranks, {i: b for b, i in ranks.items()}
        self.match = regex.compile(pattern).findall
        self.units = _Memo(lambda data: tuple(self.merge(data)))
        self.memo = _Memo(self.piece)

    # text level

    def parts(self, text: str) -> list[str]:
        if len(text) <= LEAF:
            return self.match(text)
        half = len(text) // 2
        return self.join_parts(self.parts(text[:half]), self.parts(text[half:]))

    def join_parts(self, left: list[str], right: list[str]) -> list[str]:
        n, tail = len(left), 0
        while n and tail <= LOOK:
            n -= 1
            tail += len(left[n])
        loose, width = "".join(left[n:]), 4
        while True:
            window = loose + "".join(right[:width])
            found = self.match(window)
            if width >= len(right):
                return left[:n] + found
            ends, at = {}, len(loose)
            for j, part in enumerate(right[:width]):
                at += len(part)
                ends[at] = j + 1
            at = 0
            for k, part in enumerate(found):
                at += len(part)
                if at in ends and at + LOOK <= len(window):
                    return left[:n] + found[: k + 1] + right[ends[at] :]
            width *= 2

    # byte level

    def merge(self, data: bytes) -> list[int]:
        """Merge by rank, lowest first and leftmost among equals."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i : i + 2], NONE) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == NONE:
                break
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
        return [ranks[p] for p in parts]

    def tree(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= UNIT:
            return self.units[data]
        half = len(data) // 2
        return self.join_ids(self.tree(data[:half]), self.tree(data[half:]))

    def join_ids(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        width = 1
        while True:
            a, b = left[-width:], right[:width]
            data = self.decode(a) + self.decode(b)
            ids = self.units[data] if len(data) <= SHORT else tuple(self.merge(data))
            settled = (len(a) == len(left) or ids[0] == a[0]) and (len(b) == len(right) or ids[-1] == b[-1])
            if settled:
                return left[: len(left) - len(a)] + ids + right[len(b) :]
            width *= 2

    def piece(self, part: str) -> tuple[int, ...]:
        data = part.encode()
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else (whole,)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, self.parts(text))))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    keep = [c for c in df.columns if c != name or c == source]
    df = df.select(*[F.col(f"`{c}`") for c in keep])
    others = [c for c in keep if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), make(part.column(source))], [*others, name])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in others), T.StructField(name, kind)]))


def encode_column(df: DataFrame, ranks: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """df with an array<int> column of the text's ids."""

    def make(texts: pa.Array) -> pa.Array:
        ids = [load(ranks, pattern).encode(t or "") for t in texts.to_pylist()]
        ends = np.cumsum([len(x) for x in ids], dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]) if len(ends) else 0)
        return pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends).astype(np.int32)), pa.array(flat))

    return _with_column(df, text, name, T.ArrayType(T.IntegerType(), False), make)


def decode_column(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", name: str = "bytes") -> DataFrame:
    """df with a binary column of the ids' bytes."""

    def make(rows: pa.Array) -> pa.Array:
        values = rows.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))
        decode = load(ranks, pattern).decode
        return pa.array([decode(values[a:b].tolist()) for a, b in zip(np.append(0, ends[:-1]).astype(int), ends)], pa.binary())

    return _with_column(df, ids, name, T.BinaryType(), make)
