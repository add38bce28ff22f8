"""Token counts of a byte-level BPE vocabulary (a tokenizers JSON file), by overlap resynchronisation for huge texts.

A text of up to `chunk` characters is encoded whole. A longer one is encoded in overlapping chunks with offsets, and two neighbours are spliced at
a boundary in their overlap that is proven to be one of the whole text's encoding:

* Between pre-tokens: a pre-token depends only on the text from its start on, and on no more than LOOK characters after its end (the longest
  special token and a few more). So those of the left chunk that end that far before the chunk's end are those of the whole text, if the
  chunk's were counted from a proven boundary. Where the right chunk has a boundary at the same place, all that follows it is right.
* Inside a pre-token that covers the overlap (a run of one kind of character): a token that both chunks have in the same place. Each two
  neighbours of the result then stand next to each other in some right encoding, and an encoding all of whose neighbours do is the right one.

Where neither is found, the overlap is widened: twice as long, and from a token boundary of the left chunk, so that periodic texts, whose
tokens never align by chance, do. An overlap that would reach past the left chunk's proven part ends in encoding both as one. Memory is that
of a chunk or two, whatever the text's length; the work is linear in it.

Texts that need no chunks take a rank-ordered BPE of the same vocabulary, if every token is the library's encoding of its own bytes, which is
checked when the file is loaded and makes both engines equal; otherwise they too go through the library. Special tokens inside a text count as one token,
as is the library's default; none is added. A null or empty text has no token; rows are independent, so ties and repeated rows don't matter; other columns
pass through, and one named like an output is replaced. Files of another shape than byte-level letters with the usual split raise an error.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import free_name
from .word_bpe import byte_letters

CHUNK, OVERLAP, LOOK = 32_768, 256, 16
#: Fixed value: the split that byte-level pre-tokenizers of this kind make.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Chunk:
    """Tokens of text[start:end]; starts are places in the whole text, clean where no character is cut."""

    def __init__(self, tok, text: str, start: int, end: int):
        made = tok.encode(text[start:end], add_special_tokens=False)
        offsets = np.array(made.offsets, np.int64).reshape(-1, 2)
        self.start, self.end, self.ids = start, end, np.array(made.ids, np.int64)
        self.starts, self.words = offsets[:, 0] + start, np.array(made.word_ids, np.int64)
        self.clean = np.append(True, offsets[:-1, 1] <= offsets[1:, 0])[: len(self.ids)]
        self.new_word = np.append(True, self.words[1:] != self.words[:-1])[: len(self.ids)]

    def word_start(self, k: int) -> int:
        return int(self.starts[np.searchsorted(self.words, self.words[k])])

    def first_word_end(self) -> int:
        later = np.flatnonzero(self.words != self.words[0])
        return int(self.starts[later[0]]) if len(later) else self.end


class Counter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a core for each task
        from tokenizers import Tokenizer, processors

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre, self.special = spec["pre_tokenizer"] or {}, [t["content"] for t in spec["added_tokens"]]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec["normalizer"] or not plain:
            raise ValueError("not a byte-level BPE vocabulary with the usual split")
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with the blanks
        self.look = LOOK + max(map(len, self.special), default=0)
        self.chunk, self.overlap = max(chunk, 4 * self.look), max(overlap, 2 * self.look)
        self.quick = self._quick(spec)

    def _quick(self, spec: dict) -> tiktoken.Encoding | None:
        vocab, letters = spec["model"]["vocab"], byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ids = [vocab[p] for p in pairs]
        if ids != sorted(set(ids)) or len(ranks) != 256 + len(ids) or sorted(ranks[bytes([b])] for b in range(256)) != sorted(set(ranks.values()) - set(ids)):
            return None
        # through the model itself, as pre-tokenizers would split some tokens
        if any([t.id for t in self.tok.model.tokenize(token)] != [i] for token, i in vocab.items() if token not in self.special):
            return None
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def count(self, text: str) -> int:
        if len(text) > self.chunk:
            return self.chunked(text)
        if self.quick:
            return len(self.quick.encode(text, allowed_special="all"))
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def chunked(self, text: str) -> int:
        n, total, skip, inside = len(text), 0, 0, False  # skip: tokens of the chunk before its proven start; inside: that is inside a pre-token
        left = Chunk(self.tok, text, 0, min(n, self.chunk))
        while left.end < n:
            proven = int(left.starts[skip])
            overlap, start = self.overlap, left.end - self.overlap
            while True:
                if start <= proven:
                    both = Chunk(self.tok, text, proven, min(n, left.end + max(self.chunk, left.end - proven)))
                    if inside and both.ids[0] != left.ids[skip]:  # what proved the boundary is gone
                        return len(self.tok.encode(text, add_special_tokens=False).ids)
                    left, skip = both, 0
                    break
                right = Chunk(self.tok, text, start, min(n, left.end + self.chunk - self.overlap))
                at = self.splice(left, skip, right)
                if at:
                    total += at[0] - skip
                    left, skip, inside = right, at[1], at[2]
                    break
                overlap *= 2
                before = left.starts[skip:][left.clean[skip:] & (left.starts[skip:] <= left.end - overlap)]
                start = int(before[-1]) if len(before) else proven
        return total + len(left.ids) - skip

    def splice(self, left: Chunk, skip: int, right: Chunk) -> tuple[int, int, bool] | None:
        """Numbers of the left and the right chunk's token at the last proven boundary of both; whether it is inside a pre-token."""
        i = np.flatnonzero(left.clean & (left.starts >= right.start))
        i = i[i >= skip]
        j = np.flatnonzero(right.clean & (right.starts <= left.end))
        _, a, b = np.intersect1d(left.starts[i], right.starts[j], assume_unique=True, return_indices=True)
        i, j = i[a], j[b]
        settled = left.new_word[i] & right.new_word[j] & (left.starts[i] <= left.end - self.look)
        inside = not settled.any()
        if inside and len(i) and left.word_start(-1) < right.start and right.first_word_end() >= left.end:
            settled = left.ids[i] == right.ids[j]
        last = np.flatnonzero(settled)
        return (int(i[last[-1]]), int(j[last[-1]]), inside) if len(last) else None


_LOADED: dict[tuple, Counter] = {}


def load(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    if (path, chunk, overlap) not in _LOADED:
        _LOADED[path, chunk, overlap] = Counter(path, chunk, overlap)
    return _LOADED[path, chunk, overlap]


def count_tokens(df: DataFrame, path: str, *, text: str = "text", limit: int = 512, keep: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """df's columns (or only those of keep, so that texts needn't come back from the workers) with n_bytes, n_tokens and over_limit of its text."""
    out = ("n_bytes", "n_tokens", "over_limit")
    others, body, source = [c for c in (df.columns if keep is None else keep) if c not in out], free_name(df, "body"), F.col(f"`{text}`")
    names = [*others, "n_bytes", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path, chunk, overlap)
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch.column(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names)

    schema = T.StructType([*(df.schema[c] for c in others), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    sent = df.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.octet_length(source), F.lit(0)).cast("long").alias("n_bytes"), source.alias(body))
    return sent.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
