"""Fill-in-the-middle transformation by a table-driven byte automaton.

One automaton over UTF-8 bytes counts characters, units (lines with their end) and sentinels. Its states say how many continuation bytes are
due, how much of a sentinel has been read, and whether a unit is open; a transition may emit a character, the end of a unit, or a sentinel.

First pass: texts are cut into lanes of LANE bytes, which run through the tables side by side, a byte of every lane in one step; each lane
counts what it emits. A lane inside a text first reads the longest sentinel's length of bytes (at least a character) before it without counting: its
state depends on no more. Second pass: the two cuts of a text are ends of known units. The lane that holds such an end follows from the
counts before it, and only that lane is read again, up to the end; its characters complete the count of those before it.

The cuts, the order and whether a text is transformed at all come from a digest of the seed and the id, so they are equal everywhere. A
text that is empty or null, or holds a sentinel, stays plain. restored() rebuilds the text from the output, as sentinels occur only where they were put.

Rows are independent: repeated rows and ties get equal results; a null id counts as an empty one. Texts of any length are read whole, AT_ONCE bytes
of lanes at a time. Other columns pass through, whatever their names; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import free_name

LANE, AT_ONCE = 512, 1 << 22
CHAR, UNIT, FOUND = 1, 2, 4
SENTINELS = ("<P>", "<S>", "<M>")
OUTPUT = ["n", "form", "prefix_chars", "middle_chars", "output"]


class Automaton:
    """next and emits: tables of states by bytes. State 0: a unit is at its start."""

    def __init__(self, sentinels: tuple[str, ...], newline: int = 10):
        words = [s.encode() for s in sentinels]
        if not all(words) or any(not s.isascii() or chr(newline) in s for s in sentinels):
            raise ValueError("sentinels are ASCII strings without a line end")
        # states: at a unit's start, prefixes of sentinels (the empty one: inside a unit), 1 to 3 continuation bytes due
        prefixes = sorted({w[:k] for w in words for k in range(len(w))}, key=lambda p: (len(p), p))
        state = {p: i + 1 for i, p in enumerate(prefixes)}
        due = [1, *(len(prefixes) + k for k in (1, 2, 3))]
        self.next = np.ones((len(prefixes) + 4, 256), np.uint8)
        self.emits = np.zeros_like(self.next)
        for s in range(len(self.next)):
            read = prefixes[s - 1] if 1 <= s <= len(prefixes) else b""
            for b in range(256):
                if b & 0xC0 == 0x80:  # a continuation byte
                    self.next[s, b] = due[due.index(s) - 1] if s in due[1:] else 1
                    continue
                self.emits[s, b] = CHAR
                if b >= 0xC0:
                    self.next[s, b] = due[1 if b < 0xE0 else 2 if b < 0xF0 else 3]
                    continue
                longer = read + bytes([b])
                if any(longer.endswith(w) for w in words):
                    self.emits[s, b] |= FOUND
                if b == newline:
                    self.emits[s, b] |= UNIT
                    self.next[s, b] = 0
                else:
                    self.next[s, b] = next(state[longer[k:]] for k in range(len(longer) + 1) if longer[k:] in state)
        self.before = max(3, *map(len, words))

    def scan(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts of characters, units and sentinels, last state) of each lane start to stop; first: where its text starts."""
        state, counts = np.zeros(len(start), np.uint8), np.zeros((3, len(start)), np.int64)
        for step in range(-self.before, int((stop - start).max(initial=0))):
            at = start + step
            on = np.flatnonzero((at >= first) & (at < stop))
            b, s = data[at[on]], state[on]
            state[on] = self.next[s, b]
            if step >= 0:
                made = self.emits[s, b]
                for k, kind in enumerate((CHAR, UNIT, FOUND)):
                    counts[k, on] += (made & kind) != 0
        return counts, state

    def lanes(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, start, counts, last state) of the lanes of texts first to last."""
        n = -(-(last - first) // lane)
        owner = np.repeat(np.arange(len(first)), n)
        start = first[owner] + lane * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
        stop = np.minimum(start + lane, last[owner])
        counts, state = np.zeros((3, len(owner)), np.int64), np.zeros(len(owner), np.uint8)
        step = max(1, AT_ONCE // lane)
        for i in range(0, len(owner), step):
            part = slice(i, i + step)
            counts[:, part], state[part] = self.scan(data, start[part], stop[part], first[owner[part]])
        return owner, start, counts, state

    def cut(self, data: np.ndarray, start: int, stop: int, units: int) -> tuple[int, int]:
        """(place after the units-th unit end from start on, characters up to there), which lies before stop; start is no later than the character's first byte."""
        state = place = chars = 0
        for place, b in enumerate(data[start:stop].tolist(), start + 1):
            made = int(self.emits[state, b])
            state = int(self.next[state, b])
            chars += made & CHAR
            units -= (made & UNIT) // UNIT
            if not units:
                break
        return place, chars


class Transformer:
    def __init__(self, sentinels: tuple[str, str, str], lane: int = LANE):
        self.auto, self.lane, self.marks = Automaton(sentinels), lane, [s.encode() for s in sentinels]

    def __call__(self, texts: list[bytes], h1: np.ndarray, h2: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> list[tuple]:
        """(n, form, prefix_chars, middle_chars, output) of each text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        last = np.cumsum(sizes)
        first = last - sizes
        owner, start, counts, state = self.auto.lanes(data, first, last, self.lane)
        lanes = np.searchsorted(owner, np.arange(len(texts) + 1))
        sums = np.concatenate((np.zeros((3, 1), np.int64), np.cumsum(counts, axis=1)), axis=1)
        chars, units, found = sums[:, lanes[1:]] - sums[:, lanes[:-1]]
        ended = np.where(sizes > 0, np.append(state, 0)[np.maximum(lanes[1:] - 1, 0)], 0)
        n = units + (ended != 0)  # the last unit may have no end
        out = []
        for i, text in enumerate(texts):
            if plain[i] or found[i] or not text:
                out.append((int(n[i]), "plain", None, None, text))
                continue
            cuts = sorted((int(h1[i] % (n[i] + 1)), int(h2[i] % (n[i] + 1))))
            (a, a_chars), (b, b_chars) = (self._place(data, start, sums, lanes[i], lanes[i + 1], k, int(units[i]), int(sizes[i]), int(chars[i]), int(first[i])) for k in cuts)
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            p, s, m = self.marks
            parts = [s, suffix, p, prefix, m, middle] if spm[i] else [p, prefix, s, suffix, m, middle]
            out.append((int(n[i]), "spm" if spm[i] else "psm", a_chars, b_chars - a_chars, b"".join(parts)))
        return out

    def _place(self, data: np.ndarray, start: np.ndarray, sums: np.ndarray, lo: int, hi: int, k: int, units: int, size: int, chars: int, first: int) -> tuple[int, int]:
        """(byte, character) after the k-th unit of a text with lanes lo to hi."""
        if not k:
            return 0, 0
        if k > units:
            return size, chars
        lane = int(np.searchsorted(sums[1, lo + 1 : hi + 1], sums[1, lo] + k)) + lo  # the first that reaches the count
        at = int(start[lane])
        place, more = self.auto.cut(data, at, min(at + self.lane, first + size), int(sums[1, lo] + k - sums[1, lane]))
        return place - first, int(sums[0, lane] - sums[0, lo]) + more


def digest_parts(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the digest of `seed:id` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", seed: int = 7, percent: int = 100, spm_percent: int = 50, sentinels: tuple[str, str, str] = SENTINELS, keep: list[str] | None = None, lane: int = LANE) -> DataFrame:
    """df's columns (or only those of keep) with n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output."""
    others = [c for c in (df.columns if keep is None else keep) if c not in OUTPUT]
    own = [free_name(df, c) for c in ("body", "first", "second", "plain", "spm")]
    h = digest_parts(F.col(f"`{doc_id}`"), seed)
    made = [F.col(f"`{text}`").cast("binary"), h[0], h[1], h[2] % 100 >= percent, h[3] % 100 < spm_percent]
    types = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = Transformer(sentinels, lane)
        for batch in batches:
            if not batch.num_rows:
                continue
            body, *rest = batch.columns[len(others) :]
            h1, h2, plain, spm = (c.to_numpy(zero_copy_only=False) for c in rest)
            rows = change([t or b"" for t in body.to_pylist()], h1, h2, plain, spm)
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *cols[:-1], cols[-1].cast(pa.string())], [*others, *OUTPUT])

    sent = df.select(*[F.col(f"`{c}`") for c in others], *[c.alias(n) for c, n in zip(made, own)])
    return sent.mapInArrow(run, T.StructType([*(df.schema[c] for c in others), *(T.StructField(c, t) for c, t in zip(OUTPUT, types))]))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, "|".join("\\Q" + s + "\\E" for s in sentinels), -1)
    psm, spm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))), F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
