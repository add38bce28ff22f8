"""Language identification by cross-parsing.

A suffix automaton stands for the reference text of each language. A text is parsed into phrases, each the longest prefix of what is left
that occurs in the reference; the phrases needed, times the logarithm of the reference's length, over the text's length estimate the
cross entropy in bits a letter. The language with the lowest estimate wins.

The references come from a bounded sample of labelled rows: of each language at most docs_per_lang distinct texts, those of up to `short`
characters first and in hash order, longer ones by length, until they have chars_per_lang characters; at least one. Texts are taken whole and
joined so that no phrase crosses a border. An automaton has at most two states a letter; its edges lie in one array of displaced rows
(a state's edge with letter c at place state + c, with its owner), whose size follows the edges, not states times alphabet. Labels of more than
most_langs different values raise an error, as the model is sent to the workers.

Texts are lower-cased, runs of other characters than letters become one space; whole texts are parsed. Pieces of STEP letters are parsed in
lockstep, each from its own start past its end to the end of its last phrase. What depends on a start is then done again: a piece is
entered where the piece before ends its last phrase, and parsed from there until a phrase starts where one did before. So the phrases are
those of one parse from left to right. Ordinary texts settle in a few rounds of that; where phrases never meet (periodic texts), the pieces
that are left are entered in order, each once, so that the work is linear in the text. A letter that the reference lacks is a phrase of its own.

Null and blank texts and texts without a letter are `und` with score 0, as is everything if there is no labelled text. The score of other
texts, from 0.5 to 1, grows with the distance to the second language (1 if there is only one). Ties go to the language first by name; rows
are independent, so repeated rows get equal results. Other columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import free_name

STEP = 256
#: Rounds in which pieces that are entered elsewhere are parsed again side by side, before the rest is done in order.
ROUNDS = 6
SCALE = 12.0
#: Letters that are parsed at once; one longer text is parsed alone.
AT_ONCE = 1 << 20
POINTS = 0x110000


@lru_cache(1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 for other than letters; made once in each Python process."""
    low = np.zeros(POINTS, np.uint32)
    for i in range(POINTS):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            low[i] = ord(small) if len(small) == 1 else i
    return low


def squeeze(text: str, codes: np.ndarray) -> np.ndarray:
    """Codes of a text with one 0 for each run of other characters, none at its ends."""
    c = codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = c != 0
    keep[1:] |= c[:-1] != 0
    c = c[keep]
    return c[:-1] if len(c) and c[-1] == 0 else c


def automaton(pieces: list[np.ndarray]) -> list[dict[int, int]]:
    """The edges of each state of the pieces' suffix automaton; 1 is the root, 0 no state."""
    goto, link, length = [{}, {}], [0, 0], [0, 0]
    for piece in pieces:
        last = 1
        for c in piece.tolist():
            q = goto[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            new = 0
            if q is None:
                goto.append({}), link.append(1), length.append(length[last] + 1)
                new, p = len(goto) - 1, last
                while p and c not in goto[p]:
                    goto[p][c] = new
                    p = link[p]
                q = goto[p][c] if p else 0
            else:
                p = last
            if q and length[q] == length[p] + 1:
                link[new] = q
            elif q:
                goto.append(dict(goto[q])), link.append(link[q]), length.append(length[p] + 1)
                clone = len(goto) - 1
                link[q] = clone
                if new:
                    link[new] = clone
                while p and goto[p].get(c) == q:
                    goto[p][c] = clone
                    p = link[p]
                new = new or clone
            last = new
    return goto


def displaced(goto: list[dict[int, int]], n_codes: int) -> tuple[np.ndarray, int]:
    """(edges, root): each state is a number of its own, and its edge with code c is at state + c: the owner in the upper half, the target in the lower.

    States with many edges are placed first, each at the first number from a scattered one on that is free and whose edges fall on free places."""
    size = 2 * (sum(map(len, goto)) + len(goto)) + 16
    if size + n_codes >= 1 << 31:
        raise ValueError("the references are too long")
    used, taken, place = bytearray(size), bytearray(size + n_codes), [0] * len(goto)
    used[0] = 1
    for s in sorted(range(1, len(goto)), key=lambda s: -len(goto[s])):
        at, codes = s * 2654435761 % size, list(goto[s])
        while used[at] or any(taken[at + c] for c in codes):
            at = (at + 1) % size
        place[s], used[at] = at, 1
        for c in codes:
            taken[at + c] = 1
    edges = np.zeros(size + n_codes, np.int64)
    for s, out in enumerate(goto):
        for c, t in out.items():
            edges[place[s] + c] = place[s] << 32 | place[t]
    return edges, place[1]


class Model:
    """Automata of the languages' texts; each text is taken whole."""

    def __init__(self, texts: dict[str, list[str]]):
        pieces = {lang: [p for p in (squeeze(t, letters()) for t in texts[lang]) if len(p)] for lang in sorted(texts)}
        self.langs = [lang for lang in pieces if pieces[lang]]
        seen = np.unique(np.concatenate([p for lang in self.langs for p in pieces[lang]])) if self.langs else np.zeros(0, int)
        self.alphabet = "".join(chr(c) for c in seen if c)
        place = np.zeros(POINTS, np.int32)
        place[[ord(c) for c in self.alphabet]] = np.arange(1, len(self.alphabet) + 1)
        self.n_codes = len(self.alphabet) + 3  # a letter that no reference has, and the end of a text
        self.tables = [displaced(automaton([place[p] for p in pieces[lang]]), self.n_codes) for lang in self.langs]
        self.bits = np.array([np.log2(max(2, sum(map(len, pieces[lang])))) for lang in self.langs])
        self.made: np.ndarray | None = None

    @property
    def codes(self) -> np.ndarray:
        """Code of each code point; not sent, but made once in each Python process."""
        if self.made is None:
            place = np.full(POINTS, len(self.alphabet) + 1, np.int32)
            place[[ord(c) for c in self.alphabet]] = np.arange(1, len(self.alphabet) + 1)
            low = letters()
            self.made = np.where(low > 0, place[low], 0).astype(np.int32)
        return self.made

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None}

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text of codes, by language."""
        sizes = np.array([len(t) for t in texts])
        end = np.array([len(self.alphabet) + 2], np.int32)
        flat = np.concatenate([x for t in texts for x in (t, end)] or [end])
        first = np.cumsum(sizes + 1) - sizes - 1
        n_pieces = -(-sizes // STEP)
        owner = np.repeat(np.arange(len(texts)), n_pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = first[owner] + number * STEP
        stop = np.minimum(start + STEP, first[owner] + sizes[owner])
        return np.stack([np.bincount(owner, _parsed(flat, start, stop, number > 0, *table), len(texts)) for table in self.tables])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        parts = [squeeze(t, self.codes) if t else np.zeros(0, np.int32) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        if not self.langs or not sizes.sum():
            return ["und"] * len(texts), [0.0] * len(texts)
        cost = self.phrases(parts) * self.bits[:, None] / np.maximum(sizes, 1)
        best = cost.argmin(axis=0)
        if len(self.langs) > 1:
            ranked = np.partition(cost, 1, axis=0)
            score = 1 / (1 + np.exp(-SCALE * (ranked[1] - ranked[0]) / np.maximum(ranked[1], 1e-9)))
        else:
            score = np.ones(len(texts))
        return [self.langs[b] if s else "und" for b, s in zip(best, sizes)], [float(x) if s else 0.0 for x, s in zip(score, sizes)]


def _walk(flat: np.ndarray, start: np.ndarray, limit: np.ndarray, marks: np.ndarray, edges: np.ndarray, root: int, until: bool) -> tuple[np.ndarray, np.ndarray]:
    """Parse from each start to the first phrase that starts at the limit or later; returns (that start, phrases begun before it).

    Without until, the starts of phrases are noted in marks; with it, a parse also ends at a phrase that starts at a mark."""
    reached, begun = start.copy(), np.ones(len(start), np.int64)
    who, at, state = np.arange(len(start)), start.copy(), np.full(len(start), root, np.int64)
    if not until:
        marks[start] = True
    while len(who):
        edge = edges[state + flat[at]]
        on = edge >> 32 == state
        at += on | (state == root)  # a letter that misses at the root is a phrase
        state = np.where(on, edge & 0xFFFFFFFF, root)
        new = np.flatnonzero(~on)
        if not len(new):
            continue
        place, whose = at[new], who[new]
        done = place >= limit[whose]
        if until:
            done |= marks[place]
        reached[whose[done]] = place[done]
        begun[whose[~done]] += 1
        if not until:
            marks[place[~done]] = True
        if done.any():
            left = np.ones(len(who), bool)
            left[new[done]] = False
            who, at, state = who[left], at[left], state[left]
    return reached, begun


def _parsed(flat: np.ndarray, start: np.ndarray, stop: np.ndarray, inner: np.ndarray, edges: np.ndarray, root: int) -> np.ndarray:
    """Phrases that start in each piece (start to stop) in the parse of whole texts; inner pieces follow another one of their text."""
    marks = np.zeros(len(flat) + 1, bool)
    own_leave, count = _walk(flat, start, stop, marks, edges, root, False)
    before = np.concatenate(([0], np.cumsum(marks, dtype=np.int32)))
    leave, entered = own_leave.copy(), start
    for _ in range(ROUNDS):
        entry = np.where(inner, np.concatenate((start[:1], leave[:-1])), start)
        todo = np.flatnonzero(entry != entered)
        if not len(todo):
            return count
        entered, at = entry, entry[todo]
        past, known = at >= stop[todo], marks[at]
        skipped, same, other = todo[past], todo[~past & known], todo[~past & ~known]
        count[skipped], leave[skipped] = 0, entry[skipped]
        count[same], leave[same] = before[stop[same]] - before[entry[same]], own_leave[same]
        reached, begun = _walk(flat, entry[other], stop[other], marks, edges, root, True)
        joined = reached < stop[other]
        count[other] = begun + np.where(joined, before[stop[other]] - before[np.minimum(reached, stop[other])], 0)
        leave[other] = np.where(joined, own_leave[other], reached)
    entry = np.where(inner, np.concatenate((start[:1], leave[:-1])), start)
    letters_, out = memoryview(flat), memoryview(edges)
    for first in np.flatnonzero(entry != entered).tolist():
        k = first
        while k < len(start) and (inner[k] or k == first):
            came = int(leave[k - 1])
            if came == entered[k]:
                break  # all that follows was parsed from there
            entered[k] = came
            reached, begun = came, 0
            while reached < stop[k] and not marks[reached]:
                reached, begun = _phrase_end(letters_, reached, out, root), begun + 1
            joined = reached < stop[k]
            count[k] = begun + (before[stop[k]] - before[reached] if joined else 0)
            leave[k] = own_leave[k] if joined else reached
            k += 1
    return count


def _phrase_end(flat: memoryview, at: int, edges: memoryview, root: int) -> int:
    """End of the phrase that starts at a place."""
    state, start = root, at
    while (edge := edges[state + flat[at]]) >> 32 == state:
        state = edge & 0xFFFFFFFF
        at += 1
    return at + (at == start)


def train(df: DataFrame, text: str, lang: str, *, docs_per_lang: int = 64, short: int = 4096, chars_per_lang: int = 16_384, most_langs: int = 128) -> Model:
    """A model from a bounded sample of the labelled rows; rows with a null label, or without a letter in their text, don't count."""
    labelled = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    place = F.struct(F.greatest(F.length("text"), F.lit(short)).alias("size"), F.xxhash64("text").alias("h"))
    distinct = labelled.select("lang", place.alias("o"), F.length("text").alias("n")).distinct()
    # two levels, so that no task ranks all texts of a language
    part = F.pmod(F.col("o.h"), F.lit(64))
    for by in (["lang", "part"], ["lang"]):
        distinct = distinct.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("o"))).filter(F.col("r") <= docs_per_lang)
    chosen: dict[str, list[tuple[int, int]]] = {}
    for row in distinct.select("lang", "o.h", "n").orderBy("lang", "r").limit(docs_per_lang * most_langs + 1).toLocalIterator():
        rows = chosen.setdefault(row["lang"], [])
        if sum(n for _, n in rows) < chars_per_lang:
            rows.append((row["h"], row["n"]))
    if len(chosen) > most_langs:
        raise ValueError(f"more than {most_langs} languages; most_langs bounds the model, which is sent to every worker")
    if not chosen:
        return Model({})
    # at most docs_per_lang hashes for each of most_langs languages
    wanted = df.sparkSession.createDataFrame([(k, h, i) for k, rows in chosen.items() for i, (h, _) in enumerate(rows)], "lang string, h long, r int")
    found = labelled.withColumn("h", F.xxhash64("text")).join(F.broadcast(wanted), ["lang", "h"]).groupBy("lang", "r").agg(F.min("text").alias("text"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in found.collect():
        texts.setdefault(row["lang"], []).append((row["r"], row["text"]))
    return Model({k: [t for _, t in sorted(v)] for k, v in texts.items()})


def identify(df: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """df with the predicted language and a score."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    others = [c for c in df.columns if c not in names]

    def some(texts: list[str | None]) -> Iterator[list[str | None]]:
        held, n = [], 0
        for t in texts:
            if held and n + len(t or "") > AT_ONCE:
                yield held
                held, n = [], 0
            held.append(t)
            n += len(t or "")
        yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for part in some(batch.column(len(others)).to_pylist()):
                a, b = sent.value.predict(part)
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*others, *names])

    schema = T.StructType([*(df.schema[c] for c in others), T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return df.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias(free_name(df, "text"))).mapInArrow(run, schema)


def bucket(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts: the fold of a document."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
