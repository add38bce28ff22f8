"""Exact Jaccard similarity join of documents over word shingles, by pivots and regions.

The distance 1 - J is a metric with a link radius r = 1 - threshold. Documents of a corpus are nearly all at
distance 1 from each other, so a pivot document tells nothing about most of them. Pivots come in two kinds:

1. Shingles as pivots. The shingles have one global order, rarest first (by a count sketch of fixed
   size over all documents, so its size doesn't grow with the data; any order gives right results). Two sets that
   link differ in so few members that they share one of the first floor(r * n) + 1 of each: the window into which a
   document is replicated. Within a shingle's run, size and place bounds drop documents without a possible partner.
   The run's first document becomes the pivot of a region with all of the run, so that every pair that can link meets in a region. Runs are dealt by
   shingle. A shingle that many more documents have than others by the sketch (a passage that near copies share) is not: its smallest document is found by
   an aggregation with partial results, and joined to its postings, which adaptive execution can split.
2. Documents as pivots, inside a region. For two pivots p and q far apart, a set x goes to p's cell if
   d(x, p) <= d(x, q) + 2r and to q's if d(x, q) <= d(x, p) + 2r; by the triangle inequality any linked pair shares a
   cell. Cells are joined recursively. Members of p's ball of radius r are linked through p, so pairs inside
   a component are not looked at: near copies of one text cost one comparison each, not one for each pair.

Regions too heavy for a task are dealt to chunks, each with the pivot's set. What is in one component then is done; the
others, if few, go to every chunk and are compared with all of it; else they, and those of the main component within r of their
distances, form the next round's region around another pivot. After `rounds` rounds what is left is compared chunk by
chunk, each with each, which is exact as well.

Sets of equal shingles are one node (the smallest id), found by a 128-bit hash; copies never meet.

Contract: words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a document with fewer words than a shingle has its whole word
sequence as the one shingle; null, empty and blank texts have an empty set and link with nothing (component: own id).
Rows with a null id are not compared (component null). Rows that repeat an id count as one document: the id links its texts, blank ones too.
An empty table gives an empty result. The output has its own columns only, so clashing names of other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import cut, release

SKETCH = 1 << 18
RUN = 128
#: Documents of a sketch cell from which its shingles are not dealt as runs: so many, and so many times the mean cell.
HOT, HOT_MEANS = 1024, 4
HEAVY_DOCS, HEAVY_SHINGLES = 1000, 500_000
_RNG = np.random.default_rng(20240229)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: a sum over its bytes and their places, mixed."""
    buf = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    edge = np.flatnonzero(np.diff(~_BLANK[buf], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    buf, sizes, starts = buf[starts[0] : ends[-1]], ends - starts, starts - starts[0]
    place = np.arange(len(buf)) - np.repeat(starts, np.diff(starts, append=len(buf)))
    factor = _PLACES[place & 63]
    if len(buf) > 64 and (place > 63).any():
        factor = np.where(place > 63, _mix(factor + place.astype(np.uint64)), factor)
    values = np.where(_BLANK[buf], np.uint64(0), _BYTES[buf] * factor)
    return _mix(np.add.reduceat(values, starts) + sizes.astype(np.uint64))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    if not text:
        return np.zeros(0, np.uint64)
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - size + 1)
    h = np.full(n, min(len(w), size), np.uint64)
    for k in range(min(size, len(w))):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n])
    return np.unique(h)


def _fold(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    a, b = _mix(s).sum(dtype=np.uint64), _mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle, by hash modulo SKETCH: the same size for any corpus."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in (batch.slice(i, 128) for i in range(0, batch.num_rows, 128)):
                found = np.concatenate([shingles(t, size) for t in part.column("text").to_pylist()])
                total += np.bincount((found & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    rows = docs.select("text").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(SKETCH, np.int64)
    for batch in rows.toArrow().to_batches():
        out[batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
    return out


def describe(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """id, n (set size), k1 and k2 (set hash), window (the first shingles in the global order) and hot (those of them that are too common for a run; the last in the order)."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    limit = max(HOT, HOT_MEANS * int(counts.mean()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = sent.value
        for batch in batches:
            n, k1, k2, windows, hot = [], [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingles(t, size)
                a, b = _fold(s)
                width = len(s) + -len(s) * percent // 100 + 1 if len(s) else 0
                c = common[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                if width < len(s):
                    near = np.flatnonzero(c <= np.partition(c, width - 1)[width - 1])
                    first = near[np.lexsort((s[near], c[near]))][:width]
                else:
                    first = np.lexsort((s, c))
                cold, first = int(np.searchsorted(c[first], limit, "right")), s[first].astype(np.int64)
                n.append(len(s)), k1.append(a), k2.append(b), windows.append(first[:cold]), hot.append(first[cold:])
            longs, lists = pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, longs), pa.array(k1, longs), pa.array(k2, longs), pa.array(windows, lists), pa.array(hot, lists)], ["id", "n", "k1", "k2", "window", "hot"]
            )

    return docs.mapInArrow(run, "id long, n long, k1 long, k2 long, window array<long>, hot array<long>")


def _possible(n: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Which members of a run can link with another one, if this is the first shingle that both share."""
    need = -(-percent * (n[:, None] + n[None, :]) // (100 + percent))
    room = np.minimum(n[:, None] - at[:, None], n[None, :] - at[None, :])
    ok = (room >= need) & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
    np.fill_diagonal(ok, False)
    return ok.any(axis=1)


def regions(nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct (pivot, node, n): the members of each region."""
    posted = nodes.select("node", "n", F.posexplode("window").alias("at", "shingle")).repartition("shingle").sortWithinPartitions("shingle", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of up to RUN members are looked at as a whole; longer ones stream through to their first member's region."""
        held: list[np.ndarray] = []
        pivot, shingle, size = None, None, 0
        out: list[np.ndarray] = []

        def close() -> None:
            nonlocal held
            if held and size > 1:
                m = np.concatenate(held)
                keep = _possible(m[:, 1], m[:, 2], percent)
                if keep.any():
                    m = m[keep]
                    out.append(np.column_stack([np.full(len(m), m[0, 0]), m[:, 0], m[:, 1]]))
            held = []

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shingle", "node", "n", "at")]
            cuts = np.flatnonzero(np.diff(cols[0])) + 1
            bounds = np.concatenate(([0], cuts, [len(cols[0])]))
            lone = np.diff(bounds) == 1
            rows = np.column_stack(cols[1:])
            lone[[0, -1]] = False  # these may go on in another batch
            for k in np.flatnonzero(~lone).tolist():
                a, b = int(bounds[k]), int(bounds[k + 1])
                if shingle is None or cols[0][a] != shingle:
                    close()
                    shingle, size, pivot = cols[0][a], 0, rows[a, 0]
                size += b - a
                if size <= RUN:
                    held.append(rows[a:b])
                else:
                    for m in [*held, rows[a:b]]:
                        out.append(np.column_stack([np.full(len(m), pivot), m[:, 0], m[:, 1]]))
                    held = []
            if out:
                m = np.unique(np.concatenate(out), axis=0)
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(m[:, i]) for i in range(3)], ["pivot", "node", "n"])
        close()
        if out:
            m = np.unique(np.concatenate(out), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(m[:, i]) for i in range(3)], ["pivot", "node", "n"])

    found = posted.mapInArrow(run, "pivot long, node long, n long")
    common = nodes.filter(F.size("hot") > 0).select("node", "n", F.explode("hot").alias("shingle"))
    pivots = common.groupBy("shingle").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).filter("m > 1").select("shingle", "pivot")
    return found.unionByName(common.join(pivots, "shingle").select("pivot", "node", "n")).distinct()


class Region:
    """Exact join of a region's sets in memory."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray], percent: int):
        self.nodes, self.percent = nodes, percent
        self.sizes = np.array([len(s) for s in sets])
        names, self.members = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(names), bool)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        first: dict[int, int] = {}
        self.root = [first.setdefault(n, i) for i, n in enumerate(nodes)]
        self.links: list[tuple[int, int]] = []
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def measure(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        """Distance from p to all sets, and which of them link with it; new links are noted."""
        if p not in self.known:
            own = self.members[self.starts[p] : self.starts[p] + self.sizes[p]]
            self.mark[own] = True
            shared = np.add.reduceat(self.mark[self.members].astype(np.int64), self.starts)
            self.mark[own] = False
            union = self.sizes + self.sizes[p] - shared
            linked = 100 * shared >= self.percent * union
            for x in np.flatnonzero(linked).tolist():
                a, b = self.find(p), self.find(x)
                if a != b:
                    self.root[max(a, b)] = min(a, b)
                    self.links.append((self.nodes[p], self.nodes[x]))
            self.known[p] = (1 - shared / union, linked)
        return self.known[p]

    def join(self, members: np.ndarray) -> None:
        reach = 2 * (1 - self.percent / 100) + 1e-9
        while len(members) > 1:
            roots = {self.find(i) for i in members.tolist()}
            if len(roots) == 1:
                return
            p = int(members[0])
            dp = self.measure(p)[0][members]
            if len(members) > 8:
                q = int(members[int(dp.argmax())])
                dq = self.measure(q)[0][members]
                left, right = members[dp <= dq + reach], members[dq <= dp + reach]
                if max(len(left), len(right)) <= 0.75 * len(members):
                    self.join(left)
                    members = right
                    continue
            members = members[1:]


def _unpack(z: bytes, size: int) -> np.ndarray:
    return shingles(zlib.decompress(z).decode("utf-8", "surrogatepass"), size)


def _join_groups(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (region, chunk, pivot, node, z), a group by region and chunk. Returns (a, b, d, region): links with d null, and each member's distance to the pivot with b null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], None] = {}  # a repeated id can stand on several texts
        key = None
        out: list[tuple] = []

        def close() -> None:
            if len(held) < 2:
                return
            full = [(n, s) for n, s in ((n, _unpack(z, size)) for n, z in held) if len(s)]  # an id's other text can be blank
            if len(full) < 2:
                return
            nodes = [n for n, _ in full]
            region = Region(nodes, [s for _, s in full], percent)
            pivots = [i for i, n in enumerate(nodes) if n == key[2]]
            if pivots and key[3] > 1:
                # the least distance of an id's texts, and the largest
                near = np.min([region.measure(p)[0] for p in pivots], axis=0)
                far = np.max([region.measure(p)[0] for p in pivots], axis=0)
                out.extend((n, None, float(x), key[0]) for i, n in enumerate(nodes) for x in {near[i], far[i]})
            region.join(np.arange(len(nodes)))
            out.extend((a, b, None, key[0]) for a, b in region.links)

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], ["a", "b", "d", "region"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("region", "chunk", "pivot", "chunks", "node", "z")]
            for region, chunk, pivot, chunks, node, z in zip(*cols):
                if key is None or key[:2] != (region, chunk):
                    close()
                    held.clear()
                    key = (region, chunk, pivot, chunks)
                held[node, z] = None
            if out:
                yield batch_of()
        close()
        if out:
            yield batch_of()

    dealt = rows.repartition("region", "chunk").sortWithinPartitions("region", "chunk", "node")
    return dealt.select("region", "chunk", "pivot", "chunks", "node", "z").mapInArrow(run, "a long, b long, d double, region long")


def _chunked(members: DataFrame, docs: int, weight: int) -> DataFrame:
    """members (region, pivot, node, n, wide, last) with chunks (how many the region needs) and chunk; wide ones go to all chunks."""
    sums = members.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    chunks = F.greatest(F.ceil(F.col("m") / docs), F.ceil(F.col("w") / weight), F.lit(1)).cast("int")
    # cut: a join with a plain side can be split where one region has many documents, or do without a shuffle
    sized = members.join(cut(sums.select("region", chunks.alias("chunks"))), "region")
    own = F.array(F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    return sized.withColumn("chunk", F.explode(F.when(F.col("wide"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(own)))


def links(nodes: DataFrame, docs: DataFrame, *, size: int, threshold: float, rounds: int = 4, heavy_docs: int = HEAVY_DOCS, heavy_shingles: int = HEAVY_SHINGLES) -> DataFrame:
    """Edges (a, b) between nodes whose components are those of all links. nodes: node, n, window, hot; docs: id, text."""
    percent = round(threshold * 100)
    members = cut(regions(nodes.filter("n > 0"), percent)).withColumns({"region": F.col("pivot"), "wide": F.col("node") == F.col("pivot"), "last": F.lit(False)})
    release(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(z, pa.binary())], ["id", "z"])

    kept = docs.filter("id is not null and text is not null").mapInArrow(packed, "id long, z binary")
    texts = cut(kept.join(members.select(F.col("node").alias("id")).distinct(), "id", "left_semi"))
    edges = None
    release(docs.sparkSession)
    for turn in range(rounds + 1):
        dealt = cut(_chunked(members, heavy_docs, heavy_shingles))
        if turn == rounds:
            # what is left: every chunk with every other, as groups of two chunks
            other = dealt.select("region", F.col("chunk").alias("c2")).distinct()
            two = dealt.join(other, "region").select("region", "pivot", "node", "chunks", (F.least("chunk", "c2") * F.col("chunks") + F.greatest("chunk", "c2")).alias("chunk")).distinct()
            dealt = two
        found = cut(_join_groups(dealt.join(texts, dealt.node == texts.id).drop("id"), size, percent))
        new = found.filter("b is not null").select("a", "b")
        edges = new if edges is None else cut(edges.unionByName(new))
        heavy = dealt.filter("chunks > 1 and not last").select("region", "node", "n").distinct() if turn < rounds else None
        if heavy is None or heavy.isEmpty():
            break
        comp = components(edges)
        far = found.filter("d is not null").groupBy("region", F.col("a").alias("node")).agg(F.min("d").alias("d"), F.max("d").alias("far"))
        state = heavy.join(far, ["region", "node"]).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
        main = state.groupBy("region", "component").agg(F.count("*").alias("m")).groupBy("region").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
        state = cut(state.join(main, "region").withColumn("other", F.col("component") != F.col("main")))
        # the next pivot: first the member nearest to the last one (near the middle), then one that is left
        candidate = (F.col("d") > 0) if turn == 0 else F.col("other")
        nearest = F.min_by(F.when(candidate, F.col("node")), F.when(candidate, F.struct("d", "node")))
        sums = state.groupBy("region").agg(F.min(F.when(F.col("other"), F.col("d"))).alias("low"), F.count_if("other").alias("m"), F.sum(F.when(F.col("other"), F.col("n")).otherwise(0)).alias("w"), nearest.alias("pivot"))
        sums = cut(sums.filter("m > 0"))
        if sums.isEmpty():
            break
        # few others: they go to every chunk, which compares them with all, and the region is done
        few = (F.col("m") <= heavy_docs) & (F.col("w") <= heavy_shingles)
        radius = 1 - threshold + 1e-9
        left = state.join(sums.select("region", "low", "pivot", few.alias("last")), "region").filter(F.col("other") | (F.col("far") >= F.col("low") - radius) | (F.col("node") == F.col("pivot")))
        members = cut(left.select("region", "pivot", "node", "n", F.when(F.col("last"), F.col("other")).otherwise(F.col("node") == F.col("pivot")).alias("wide"), "last"))
        del dealt, found, new, heavy, comp, far, state, main, sums, left
        release(docs.sparkSession)
    return edges


def link(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, size: int = 5, threshold: float = 0.8, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: the smallest id that the document reaches by links."""
    docs = _texts(df, doc_id, text)
    facts = cut(describe(docs, sketch(docs, size), size, round(threshold * 100)))
    full = facts.filter("n > 0 and id is not null")
    # cut, so that the joins below have plain sides, which adaptive execution can split where a text has many copies
    same = cut(full.groupBy("k1", "k2").agg(F.min("id").alias("node")))
    nodes = full.select(F.col("id").alias("node"), "k1", "k2", "n", "window", "hot").join(same, ["node", "k1", "k2"]).select("node", "n", "window", "hot")
    edges = links(nodes, docs, size=size, threshold=threshold, **how)
    of = cut(facts.select("id", "n", "k1", "k2").join(same, ["k1", "k2"], "left").select("id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")))
    # an id that stands on several texts links their nodes; its blank texts belong with the others
    again = cut(of.filter("id is not null").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("m")).filter("m > 1").select("id", "a", "b"))
    if not again.isEmpty():
        tied = of.join(again.filter("a <> b"), "id").select("a", F.col("node").alias("b")).filter("b is not null")
        edges = edges.unionByName(tied)
        of = of.join(again.select("id", "a"), "id", "left").select("id", "n", F.coalesce("node", "a").alias("node"))
    comp = components(edges)
    out = of.join(comp, "node", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"))
