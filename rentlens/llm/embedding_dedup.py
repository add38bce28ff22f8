"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) come from a bounded sample, the distinct vectors first in hash order: four times the square root of the number of
vectors (LEAST_PIVOTS to MOST_PIVOTS, and PIVOT_BYTES at most, as they are broadcast), each at a cosine below SPREAD to those before it, so that a group of near copies gives one pivot, however
large it is. A vector is described by its `near` nearest pivots, in a global order with the rarest first. Two vectors are candidates if they share at
least `shared` of them; then one of the first near - shared + 1 of each is common, so each vector is filed in the inverted lists (label, pivot)
of those only.

1. Lists hold ids and permutations, no vectors. Shared-pivot counts of a list are a product of incidence matrices. A pair counts only in
   the list of its first common pivot, so no pair counts twice. Only members with a candidate stay.
2. These get their vectors and meet again in their lists, where cosines in double precision verify the candidates. No pair is emitted: a list gives
   each vector's number of links and the components within the list.

With pivots that grow like the square root, so do lists. Lists longer than `most` are filed again by pairs of pivots (the first two in common); what is
still longer is cut into blocks of `most`, each compared with each. There is no cap on candidates.

Equal vectors of a label are one class with a count, so copies never meet. Null labels, null, zero or non-finite vectors or
components, and null ids (component null) link with nothing. Vectors of different lengths never link; each length has its own index. Rows that
repeat an id and a vector count as copies of each other. An empty table gives an empty result. Only the columns named are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import cut

LEAST_PIVOTS, MOST_PIVOTS, SPREAD = 256, 1 << 16, 0.9
#: Bytes of all pivots, and cosines that a task holds at once.
PIVOT_BYTES, COSINES = 64 << 20, 1 << 22
#: Bits of a pivot's number in a list's key.
BITS = 16
GROUP = ["label_hash", "key", "c1", "c2"]


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: pa.Array, dim: int) -> np.ndarray:
    v = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _spread(sample: np.ndarray, most: int, block: int = 256) -> np.ndarray:
    """Up to `most` of the sample's vectors, in order, that are not close to one taken before."""
    taken = np.zeros((0, sample.shape[1]))
    for i in range(0, len(sample), block):
        new = sample[i : i + block]
        new = new[(new @ taken.T).max(axis=1, initial=-1) < SPREAD]
        far, kept = new @ new.T < SPREAD, []
        for j in range(len(new)):
            if far[j, kept].all():
                kept.append(j)
        taken = np.vstack((taken, new[kept]))
        if len(taken) >= most:
            return taken[:most]
    return taken


def _nearest(classes: DataFrame, pivots: np.ndarray, near: int) -> DataFrame:
    """(label_hash, node, n, top): the numbers of the nearest pivots as 16-bit binary."""
    sent, dim = classes.sparkSession.sparkContext.broadcast(pivots), pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, COSINES // len(sent.value))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            if batch.num_rows:
                close = _units(batch.column(3), dim) @ sent.value.T
                top = np.argpartition(-close, near - 1, axis=1)[:, :near] if near < close.shape[1] else np.tile(np.arange(close.shape[1]), (len(close), 1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([r.tobytes() for r in top.astype("<u2")], pa.binary())], ["label_hash", "node", "n", "top"])

    return classes.select("label_hash", "node", "n", "v").mapInArrow(run, "label_hash long, node long, n long, top binary")


def _rows(column: pa.Array, near: int) -> np.ndarray:
    """Binary rows of 16-bit numbers as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, near)


def _counted(table: DataFrame, pivots: int, near: int) -> np.ndarray:
    """How many vectors have each pivot among their nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pivots, np.int64)
        for batch in batches:
            total += np.bincount(_rows(batch.column(0), near).ravel(), minlength=pivots)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(pivots)), pa.array(total)], ["p", "n"])

    out = np.zeros(pivots, np.int64)
    for r in table.select("top").mapInArrow(run, "p long, n long").groupBy("p").agg(F.sum("n").alias("n")).collect():
        out[r["p"]] = r["n"]
    return out


def _filed(table: DataFrame, order: np.ndarray, near: int, depth: int, first: int) -> DataFrame:
    """A row (label_hash, key, node, n, ranks) for each list of `depth` pivots; ranks are in the global order."""
    sent = table.sparkSession.sparkContext.broadcast(order)
    chosen = np.array(list(combinations(range(min(first, near)), depth)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = np.sort(sent.value[_rows(batch.column(3), near)], axis=1)
            keys = np.zeros((len(ranks), len(chosen)), np.int64)
            for j in range(depth):
                keys = keys << BITS | ranks[:, chosen[:, j]]
            row = pa.array(np.repeat(np.arange(len(ranks)), len(chosen)))
            packed = pa.array([r.tobytes() for r in ranks.astype("<u2")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(keys.ravel()), batch.column(1).take(row), batch.column(2).take(row), packed.take(row)], ["label_hash", "key", "node", "n", "ranks"])

    return table.select("label_hash", "node", "n", "top").mapInArrow(run, "label_hash long, key long, node long, n long, ranks binary")


def _blocks(lists: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Lists with c1, c2, chunk: one group if a list is short, else one for each two chunks."""
    chunks = F.ceil(F.col("size") / most).cast("int")
    sized = lists.join(sizes.select("label_hash", "key", chunks.alias("chunks")), ["label_hash", "key"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    return sized.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"c1": F.least("chunk", "o"), "c2": F.greatest("chunk", "o")}).drop("o", "chunks")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """The rows of each group (the first columns, GROUP, sorted), across batches."""
    held, key = [], None
    for batch in batches:
        ids = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(GROUP))])
        starts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                now = tuple(ids[a].tolist())
                if now != key:
                    if held:
                        yield key, pa.Table.from_batches(held).combine_chunks()
                    held, key = [], now
                held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held).combine_chunks()


def _candidates(group: tuple[int, ...], ranks: np.ndarray, chunk: np.ndarray, depth: int, shared: int) -> np.ndarray:
    """Which pairs of a list share enough pivots and have its key as the first in common."""
    numbers, at = np.unique(ranks, return_inverse=True)
    near = np.zeros((len(ranks), len(numbers)), np.float32)
    np.put_along_axis(near, at.reshape(ranks.shape), 1, axis=1)
    ok = near @ near.T >= shared
    for j in range(depth):
        before = near[:, numbers < (group[1] >> BITS * (depth - 1 - j) & (1 << BITS) - 1)]
        ok &= np.abs(before @ before.T - j) < 0.5
    if group[2] != group[3]:
        ok &= chunk[:, None] != chunk[None, :]
    np.fill_diagonal(ok, False)
    return ok


def _labels(links: np.ndarray) -> np.ndarray:
    """Smallest index that each row of a symmetric matrix reaches."""
    label = np.arange(len(links))
    while True:
        low = np.minimum(label, np.where(links, label[None, :], len(label)).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _met(blocks: DataFrame, near: int, depth: int, shared: int) -> DataFrame:
    """The members of each group that have a candidate in it."""
    names = [*GROUP, "chunk", "node", "n", "ranks"]
    kinds = "label_hash long, key long, c1 int, c2 int, chunk int, node long, n long, ranks binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for group, rows in _groups(batches):
            if len(rows) > 1:
                some = _candidates(group, _rows(rows["ranks"], near), rows["chunk"].to_numpy(), depth, shared).any(axis=1)
                if some.any():
                    held.append(rows.filter(pa.array(some)))
            if sum(map(len, held)) >= 4096:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return blocks.repartition(*GROUP).sortWithinPartitions(*GROUP).select(names).mapInArrow(run, kinds)


def _verified(met: DataFrame, vectors: DataFrame, dim: int, near: int, depth: int, shared: int, threshold: float) -> DataFrame:
    """(node, links, root): the links of each group's candidates, by their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _groups(batches):
            order = np.argsort(rows["node"].to_numpy(), kind="stable")
            rows = rows.take(order).combine_chunks()
            nodes, n, units = rows["node"].to_numpy(), rows["n"].to_numpy(), _units(rows["v"].combine_chunks(), dim)
            ok = _candidates(group, _rows(rows["ranks"], near), rows["chunk"].to_numpy(), depth, shared)
            a, b = np.nonzero(np.triu(ok))
            if len(a) * 8 > len(nodes) ** 2:
                links = ok & (units @ units.T >= threshold)
            else:
                good = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                links = np.zeros_like(ok)
                links[a[good], b[good]] = links[b[good], a[good]] = True
            some = np.flatnonzero(links.any(axis=1))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some] @ n), pa.array(nodes[_labels(links)[some]])], ["node", "links", "root"])

    full = met.join(vectors, "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    return full.select(*GROUP, "chunk", "node", "n", "ranks", "v").mapInArrow(run, "node long, links long, root long")


def link(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *, threshold: float = 0.98, n_pivots: int | None = None, near: int = 12, shared: int = 4, most: int = 1024, deepest: int = 2) -> DataFrame:
    """A row for each row of df: vec_id, n_links, component_id, kept. n_pivots overrides the number that follows from the table's size."""
    usable = _usable(F.col(vector)) & F.col(label).isNotNull() & F.col(vec_id).isNotNull()
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"), usable.alias("ok"))
    key = [F.when(F.col("ok"), F.xxhash64(F.lit(seed), "label", "v")).alias(name) for seed, name in ((1, "h1"), (2, "h2"))]
    keyed = rows.withColumn("h1", key[0]).withColumn("h2", key[1])
    same = keyed.filter("ok").groupBy("h1", "h2").agg(F.min("id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = cut(same.select("h1", "h2", "node", "n", F.xxhash64("label").alias("label_hash"), "v"))
    found = None
    for dim, n in sorted(map(tuple, classes.groupBy(F.size("v")).count().collect())):
        pivots = n_pivots or min(MOST_PIVOTS, max(1, PIVOT_BYTES // (8 * dim)), max(LEAST_PIVOTS, 4 * int(n**0.5)))
        part = _join(classes.filter(F.size("v") == dim), dim, threshold, pivots, near, shared, most, deepest)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return keyed.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = cut(found)
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("h1", "h2", "node", "n").join(sums, "node", "left").join(comp, "node", "left")
    out = keyed.select("id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.coalesce("component", "node", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )


def _join(classes: DataFrame, dim: int, threshold: float, n_pivots: int, near: int, shared: int, most: int, deepest: int) -> DataFrame:
    """(node, links, root) parts over the classes of one vector length."""
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(2 * n_pivots).select("v").collect()
    found = np.array([r["v"] for r in sample], np.float64)
    found = found / np.abs(found).max(axis=1, keepdims=True)
    pivots = _spread(found / np.linalg.norm(found, axis=1, keepdims=True), n_pivots)
    near = min(near, len(pivots))
    shared = min(shared, near)
    table = cut(_nearest(classes, pivots, near))
    counts = _counted(table, len(pivots), near)
    order = np.empty(len(pivots), np.int64)
    order[np.lexsort((np.arange(len(pivots)), counts))] = np.arange(len(pivots))
    vectors = classes.select("node", "v")
    out, large = None, None
    for depth in range(1, min(deepest, shared) + 1):
        lists = _filed(table, order, near, depth, near - shared + depth)
        if large is not None:
            lists = lists.withColumn("up", F.shiftright("key", BITS)).join(large.withColumnRenamed("key", "up"), ["label_hash", "up"], "left_semi").drop("up")
        sizes = cut(lists.groupBy("label_hash", "key").agg(F.count("*").alias("size")).filter("size > 1"))
        last = depth == min(deepest, shared)
        now = sizes if last else sizes.filter(F.col("size") <= most)
        part = _verified(_met(_blocks(lists, now, most), near, depth, shared), vectors, dim, near, depth, shared, threshold)
        out = part if out is None else out.unionByName(part)
        large = sizes.filter(F.col("size") > most).select("label_hash", "key")
        if last or large.isEmpty():
            return out
    return out
