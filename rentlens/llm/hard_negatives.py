"""Hard-negative mining by a sort of each anchor's scores.

Components are scaled and floored to integers, so scores are exact inner products and equal everywhere. An anchor's positives are its best
rows of the same label; for each positive, the best rows of another label are wanted whose score lies between `lower` and `upper` hundredths of
the positive's. For that the scores of an anchor are sorted (higher first, then by id), the upper limit of each positive is found by
binary search, and the rows of other labels are read on from there, down to the lower limit.

Anchors are a stated set of queries against all rows, and both are dealt into blocks by a hash of the id, of about ELEMENTS components
each, so that a group (one block of rows, one of anchors) has a fixed size whatever the table, a label or a key holds. Every row goes to
each block of anchors, every anchor to each block of rows; blocks of rows are small where the table is, so that all cores work. What a
group finds is a superset of what it can add to the result (its own first few rows), and a window with a group limit takes the first few
of all blocks. Two passes: positives first, then their limits travel with the anchors.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows that repeat an id one counts, that with the
smallest label, then vector. Vectors are compared with those of their own length. An anchor without a positive, or a positive without a
negative, has no row in the result; ties go to the smaller id; an empty table gives an empty result. Scores must stay below 2^56 (components
of about 10^5 before scaling), or an error names the limit. Only the columns named are read, so others may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Components in a block of rows or anchors, rows in the smallest block, scores that are held at once.
ELEMENTS, LEAST_ROWS, SCORES = 1 << 22, 256, 1 << 21
GROUP = ["dim", "row_block", "anchor_block"]
POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = f"{POSITIVE}, negative_id long, negative_score long"


def _quantised(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(-1, dim) if dim else np.zeros((len(vectors), 0))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of each two rows of whole numbers."""
    most = max((float(np.abs(x).max()) for x in (a, b) if x.size), default=0.0)
    bound = most * most * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if bound >= 2.0**56:
        raise OverflowError("scores must stay below 2^56: the components are too large")
    return a.astype(np.int64) @ b.astype(np.int64).T


class _Block:
    """The anchors and the rows (by id) of a group."""

    def __init__(self, dim: int, table: pa.Table, scale: int):
        table = table.combine_chunks()
        is_anchor = table["is_anchor"].to_numpy(zero_copy_only=False).astype(bool)
        ids, labels = (table[c].to_numpy() for c in ("id", "label"))
        vectors = _quantised(table["v"].combine_chunks(), dim, scale)
        at = np.flatnonzero(~is_anchor)
        at = at[np.argsort(ids[at], kind="stable")]
        self.anchors = np.flatnonzero(is_anchor)
        self.anchor_ids, self.anchor_labels, self.anchor_vectors = ids[self.anchors], labels[self.anchors], vectors[self.anchors]
        self.ids, self.labels, self.vectors = ids[at], labels[at], vectors[at]


def _positives(block: _Block, k: int) -> tuple[np.ndarray, ...]:
    """(anchors, ids, scores) of the first k other rows of each anchor's label."""
    out: list[tuple[np.ndarray, ...]] = []
    for label in np.unique(block.anchor_labels):
        mine, rows = np.flatnonzero(block.anchor_labels == label), np.flatnonzero(block.labels == label)
        step = max(1, SCORES // max(1, len(rows)))
        for part in (mine[i : i + step] for i in range(0, len(mine), step)):
            scores = _scores(block.anchor_vectors[part], block.vectors[rows])
            # rows are in the order of their ids, so a stable sort by score is one by score and id
            first = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
            who = np.repeat(part, first.shape[1])
            ids, found = block.ids[rows][first.ravel()], np.take_along_axis(scores, first, 1).ravel()
            other = ids != block.anchor_ids[who]
            out.append((block.anchor_ids[who[other]], ids[other], found[other]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _negatives(block: _Block, limits: list[list[dict]], k: int, lower: int, upper: int) -> tuple[np.ndarray, ...]:
    """(anchors, positives, their scores, ids, scores): for each positive the first k rows of other labels within its limits."""
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, SCORES // max(1, len(block.ids)))
    for start in range(0, len(block.anchors), step):
        scores = _scores(block.anchor_vectors[start : start + step], block.vectors)
        order = np.argsort(-scores, axis=1, kind="stable")
        for a, ranked, row in zip(range(start, start + len(scores)), order, scores):
            other = ranked[block.labels[ranked] != block.anchor_labels[a]]
            down = -100 * row[other]  # ascending
            for p in limits[a]:
                first = np.searchsorted(down, -upper * p["score"], "left")
                last = min(first + k, np.searchsorted(down, -lower * p["score"], "right"))
                if last > first:
                    taken = other[first:last]
                    same = np.ones(len(taken), np.int64)
                    out.append((same * block.anchor_ids[a], same * p["id"], same * p["score"], block.ids[taken], row[taken]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 5


def _usable(vector: Column) -> Column:
    return F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def _dealt(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """Rows and anchors (with their positives, if they have them) in groups of one block each."""

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dim = F.size("v").alias("dim")
    left = rows.select(dim, block(row_blocks).alias("row_block"), each(anchor_blocks).alias("anchor_block"), F.lit(False).alias("is_anchor"), "id", "label", "v", F.lit(None).cast("array<struct<id:long,score:long>>").alias("limits"))
    right = anchors.select(dim, each(row_blocks).alias("row_block"), block(anchor_blocks).alias("anchor_block"), F.lit(True).alias("is_anchor"), "id", "label", "v", "limits")
    # as many partitions as groups, so that adaptive execution doesn't join small groups that compute much
    return left.unionByName(right).repartition(min(row_blocks * anchor_blocks, 1 << 16), *GROUP).groupBy(*GROUP)


def mine(
    df: DataFrame, anchor: Column, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 5, lower: int = 80, upper: int = 100, scale: int = 256, elements: int = ELEMENTS, least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchor is a condition on df's columns, ids and labels are whole numbers."""
    v = F.col(f"`{vector}`")
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("chosen"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v")))
    by_id = rows.select("id", "chosen", F.size("v").alias("e")).groupBy("id").agg(F.count("*").alias("c"), F.sum("e").alias("e"), F.max("chosen").alias("chosen"))
    size = by_id.agg(F.count("*").alias("n"), F.max("c").alias("most"), F.sum("e").alias("e"), F.sum(F.when(F.col("chosen"), F.col("e"))).alias("ae")).first()
    if (size["most"] or 0) > 1:
        rows = cut(rows.groupBy("id").agg(F.min(F.struct("label", "v", "chosen")).alias("r")).select("id", "r.label", "r.v", "r.chosen"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(1, -(-(size["e"] or 0) // elements), min(4 * parts, size["n"] // least_rows))
    anchor_blocks = max(1, -(-(size["ae"] or 0) // elements))
    chosen = rows.filter("chosen").withColumn("limits", F.lit(None).cast("array<struct<id:long,score:long>>"))

    def positive(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table(_positives(_Block(key[0].as_py(), table, scale), positives), names=["anchor_id", "positive_id", "positive_score"])

    def negative(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(key[0].as_py(), table, scale)
        limits = table["limits"].combine_chunks().take(pa.array(block.anchors)).to_pylist()
        return pa.table(_negatives(block, limits, negatives, lower, upper), names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = _dealt(rows, chosen, row_blocks, anchor_blocks).applyInArrow(positive, POSITIVE).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= positives)
    limits = cut(found.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("limits")))
    limited = chosen.drop("limits").join(limits.withColumnRenamed("anchor_id", "id"), "id")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    out = _dealt(rows, limited, row_blocks, anchor_blocks).applyInArrow(negative, NEGATIVE).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
