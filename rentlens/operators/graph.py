"""Connected components over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship

#: Edges that one task contracts in memory; a fixed bound on its size.
TASK_EDGES = 1_000_000


def contracted(edges: DataFrame, parts: int) -> DataFrame:
    """Edges (u, v), u > v, with the same components and at most one for each node and part: every node with its part's smallest. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                u, v = find(u), find(v)
                if u != v:
                    root[max(u, v)] = min(u, v)
        pairs = [(x, r) for x in root if (r := find(x)) != x]
        for i in range(0, len(pairs), 1 << 16):
            u, v = zip(*pairs[i : i + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    ship(edges.sparkSession)
    return edges.coalesce(parts).mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component): the smallest node that each node of the edges reaches. Nodes are integers.

    First every task contracts up to task_edges edges by union-find. If that takes one task, it is the answer; else two rules alternate
    until nothing changes: every node's larger neighbours are linked to its smallest one, then its smaller neighbours are. Edges
    never grow in number beyond the input's; a hub's rows are joined, not gathered, and to a written table, as adaptive execution splits hot
    keys in joins of plain shuffles only. Each round is written to the checkpoint folder. Null ends are dropped.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = cut(e.filter("u <> v"))
    parts = max(1, -(-e.count() // task_edges))
    e = cut(contracted(e, parts))
    mark = None if parts > 1 else ()
    for _ in range(most):
        if mark == () or (now := _mark(e)) == mark:
            break
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = cut(both.join(cut(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        e = cut(small.filter("u <> v").distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
