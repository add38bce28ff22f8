"""Tree digests of tables: a name for a version's contents, and which ranges of keys two versions differ in.

A row's key falls into one of 16^depth ranges by the first hex digits of its SHA-256. A range's digest covers its row count and four sums of
60-bit pieces of the rows' SHA-256, so rows are added up before the shuffle, in any order, and a range is never gathered; equal rows count as often as they
are there. An inner node's digest covers those of its up to 16 children in order; the root names the table. The result doesn't depend on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH, DIGITS, PIECES = 3, 15, 4


def row_text(columns: list[str]) -> Column:
    """The columns as one text from which they could be read back: lengths and texts, a dash for null."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts])


def leaves(df: DataFrame, key: str, columns: list[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """(prefix, n, digest) of each range that has rows."""
    rows = df.select(F.substring(F.sha2(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), 256), 1, depth).alias("prefix"), F.sha2(row_text(columns or sorted(df.columns)), 256).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", DIGITS * k + 1, DIGITS), 16, 10).cast("decimal(19,0)")).cast("string").alias(f"s{k}") for k in range(PIECES)]
    out = rows.groupBy("prefix").agg(F.count("*").alias("n"), *sums)
    return out.select("prefix", "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[f"s{k}" for k in range(PIECES)]), 256).alias("digest"))


def tree(df: DataFrame, key: str, columns: list[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """(prefix, n, digest) of all nodes; a prefix's length is its level, the root's is empty. An empty table has a root of its own."""
    level = out = leaves(df, key, columns, depth)
    for d in range(depth - 1, -1, -1):
        child = F.struct("prefix", "digest")
        level = level.groupBy(F.substring("prefix", 1, d).alias("prefix")).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(child)).alias("c"))  # at most 16
        level = level.select("prefix", "n", F.sha2(F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["prefix"], x["digest"])), "|"), 256).alias("digest"))
        out = out.unionByName(level)
    none = df.sparkSession.range(1).select(F.lit("").alias("prefix"), F.lit(0).cast("long").alias("n"), F.sha2(F.lit(""), 256).alias("digest"))
    return out.unionByName(none).groupBy("prefix").agg(F.max("n").alias("n"), F.max_by("digest", "n").alias("digest"))


def root(nodes: DataFrame, prefix: int = 16) -> str:
    """The start of the root's digest."""
    return nodes.filter("prefix = ''").first()["digest"][:prefix]


def changed(old: DataFrame, new: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(prefix, n_old, n_new) of the ranges in which two trees differ; below a node that is equal in both nothing is compared."""
    differ = None
    for d in range(depth + 1):
        a, b = (t.filter(F.length("prefix") == d).select("prefix", F.col("n").alias(f"n_{x}"), F.col("digest").alias(x)) for t, x in ((old, "old"), (new, "new")))
        both = a.join(b, "prefix", "full")
        if differ is not None:
            both = both.withColumn("__up", F.substring("prefix", 1, d - 1)).join(differ.select(F.col("prefix").alias("__up")), "__up", "left_semi")
        differ = both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("prefix", F.coalesce("n_old", F.lit(0)).cast("long").alias("n_old"), F.coalesce("n_new", F.lit(0)).cast("long").alias("n_new"))
    return differ
