"""Build and publish a version: filter, dedupe, guard, hash, write, point, clean."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import digest, monthly_index, quality, resolve, segments
from ..session import cut
from ..sources import sinks, tables


class Refused(RuntimeError):
    """A guard stopped the publication."""


def version_hash(df: DataFrame, prefix: int = 16) -> DataFrame:
    """One row: version, the start of a SHA-256 over id:price:area in id order.

    The hash needs one ordered text, so it is built in two steps: ranges of ids are joined into texts in parallel, then the texts in order.
    The text must fit one task: about 30 bytes a row. For more than some ten million rows use content_hash."""
    area = F.col("square_m2").cast("double").cast("string")
    line = F.concat_ws(":", "id", F.coalesce(F.col("price").cast("string"), F.lit("None")), F.coalesce(area, F.lit("None")))
    lines = df.select("id", line.alias("line")).repartitionByRange("id").withColumn("part", F.spark_partition_id())
    parts = lines.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), "|").alias("text"))
    whole = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "|").alias("text"))
    return whole.select(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, prefix).alias("version"))


def content_hash(df: DataFrame, prefix: int = 16) -> DataFrame:
    """One row: version, from sums of 64-bit row hashes over all columns in name order: no order, no long text, so it scales with the rows.

    Unlike version_hash it changes with any column."""
    cols = sorted(df.columns)
    sums = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return df.agg(F.concat_ws(":", F.count("*").cast("string"), *[F.coalesce(x, F.lit("0")) for x in sums]).alias("text")).select(F.substring(F.sha2("text", 256), 1, prefix).alias("version"))


def guard(n: int, previous: int | None, least: int = 10, shrink: float = 0.25, from_rows: int = 100) -> None:
    """Refuse tiny versions, and ones much smaller than a sizeable previous one."""
    if n < least:
        raise Refused(f"{n} rows, at least {least} are needed")
    if previous is not None and previous >= from_rows and n < previous * (1 - shrink):
        raise Refused(f"{n} rows after {previous}")


def is_valid(spark, path: str) -> bool:
    """Whether a version has its four tables, one meta row, and as many rows as that says."""
    if not sinks.exists(spark, path):
        return False
    try:
        meta = spark.read.parquet(f"{path}/meta").collect()
        for other in ("price_index_levels", "digest"):
            spark.read.parquet(f"{path}/{other}").schema  # noqa: B018
        return len(meta) == 1 and spark.read.parquet(f"{path}/baseline").agg(F.count(F.hash("*"))).first()[0] == meta[0]["row_count"]
    except Exception:  # whatever can't be read whole is written anew
        return False


def curate(listings: DataFrame, bounds: quality.Bounds = quality.Bounds(), text_threshold: float = resolve.TEXT_THRESHOLD, max_block: int = resolve.MAX_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows for a version, statistics of the dedupe)."""
    return resolve.dedupe(quality.accepted(listings, bounds), text_threshold, max_block)


def build(listings: DataFrame, series: DataFrame, folder: str, now: str, *, bounds: quality.Bounds = quality.Bounds(), keep: int = 3, ordered_hash: bool = False) -> dict:
    """Publish the current listings; returns the new pointer.

    The source is read once: rows and reasons are counted while the good ones are written for what follows, kept rows while they are. A version is named by the root of
    its rows' digest tree, which is stored with it, so that two versions tell which ranges of ids differ; ordered_hash names it by version_hash instead, for tables
    of some million rows at most. Rows are numbered from 0 in the order of their ids, without gaps."""
    spark, source, written = listings.sparkSession, Observation("source"), Observation("kept")
    counted = quality.reject(listings, bounds).observe(source, F.count(F.lit(1)).alias("source_active"), F.count("reason").alias("source_filtered"))
    good = cut(counted.filter("reason is null").drop("reason"))
    kept, stats = resolve.dedupe(good)
    kept = cut(kept.observe(written, F.count(F.lit(1)).alias("n")))
    n = written.get["n"]
    try:
        previous = tables.read_pointer(spark, folder)["row_count"]
    except tables.NotPublished:
        previous = None
    guard(n, previous)
    nodes = cut(digest.tree(kept, "id"))
    version = version_hash(kept).first()["version"] if ordered_hash else digest.root(nodes)
    levels = monthly_index.levels(series)
    path = f"{folder}/{version}"
    if not is_valid(spark, path):
        points = levels.agg(F.count("*").alias("points"))
        meta = stats.join(F.broadcast(points)).select(
            F.lit(version).alias("version"), F.lit(now).alias("built_at"), *[F.lit(x).cast("long").alias(c) for c, x in (("row_count", n), *sorted(source.get.items()))], F.col("groups").alias("groups_deduped"),
            (F.col("points") > 0).alias("price_index_measured"), F.concat(F.col("points").cast("string"), F.lit(" points")).alias("price_index_note"),
        )
        stored = {"baseline": segments.numbered(kept, ["id"], "ordinal"), "meta": meta, "price_index_levels": levels, "digest": nodes}
        sinks.write_version(folder, version, stored, lambda p: is_valid(spark, p))
    pointer = {"version": version, "path": path, "built_at": now, "row_count": n}
    sinks.write_text(spark, f"{folder}/latest.json", json.dumps(pointer))
    sinks.clean_versions(spark, folder, version, keep)
    return pointer


def changed_ranges(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(prefix, n_old, n_new) of the ranges of ids in which two versions, given by their folders, differ."""
    return digest.changed(spark.read.parquet(f"{old}/digest"), spark.read.parquet(f"{new}/digest"))
