"""Read functions over published versions and the registry. Envelopes are small dicts; rows stay DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history
from ..sources import tables


def _bounded(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be from {low}" + (f" to {high}" if high is not None else ""))


def read_meta(spark: SparkSession, folder: str) -> DataFrame:
    """The current version's meta row; built_at is the pointer's."""
    pointer = tables.read_pointer(spark, folder)
    return spark.read.parquet(f"{pointer['path']}/meta").withColumn("built_at", F.lit(pointer["built_at"]))


def page(df: DataFrame, limit: int = 100, offset: int = 0, order: str = "ordinal") -> DataFrame:
    """Rows offset to offset + limit in stored order, of a table with gapless numbers from 0 on.

    A range of numbers, which reaches the scan: files are written by ranges, so a page opens those that hold it, wherever it lies. Only the page is sorted."""
    _bounded("limit", limit, 1, 500)
    _bounded("offset", offset, 0)
    return df.filter(F.col(order).between(offset, offset + limit - 1)).orderBy(order).limit(limit)


def read_table(spark: SparkSession, folder: str, limit: int = 100, offset: int = 0) -> dict:
    """version, total, limit, offset, returned and the rows as JSON text."""
    pointer = tables.read_pointer(spark, folder)
    df = spark.read.parquet(f"{pointer['path']}/baseline")
    rows = [r for r in page(df, limit, offset).drop("ordinal").toJSON().collect()]
    return {"version": pointer["version"], "total": pointer["row_count"], "limit": limit, "offset": offset, "returned": len(rows), "rows": rows}


def read_price_index(spark: SparkSession, folder: str) -> DataFrame:
    pointer = tables.read_pointer(spark, folder)
    return spark.read.parquet(f"{pointer['path']}/price_index_levels").orderBy("month")


def price_index_envelope(spark: SparkSession, folder: str) -> dict:
    """version, measured, note and the levels by month."""
    meta = read_meta(spark, folder).first()
    levels = [r.asDict() for r in read_price_index(spark, folder).collect()]
    return {"version": meta["version"], "measured": meta["price_index_measured"], "note": meta["price_index_note"], "levels": levels}


def read_changes(events: DataFrame, since: int = 0, limit: int = 200) -> dict:
    """A page of the change feed and the cursor for the next one."""
    rows = [r.asDict() for r in history.changes_page(events, since, limit).collect()]
    return {"since": since, "next_since": rows[-1]["event_id"] if rows else since, "returned": len(rows), "rows": rows}


def read_listing(spark: SparkSession, folder: str, listing: str) -> dict:
    """One row of the current version; KeyError if there is none."""
    pointer = tables.read_pointer(spark, folder)
    row = tables.point(spark.read.parquet(f"{pointer['path']}/baseline"), listing).first()
    if row is None:
        raise KeyError(listing)
    return row.asDict()


#: Seconds after which a version is stale, and that a start may take.
STALE_S, GRACE_S = 4 * 3600, 4 * 3600


def health(has_pointer: Column, age_s: Column, uptime_s: Column, stale_s: int = STALE_S, grace_s: int = GRACE_S) -> Column:
    """Struct (state, code): starting, broken, ok or stale."""
    state = F.when(~has_pointer, F.when(uptime_s > grace_s, "broken").otherwise("starting")).when(age_s > stale_s, "stale").otherwise("ok")
    code = F.when(state.isin("ok", "starting"), 200).otherwise(503)
    return F.struct(state.alias("state"), code.alias("code"))
