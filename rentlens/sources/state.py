"""Generations of the registry's tables: each commit writes a new folder, then moves the pointer."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import schema
from . import sinks, tables

TABLES = {"listings": schema.LISTING, "history": schema.HISTORY, "events": schema.EVENTS, "failures": schema.FAILURES}


def load(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The current generation's tables; empty ones before the first commit."""
    try:
        path = tables.read_pointer(spark, folder)["path"]
        return {name: spark.read.schema(kind).parquet(f"{path}/{name}") for name, kind in TABLES.items()}
    except tables.NotPublished:
        return {name: spark.createDataFrame([], kind) for name, kind in TABLES.items()}


def commit(spark: SparkSession, folder: str, new: dict[str, DataFrame], keep: int = 3) -> int:
    """Write a generation and point to it; readers of the old one are not disturbed. Returns its number.

    Each attempt has a folder of its own, so what a crashed one left is never taken for this one's."""
    try:
        number = tables.read_pointer(spark, folder)["generation"] + 1
    except tables.NotPublished:
        number = 1
    name = f"gen-{number:08d}-{uuid.uuid4().hex[:12]}"
    path = sinks.write_version(folder, name, {t: new[t].select(*[f.name for f in kind]) for t, kind in TABLES.items()}, lambda _: False)
    sinks.write_text(spark, f"{folder}/latest.json", json.dumps({"generation": number, "path": path}))
    sinks.clean_versions(spark, folder, name, keep)
    return number
