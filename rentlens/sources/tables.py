"""Readers of CSV seeds, index series, state tables and published versions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a byte-order mark before the first name goes, quoted fields may span lines."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def known_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """(df with only listing columns, names of dropped columns that aren't on the ignore list)."""
    unknown = sorted(set(df.columns) - set(schema.LISTING_COLUMNS) - set(schema.IGNORED_SEED_COLUMNS))
    return df.select(*[c for c in df.columns if c in schema.LISTING_COLUMNS]), unknown


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, month, value, approx) of an index series file; malformed rows have nulls."""
    kind = "values array<struct<month:string,value:string,approx:boolean>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.posexplode("values").alias("ordinal", "v"))
    return rows.select("ordinal", "v.month", "v.value", F.coalesce("v.approx", F.lit(False)).alias("approx"))


def read_state(spark: SparkSession, path: str, active_only: bool = False) -> DataFrame:
    df = spark.read.schema(schema.LISTING).parquet(path)
    return df.filter("status = 'active'") if active_only else df


def point(df: DataFrame, listing: str) -> DataFrame:
    """The row of one id; the filter is pushed to the scan."""
    return df.filter(F.col("id") == listing)


class NotPublished(LookupError):
    """There is no version yet."""


class DamagedPointer(ValueError):
    """The pointer is there, but isn't JSON."""


def stored(spark: SparkSession, path: str) -> bool:
    """Whether path exists. A store that can't be reached raises; it isn't taken for an empty one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_pointer(spark: SparkSession, folder: str) -> dict:
    """The pointer's content; NotPublished only if the file isn't there."""
    path = f"{folder}/latest.json"
    if not stored(spark, path):
        raise NotPublished(folder)
    rows = spark.read.text(path, wholetext=True).collect()
    try:
        return json.loads(rows[0][0])
    except (IndexError, ValueError) as e:
        raise DamagedPointer(path) from e
