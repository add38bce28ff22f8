"""Writers: CSV exports, immutable versions, the pointer, retention. Paths go through Hadoop's file systems."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """All columns in order, nulls as empty fields; an empty table still has its header. The old export stays until the new one is whole."""
    cols = columns or [c for c in schema.LISTING_COLUMNS if c in df.columns]
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols])
    tmp = _beside(path)
    out.write.csv(tmp, header=True, emptyValue="", nullValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    replace(df.sparkSession, tmp, path)


def export_changes(df: DataFrame, path: str) -> None:
    """A run's change rows with reason and old_price."""
    export_csv(df, path, [c for c in [*schema.LISTING_COLUMNS, "reason", "old_price"] if c in df.columns])


def _beside(path: str) -> str:
    """A hidden name of its own in the folder of path."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}-{uuid.uuid4().hex}" if folder else f".{name}-{uuid.uuid4().hex}"


def _move(spark: SparkSession, path: str, target: str, over: bool = False) -> None:
    """Rename, over a file that is there if wanted; raises if it can't."""
    jvm = spark._jvm
    fs, to = _fs(spark, path)
    if over and fs.rename(to(path), to(target)):
        return
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE if over else options.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(to(path), to(target), how)


def replace(spark: SparkSession, tmp: str, path: str) -> None:
    """Put the folder tmp in place of path: what is there moves aside first and goes only when tmp stands."""
    fs, to = _fs(spark, path)
    old = None
    if fs.exists(to(path)):
        old = _beside(path)
        _move(spark, path, old)
    _move(spark, tmp, path)
    if old:
        fs.delete(to(old), True)


def backup(spark: SparkSession, path: str, suffix: str = "_before_dedup") -> str:
    """Copy a file or folder beside itself, unless an earlier copy is there; returns the copy's path."""
    stem, dot, end = path.rstrip("/").rpartition(".")
    copy = f"{stem}{suffix}.{end}" if dot and "/" not in end else f"{path.rstrip('/')}{suffix}"
    fs, to = _fs(spark, path)
    if not fs.exists(to(copy)):
        tmp = _beside(copy)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, to(path), fs, to(tmp), False, spark._jsc.hadoopConfiguration())
        _move(spark, tmp, copy)
    return copy


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under a temporary name, then rename over the old file, which stands until then."""
    fs, to = _fs(spark, path)
    tmp = _beside(path)
    out = fs.create(to(tmp), True)
    out.write(bytearray(text.encode()))
    out.close()
    _move(spark, tmp, path, over=True)


def write_version(folder: str, name: str, tables: dict[str, DataFrame], valid: Callable[[str], bool]) -> str:
    """Write the tables under a temporary folder, then rename it to name.

    A folder that has the name already stays if `valid` says so, as names follow from contents; else the new one takes its place."""
    spark = next(iter(tables.values())).sparkSession
    path = f"{folder}/{name}"
    tmp = _beside(path)
    for table, df in tables.items():
        df.write.parquet(f"{tmp}/{table}")
    if exists(spark, path) and valid(path):
        fs, to = _fs(spark, folder)
        fs.delete(to(tmp), True)
    else:
        replace(spark, tmp, path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    fs, to = _fs(spark, path)
    return fs.exists(to(path))


def clean_versions(spark: SparkSession, folder: str, current: str, keep: int = 3) -> list[str]:
    """Delete all but the newest versions, never the current one, and temporary folders older than a day; returns the deleted names."""
    fs, to = _fs(spark, folder)
    found = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(to(folder)) if s.isDirectory()]
    old = [n for _, n in sorted((f for f in found if not f[1].startswith(".")), reverse=True)[keep:] if n != current]
    old += [n for t, n in found if n.startswith(".") and t < (time.time() - 86400) * 1000]
    for n in old:
        fs.delete(to(f"{folder}/{n}"), True)
    return old
