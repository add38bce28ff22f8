"""Keyed tables in hash buckets: commits add delta files, readers merge, compaction rewrites the buckets that need it.

    folder/latest.json                             the pointer: generation and manifest
    folder/manifests/gen-...json                   for each table, the generations that each bucket's rows are in, oldest first
    folder/data/<table>/gen=.../bucket=N/*.parquet rows of one commit

A commit writes rows of the keys it changes, and nothing else: its bytes follow the batch, not the table. The row of a key in the newest generation
counts; one marked as gone deletes the key. Readers join the oldest generation of each bucket (its base) against the keys of the later ones, so
base rows are neither sorted nor grouped, and read only the buckets that are asked for. compact() gives buckets with many deltas a new base. Appended
tables (history, events) have no keys to merge: their commits are all read.

Each attempt writes folders of its own and then moves the pointer, so a crash leaves the old generation. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sinks, tables

BUCKETS = 64
GONE, BUCKET, GEN = "__gone", "bucket", "gen"


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def manifest(spark: SparkSession, folder: str) -> dict:
    """The current manifest; an empty one before the first commit."""
    try:
        path = tables.read_pointer(spark, folder)["manifest"]
    except tables.NotPublished:
        return {"generation": 0, "buckets": None, "tables": {}}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _point(spark: SparkSession, folder: str, new: dict) -> int:
    name = f"gen-{new['generation']:08d}-{uuid.uuid4().hex[:12]}"
    path = f"{folder}/manifests/{name}.json"
    sinks.write_text(spark, path, json.dumps(new))
    sinks.write_text(spark, f"{folder}/latest.json", json.dumps({"generation": new["generation"], "manifest": path}))
    return new["generation"]


def _write(folder: str, table: str, gen: str, rows: DataFrame, key: str, buckets: int) -> list[str]:
    """Write rows by bucket; the buckets that got some."""
    spark, path = rows.sparkSession, f"{folder}/data/{table}/{GEN}={gen}"
    rows.withColumn(BUCKET, bucket_of(key, buckets)).repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(path)
    fs, to = sinks._fs(spark, path)
    return sorted(n.split("=")[1] for n in (s.getPath().getName() for s in fs.listStatus(to(path))) if n.startswith(f"{BUCKET}="))


def commit(spark: SparkSession, folder: str, changes: dict[str, DataFrame], gone: dict[str, DataFrame] | None = None, appended: Iterable[str] = (), key: str = "id", buckets: int = BUCKETS, note: int | None = None) -> int:
    """Store the changed rows of each table (one a key), delete the keys of `gone`, add the rows of the appended tables; returns the generation.

    note: a number kept with the generation, such as that of the batch that made it; without one the old generation's stays."""
    old, gone = manifest(spark, folder), gone or {}
    if old["buckets"] not in (None, buckets):
        raise ValueError(f"the store has {old['buckets']} buckets")
    number = old["generation"] + 1
    gen = f"{number:08d}-{uuid.uuid4().hex[:12]}"
    new = {"generation": number, "buckets": buckets, "tables": {t: {b: list(g) for b, g in by.items()} for t, by in old["tables"].items()}}
    if note is not None or "note" in old:
        new["note"] = old.get("note") if note is None else note
    for table in {**changes, **gone}:
        rows = changes[table].withColumn(GONE, F.lit(False)) if table in changes else None
        if table in gone:
            keys = gone[table].select(key).withColumn(GONE, F.lit(True))
            rows = keys if rows is None else rows.unionByName(keys, allowMissingColumns=True)
        rows = rows.drop(GONE) if table in appended else rows
        for b in _write(folder, table, gen, rows, key, buckets):
            new["tables"].setdefault(table, {}).setdefault(b, []).append(gen)
    return _point(spark, folder, new)


def _paths(folder: str, table: str, gens: dict[str, list[str]]) -> list[str]:
    return [f"{folder}/data/{table}/{GEN}={g}/{BUCKET}={b}" for b, gs in gens.items() for g in gs]


def _scan(spark: SparkSession, folder: str, table: str, schema: T.StructType, gens: dict[str, list[str]]) -> DataFrame:
    """Rows of the named generations of buckets, with gen and bucket."""
    kind = T.StructType([*schema, T.StructField(GEN, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    paths = _paths(folder, table, gens)
    return spark.read.schema(kind).option("basePath", f"{folder}/data/{table}").parquet(*paths) if paths else spark.createDataFrame([], kind)


def read(spark: SparkSession, folder: str, table: str, schema: T.StructType, buckets: Iterable[int] | None = None, key: str | None = "id") -> DataFrame:
    """The rows of a table, or of some of its buckets; without a key all that was appended."""
    chosen = None if buckets is None else {str(b) for b in buckets}
    gens = {b: g for b, g in manifest(spark, folder)["tables"].get(table, {}).items() if chosen is None or b in chosen}
    if key is None:
        return _scan(spark, folder, table, schema, gens).drop(GEN, BUCKET)
    marked = T.StructType([*schema, T.StructField(GONE, T.BooleanType())])
    base = _scan(spark, folder, table, marked, {b: g[:1] for b, g in gens.items()}).drop(GEN, BUCKET)
    if any(len(g) > 1 for g in gens.values()):
        later = _scan(spark, folder, table, marked, {b: g[1:] for b, g in gens.items()})
        last = later.groupBy(key).agg(F.max_by(F.struct(*[c for c in marked.names if c != key]), GEN).alias("r")).select(key, "r.*").select(marked.names)
        base = base.join(later.select(key).distinct(), key, "left_anti").select(marked.names).unionByName(last)
    return base.filter(~F.col(GONE)).drop(GONE)


def point(spark: SparkSession, folder: str, table: str, schema: T.StructType, value: str, key: str = "id") -> DataFrame:
    """The row of one key: only its bucket's files are opened."""
    n = manifest(spark, folder)["buckets"] or 1
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(schema[key].dataType)), F.lit(n)).cast("int")).first()[0]
    return read(spark, folder, table, schema, [bucket], key).filter(F.col(key) == value)


def compact(spark: SparkSession, folder: str, table: str, schema: T.StructType, most_deltas: int = 4, key: str = "id") -> list[int]:
    """Rewrite the buckets with more than most_deltas deltas as one base each; returns them. The rows stay the same."""
    old = manifest(spark, folder)
    many = sorted(int(b) for b, g in old["tables"].get(table, {}).items() if len(g) > most_deltas + 1)
    if not many:
        return []
    number = old["generation"] + 1
    gen = f"{number:08d}-{uuid.uuid4().hex[:12]}"
    rows = read(spark, folder, table, schema, many, key).withColumn(GONE, F.lit(False))
    written = set(_write(folder, table, gen, rows, key, old["buckets"]))
    by = {b: g for b, g in old["tables"][table].items() if int(b) not in many} | {str(b): [gen] for b in many if str(b) in written}
    _point(spark, folder, {**old, "generation": number, "tables": {**old["tables"], table: by}})
    return many


def vacuum(spark: SparkSession, folder: str, keep: int = 3) -> list[str]:
    """Delete all manifests but the newest `keep`, and the generations that none of those names; returns the deleted folders."""
    fs, to = sinks._fs(spark, folder)
    current = tables.read_pointer(spark, folder)["manifest"].rpartition("/")[2]
    found = sorted((s.getPath().getName() for s in fs.listStatus(to(f"{folder}/manifests"))), reverse=True)
    kept = {current, *[n for n in found if n <= current and n.endswith(".json")][:keep]}
    used = {(t, g) for n in kept for t, by in json.loads(spark.read.text(f"{folder}/manifests/{n}", wholetext=True).first()[0])["tables"].items() for gs in by.values() for g in gs}
    gone = []
    for t in [s.getPath().getName() for s in fs.listStatus(to(f"{folder}/data"))]:
        for s in fs.listStatus(to(f"{folder}/data/{t}")):
            if (t, s.getPath().getName().partition("=")[2]) not in used:
                fs.delete(s.getPath(), True)
                gone.append(f"{t}/{s.getPath().getName()}")
    for n in set(found) - kept:
        fs.delete(to(f"{folder}/manifests/{n}"), False)
    return gone


def changed(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """The rows of new that old doesn't have like that: one join on the key."""
    rest = [c for c in new.columns if c != key]
    before = old.select(F.col(key).alias("__key"), F.struct(*rest).alias("__row"))
    return new.join(before, F.col(key) == F.col("__key"), "left").filter(F.col("__key").isNull() | ~F.struct(*rest).eqNullSafe(F.col("__row"))).select(new.columns)
