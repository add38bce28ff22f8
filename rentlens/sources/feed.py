"""The change feed as a sorted log, and a data source that reads it from a cursor on, in batches and as a stream.

    folder/data/<append>/part-*.parquet   events sorted by event_id, gapless; each file holds a range of numbers
    folder/index.json                     path, first and last number of each file

spark.read.format("change_feed").option("path", folder).option("since", 1200).load()   # also readStream

The offset is the number of the last event that was read. Partitions are the files whose range meets the wanted one; others aren't opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .. import schema
from ..operators import segments
from ..session import ship
from . import sinks, tables

COLUMNS = [f.name for f in schema.EVENTS]


def index(spark: SparkSession, folder: str) -> dict:
    """The log's index as Spark reads it; an empty one for a new log."""
    path = f"{folder}/index.json"
    if not tables.stored(spark, path):
        return {"last": 0, "files": []}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def append(events: DataFrame, folder: str, order: list[Column | str]) -> int:
    """Number the events after those of the log, in the given order, and add them; returns the last number. One writer at a time.

    Files come first, then the index that names them, so a crash in between adds nothing."""
    spark = events.sparkSession
    old = index(spark, folder)
    path = f"{folder}/data/{uuid.uuid4().hex}"
    numbered = segments.numbered(events, order, "event_id", old["last"] + 1).select(*[F.col(f.name).cast(f.dataType) for f in schema.EVENTS])
    numbered.write.parquet(path)
    bounds = spark.read.schema(schema.EVENTS).parquet(path).groupBy(F.input_file_name().alias("path")).agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    files = sorted((r.asDict() for r in bounds.collect()), key=lambda f: f["first"])  # a row a file
    new = {"last": files[-1]["last"] if files else old["last"], "files": [*old["files"], *files]}
    sinks.write_text(spark, f"{folder}/index.json", json.dumps(new))
    return new["last"]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


@dataclass
class Range(InputPartition):
    """Events after `after`, up to `last`, of one file."""

    path: str
    after: int
    last: int


class _Log:
    def __init__(self, options: dict):
        self.folder, self.since = options["path"].rstrip("/"), int(options.get("since", 0))

    def files(self) -> dict:
        system, path = _opened(f"{self.folder}/index.json")
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return {"last": 0, "files": []}
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def ranges(self, after: int, last: int) -> list[Range]:
        return [Range(f["path"], after, last) for f in self.files()["files"] if f["last"] > after and f["first"] <= last]

    def rows(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, path = _opened(part.path)
        with system.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(8192, columns=COLUMNS):
                at = batch.column("event_id")
                batch = batch.filter(pc.and_(pc.greater(at, part.after), pc.less_equal(at, part.last)))
                if batch.num_rows:
                    yield batch


class BatchReader(DataSourceReader, _Log):
    def __init__(self, options: dict):
        _Log.__init__(self, options)

    def partitions(self) -> list[Range]:
        return self.ranges(self.since, self.files()["last"]) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.rows(partition) if partition.path else iter(())


class StreamReader(DataSourceStreamReader, _Log):
    def __init__(self, options: dict):
        _Log.__init__(self, options)

    def initialOffset(self) -> dict:
        return {"event_id": self.since}

    def latestOffset(self) -> dict:
        return {"event_id": max(self.since, self.files()["last"])}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.ranges(start["event_id"], end["event_id"])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.rows(partition)


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.EVENTS)

    def reader(self, schema) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    ship(spark)
    spark.dataSource.register(ChangeFeed)


def read(spark: SparkSession, folder: str, since: int = 0) -> DataFrame:
    register(spark)
    return spark.read.format("change_feed").option("path", folder).option("since", since).load()


def read_stream(spark: SparkSession, folder: str, since: int = 0) -> DataFrame:
    register(spark)
    return spark.readStream.format("change_feed").option("path", folder).option("since", since).load()
