"""Streaming forms: keyed price changes, sinks that store a key once, sightings with timers, and the change feed after a cursor."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import history
from ..operators.registry import GRACE_S
from ..operators.segments import MOST_ROWS
from ..session import cut, ship
from ..sources import keyed

CHANGES = "id string, kind string, price double, old_price double, observed_at timestamp, seq long"


def price_changes(observations: DataFrame) -> DataFrame:
    """Start and change points of a stream (id, price, observed_at, seq): the last price of each id is the state.

    Rows of a batch are taken by (observed_at, seq), and those of one id are held at once; batches must come in that order too. Where one id can hold a large
    part of a batch, take stored_changes, which deals a hot id's rows to many tasks."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat([b[["price", "observed_at", "seq"]].dropna(subset="price") for b in batches]).sort_values(["observed_at", "seq"])
        out = []
        for price, at, seq in zip(rows["price"], rows["observed_at"], rows["seq"]):
            if last is not None and abs(price - last) <= 0.01:
                continue
            out.append((key[0], "start" if last is None else "drop" if price < last else "rise", price, last, at, seq))
            last = float(price)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(out, columns=["id", "kind", "price", "old_price", "observed_at", "seq"])

    ship(observations.sparkSession)
    return observations.groupBy("id").applyInPandasWithState(step, CHANGES, "last double", "append", GroupStateTimeout.NoTimeout)


def stored_changes(folder: str, *, buckets: int = keyed.BUCKETS, most: int = MOST_ROWS):
    """A foreachBatch function over observations (id, price, observed_at, seq) that stores their change points, and each id's last price for the next batch.

    Built-in functions only: a batch is compressed by windows behind the stored last prices, a hot id's rows in segments. Points, last prices and the batch's
    number are one commit of a bucketed store, so a batch that is replayed adds nothing. Read the points with read_changes."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = keyed.manifest(spark, folder).get("note", -1)
        if number <= done:
            return
        kinds = {c: batch.schema[c].dataType.simpleString() for c in ("id", "price", "observed_at", "seq")}
        rows = cut(batch.select(*kinds).filter("price is not null"))
        last = keyed.read(spark, folder, "last", spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in kinds.items())).schema)
        known = last.join(rows.select("id").distinct(), "id", "left_semi")
        both = known.withColumn("known", F.lit(0)).unionByName(rows.withColumn("known", F.lit(1)))
        points = history.compress(both, order=("known", "observed_at", "seq"), most=most).filter("known = 1").drop("known")
        now = rows.groupBy("id").agg(F.max_by(F.struct("price", "observed_at", "seq"), F.struct("observed_at", "seq")).alias("r")).select("id", "r.*")
        keyed.commit(spark, folder, {"points": points, "last": now}, appended=("points",), buckets=buckets, note=number)
        keyed.compact(spark, folder, "last", now.schema, 8)

    return write


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The points that stored_changes stored."""
    return keyed.read(spark, folder, "points", spark.createDataFrame([], CHANGES).schema, key=None)


def append_once(path: str, keys: list[str]):
    """A foreachBatch function that stores each batch in a folder of its own, batch_id=N under path, overwritten if the batch is replayed.

    So a replay adds nothing and no batch reads what others stored. Rows that repeat their keys within a batch count once; for keys that come again in later
    batches see append_new. Read the store with spark.read.parquet(path): batch_id becomes a column."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return write


def append_new(path: str, keys: list[str], buckets: int = 64):
    """A foreachBatch function that stores rows whose keys no earlier batch stored: the first batch that has a key wins, forever.

    Rows lie in batch_id=N/bucket=B under path, by a hash of their keys; a batch reads the keys of the buckets that it touches, of earlier batches only, so a
    replay finds what the first try found and overwrites it. Null keys are keys."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = cut(batch.dropDuplicates(keys).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        if number and (touched := [r[0] for r in rows.select("bucket").distinct().collect()]):  # as many as there are buckets at most
            kinds = spark.createDataFrame([], rows.schema).withColumn("batch_id", F.lit(0).cast("long")).schema
            earlier = spark.read.schema(kinds).parquet(path) if keyed.tables.stored(spark, path) else spark.createDataFrame([], kinds)
            seen = earlier.filter((F.col("batch_id") < number) & F.col("bucket").isin(touched)).select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
            match = F.lit(True)
            for i, k in enumerate(keys):
                match = match & F.col(k).eqNullSafe(F.col(f"__{i}"))
            rows = rows.join(seen, match, "left_anti")
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch_id={number}")

    return write


class Sightings(StatefulProcessor):
    """An id is missing from `grace` after its last sighting on, and revived by the next one.

    Sightings wait until the watermark has passed them, so that rows out of order are taken in order; of those that wait only ones that can end a gap are kept,
    at most two for each grace that the watermark is behind. A timer stands at the next moment at which something can happen."""

    def __init__(self, grace_ms: int):
        self.grace = grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sightings", "last long, missing boolean, waiting array<long>")

    def _needed(self, waiting: list[int]) -> list[int]:
        out: list[int] = []
        for at in sorted(waiting):
            if len(out) > 1 and at - out[-2] <= self.grace:
                out.pop()
            out.append(at)
        return out

    def _advance(self, key: tuple, new: list[int], now: int) -> Iterator[pd.DataFrame]:
        last, missing, waiting = self.state.get() if self.state.exists() else (None, False, [])
        waiting, out = self._needed([*waiting, *new]), []
        while waiting and waiting[0] <= now:
            at = waiting.pop(0)
            if last is not None and at - last > self.grace:
                out += [] if missing else [(key[0], "missing", last + self.grace)]
                out.append((key[0], "revived", at))
                missing = False
            last = at if last is None else max(at, last)
        if last is not None and not missing and last + self.grace <= now:
            out.append((key[0], "missing", last + self.grace))
            missing = True
        self.state.update((last, missing, waiting))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        moments = waiting[:1] + ([last + self.grace] if last is not None and not missing else [])
        if moments:
            self.handle.registerTimer(min(moments))
        if out:
            yield pd.DataFrame(out, columns=["id", "reason", "at_ms"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: list[int] = []
        for part in rows:
            new = self._needed([*new, *part["at"].tolist()])
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def missing_timeline(sightings: DataFrame, late: str = "1 day", grace_s: int = GRACE_S) -> DataFrame:
    """(id, reason missing or revived, at_ms) of a stream of sightings (id, seen_at), which may come up to `late` out of order; later ones are ignored.

    Times count to the nearest millisecond (halves go away from zero), the watermark's too; a sighting without a time says nothing.
    Needs the state store that timers need: start its query inside timers()."""
    ship(sightings.sparkSession)
    at = F.expr("round(unix_micros(seen_at), -3) div 1000")  # unix_millis would cut
    timed = sightings.filter("seen_at is not null").select(F.col("id").cast("string").alias("id"), at.alias("at"))
    seen = timed.select("id", F.timestamp_millis("at").alias("seen_at"), "at").withWatermark("seen_at", late)
    return seen.groupBy("id").transformWithStateInPandas(Sightings(grace_s * 1000), "id string, reason string, at_ms long", "append", "EventTime")


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def since(events: DataFrame, cursor: int) -> DataFrame:
    """The rows of an event stream after a cursor."""
    return events.filter(F.col("event_id") > cursor)
