"""Price history, change events and the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import segments
from .segments import MOST_ROWS, running

NEW, DROP = "new", "price_drop"


def compress(observations: DataFrame, key: str = "id", order: tuple[str, ...] = ("observed_at",), most: int = MOST_ROWS) -> DataFrame:
    """The first observation of each key and those that change its price, with old_price and kind (start, drop, rise); keys of over `most` rows in segments."""
    out = running(observations.filter("price is not null"), key, list(order), F.col("price"), "previous", "old_price", most)
    kind = F.when(F.col("old_price").isNull(), "start").when(F.col("price") < F.col("old_price"), "drop").otherwise("rise")
    return out.filter(F.col("old_price").isNull() | S.price_changed(F.col("old_price"), F.col("price"))).withColumn("kind", kind)


def price_changes(state: DataFrame, history: DataFrame, prices: DataFrame, now: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(history rows, drop events) of a batch of prices (id, price), before the state takes it.

    An unknown id starts at now. A known one without history starts with its stored price at its last sighting; then, as for
    all others, a price that differs from the stored one is added. strict: an id that isn't stored yet adds nothing if its last recorded price is the same.
    """
    new = prices.select("id", S.to_long(F.col("price")).cast("double").alias("new")).filter("new is not null")
    old = state.select("id", F.col("price").cast("double").alias("old"), "last_seen_at")
    last = history.groupBy("id").agg(F.max_by("price", "observed_at").alias("last"))
    j = new.join(old, "id", "left").join(last, "id", "left")
    changed = S.price_changed(F.col("old"), F.col("new"))
    start = F.col("old").isNull() & (F.lit(not strict) | F.col("last").isNull() | S.price_changed(F.col("last"), F.col("new")))
    at_now = F.struct(F.col("new").alias("price"), F.lit(now).alias("observed_at"))
    at_old = F.struct(F.col("old").alias("price"), F.coalesce("last_seen_at", F.lit(now)).alias("observed_at"))
    points = F.array_compact(F.array(F.when(F.col("old").isNotNull() & F.col("last").isNull(), at_old), F.when(start | changed, at_now)))
    rows = j.select("id", F.explode(points).alias("p")).select("id", "p.price", "p.observed_at").dropDuplicates(["id", "observed_at"])
    rows = rows.join(history.select("id", "observed_at"), ["id", "observed_at"], "left_anti").select("id", "price", "observed_at")
    drops = j.filter(changed & (F.col("new") < F.col("old"))).select("id", F.lit(DROP).alias("reason"), F.col("new").alias("price"), F.col("old").alias("old_price"), F.lit(now).alias("observed_at"))
    return rows, drops


def new_events(state: DataFrame, details: DataFrame, now: str, days: int = 1) -> DataFrame:
    """Events for complete, recently published ids that aren't stored yet."""
    fresh = details.filter(S.is_complete() & S.is_recent(F.col("created_at"), F.lit(now), days)).join(state.select("id"), "id", "left_anti")
    return fresh.select("id", F.lit(NEW).alias("reason"), S.coerce("price", F.col("price")).cast("double").alias("price"), F.lit(None).cast("double").alias("old_price"), F.lit(now).alias("observed_at"))


def numbered(events: DataFrame, last_id: int) -> DataFrame:
    """Events of one commit with gapless event_id after last_id: price drops first, then new ones, each by id. Numbers are given range by range, in parallel."""
    return segments.numbered(events, [F.when(F.col("reason") == DROP, 0).otherwise(1), "id"], "event_id", last_id + 1)


def changes_page(events: DataFrame, since: int = 0, limit: int = 200) -> DataFrame:
    """Events after a cursor in order, at most `limit` (1 to 500)."""
    if not 1 <= limit <= 500 or since < 0:
        raise ValueError("limit must be 1 to 500 and since not negative")
    return events.filter(F.col("event_id") > since).orderBy("event_id").limit(limit)


def price_history_for(history: DataFrame, listing: str) -> DataFrame:
    return history.filter(F.col("id") == listing).orderBy("observed_at").select("price", "observed_at")


def price_asof(probes: DataFrame, history: DataFrame, key: str = "id", at: str = "at", observed: str = "observed_at", most: int = MOST_ROWS) -> DataFrame:
    """probes with the price of the last history row of their key at or before their time.

    One pass: both sides sorted together by key and time, the last price carried forward; keys of over `most` rows in segments."""
    left = probes.withColumn("__t", F.col(at)).withColumn("__probe", F.lit(1))
    right = history.select(F.col(key), F.col(observed).alias("__t"), F.col("price").alias("__price"), F.lit(0).alias("__probe"))
    both = running(left.unionByName(right, allowMissingColumns=True), key, ["__t", "__probe"], F.col("__price"), "last", "price", most)
    return both.filter("__probe = 1").drop("__t", "__probe", "__price")
