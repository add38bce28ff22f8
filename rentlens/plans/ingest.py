"""One run's effect on the registry: old tables and a run's frames to new tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import scalars as S
from ..operators import history, registry
from ..session import cut
from ..sources import keyed
from ..sources.state import TABLES

#: Tables that only grow.
APPENDED = ("history", "events")


def run_changes(old: dict[str, DataFrame], details: DataFrame, snapshot: DataFrame, now: str, *, complete: bool, attempts: DataFrame | None = None, grace_s: int = registry.GRACE_S, strict: bool = True) -> dict[str, DataFrame]:
    """What a run makes of the old tables: all listings and failures after it, the history points and events that it adds.

    details: fetched records; of those that repeat an id the last by scraped_at wins. snapshot: (id, price) of the list, price may be null. attempts: failed fetches (id, error, at).
    Prices are compared with the old state before it changes; drops are numbered before new listings. Listed ids without a
    new record get their price or at least the sighting; unlisted ones may become missing if the scan was complete.
    """
    state = old["listings"]
    details, snapshot = registry.folded(registry.coerced(details)), registry.last_prices(snapshot)
    rest = snapshot.join(details.select("id"), "id", "left_anti")
    prices = details.select("id", S.to_long(F.col("price")).alias("price")).unionByName(rest.select("id", S.to_long(F.col("price")).alias("price")))
    points, drops = history.price_changes(state, old["history"], prices, now, strict)
    last = old["events"].agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("n")).first()["n"]
    events = history.numbered(drops.unionByName(history.new_events(state, details, now)), last)
    listings = registry.upsert_full(state, details, now)
    listings = registry.update_prices(listings, rest, now)
    listings = registry.touch_seen(listings, rest.filter("price is null"), now)
    listings = registry.mark_missing(listings, snapshot.unionByName(details.select("id"), allowMissingColumns=True), now, complete=complete, grace_s=grace_s).drop("newly_missing")
    failures = old["failures"] if attempts is None else registry.count_failures(attempts, old["failures"])
    return {
        "listings": listings,
        "points": points,
        "events": events.select(*[f.name for f in schema.EVENTS]),
        "failures": registry.clear_failures(failures, details.filter(S.is_complete())),
    }


def apply_run(old: dict[str, DataFrame], details: DataFrame, snapshot: DataFrame, now: str, **how) -> dict[str, DataFrame]:
    """New listings, history, events and failures; see run_changes for what goes in."""
    new = run_changes(old, details, snapshot, now, **how)
    return {"listings": new["listings"], "history": old["history"].unionByName(new["points"]), "events": old["events"].unionByName(new["events"]), "failures": new["failures"]}


def load_buckets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a bucketed store."""
    return {name: keyed.read(spark, folder, name, kind, key=None if name in APPENDED else "id") for name, kind in TABLES.items()}


def commit_run(spark: SparkSession, folder: str, details: DataFrame, snapshot: DataFrame, now: str, *, buckets: int = keyed.BUCKETS, most_deltas: int = 8, **how) -> int:
    """A run against a bucketed store: only changed listings and ledger rows, new history points and new events are written. Returns the generation.

    Buckets of listings and ledger with more than most_deltas deltas are rewritten after it."""
    old = load_buckets(spark, folder)
    new = run_changes(old, details, snapshot, now, **how)
    listings, failures = cut(keyed.changed(new["listings"], old["listings"])), cut(new["failures"])
    cleared = old["failures"].join(failures.select("id"), "id", "left_anti")
    changes = {"listings": listings, "history": new["points"], "events": new["events"], "failures": keyed.changed(failures, old["failures"])}
    number = keyed.commit(spark, folder, changes, {"failures": cleared}, APPENDED, buckets=buckets)
    for name in ("listings", "failures"):
        keyed.compact(spark, folder, name, TABLES[name], most_deltas)
    return number
