"""Keyed state of listings as functions from old state and batch to new state.

Plain Parquet has no row updates, so an upsert is one outer join on the key; callers write the result as a new
generation. `now` is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import scalars as S
from ..session import cut
from .segments import MOST_ROWS, Dealt, running

#: Attempts before an id is given up, bad cards in a row that mean a changed layout, seconds before an unseen id is missing.
MAX_ATTEMPTS = 4
BREAKER_FAILURES, BREAKER_TRIPS = 8, 3
#: The codes of a run's result.
EXIT = {"ok": 0, "blocked": 2, "layout_changed": 3, "no_pages": 4}
MAX_BAD_STREAK = 3
GRACE_S = 6 * 3600


def coerced(rows: DataFrame) -> DataFrame:
    """All listing columns with their types; absent ones are null, unknown ones go."""
    return rows.select(*[(S.coerce(c, F.col(c)) if c in rows.columns else F.lit(None).cast(schema.kind(c))).alias(c) for c in schema.LISTING_COLUMNS])


def latest_wins(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key by the given order. Tasks keep one row of a key before the shuffle (a window group limit), so hot keys cost nothing there."""
    w = Window.partitionBy(key).orderBy(*[o.desc() for o in order])
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def first_wins(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[o.asc() for o in order])
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
    """New values win where they aren't null; status and last sighting always do; the first sighting stays."""
    old, new = state.alias("o"), batch.alias("n")
    hit = F.col("n.id").isNotNull()

    def column(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c == "first_seen_at":
            return F.coalesce(o, n)
        if c in ("status", "last_seen_at"):
            return F.when(hit, n).otherwise(o)
        return F.coalesce(n, o)

    return old.join(new, F.col("o.id") == F.col("n.id"), "full").select(*[column(c).alias(c) for c in state.columns])


def folded(typed: DataFrame, order: str = "scraped_at") -> DataFrame:
    """One row for each id, as if the rows were taken one by one: each column's last value that isn't null, by `order`, rows of equal
    order by all their values. Null ids go. The shuffle is by id, which the merge that follows needs as well."""
    rest = [c for c in typed.columns if c != "id"]
    at = F.struct(F.coalesce(order, F.lit("")), F.xxhash64(*rest))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in rest]
    return typed.filter("id is not null").groupBy("id").agg(*last).select(typed.columns)


def last_prices(prices: DataFrame, order: str | None = None) -> DataFrame:
    """(id, price) with one row for each id: its last price by `order`, the larger one among equals; null only if it has no other."""
    price = S.to_long(F.col("price"))
    at = F.struct(F.col(order), price) if order else price
    return prices.filter("id is not null").groupBy("id").agg(F.max_by(price, F.when(price.isNotNull(), at)).alias("price"))


def upsert_full(state: DataFrame, details: DataFrame, now: str) -> DataFrame:
    """State after complete records were fetched at `now`; of rows that repeat an id the last by scraped_at wins, column by column. Null ids are ignored."""
    seen = {"first_seen_at": F.lit(now), "last_seen_at": F.lit(now), "status": F.lit("active")}
    return merge(state, folded(coerced(details.withColumns(seen))))


def import_rows(state: DataFrame, rows: DataFrame, now: str) -> DataFrame:
    """State after an import that keeps the rows' own sightings and status."""
    typed = folded(coerced(rows))
    first = F.coalesce("first_seen_at", F.lit(now))
    return merge(state, typed.withColumns({"first_seen_at": first, "last_seen_at": F.coalesce("last_seen_at", first), "status": F.coalesce("status", F.lit("active"))}))


def seed(state: DataFrame, rows: DataFrame, now: str) -> DataFrame:
    """State with the rows of unknown ids added as missing."""
    typed = folded(coerced(rows)).join(state.select("id"), "id", "left_anti")
    at = F.coalesce("scraped_at", F.lit(now))
    return state.unionByName(typed.withColumns({"first_seen_at": at, "last_seen_at": at, "status": F.lit("missing")}).select(state.columns))


def update_prices(state: DataFrame, prices: DataFrame, now: str, order: str | None = None) -> DataFrame:
    """Known ids with a new non-null price become active at `now`; of repeated ids the last price by `order` counts, else the larger one."""
    new = last_prices(prices, order).filter("price is not null").withColumnsRenamed({"id": "__id", "price": "__price"})
    hit = F.col("__id").isNotNull()
    out = state.join(new, state.id == F.col("__id"), "left")
    return out.withColumns({"price": F.coalesce("__price", "price"), "last_seen_at": F.when(hit, now).otherwise(F.col("last_seen_at")), "status": F.when(hit, "active").otherwise(F.col("status"))}).select(state.columns)


def touch_seen(state: DataFrame, seen: DataFrame, now: str) -> DataFrame:
    """Known ids that were seen become active at `now`, otherwise unchanged."""
    hit = F.col("__id").isNotNull()
    out = state.join(seen.select(F.col("id").alias("__id")).distinct(), state.id == F.col("__id"), "left")
    return out.withColumns({"last_seen_at": F.when(hit, now).otherwise(F.col("last_seen_at")), "status": F.when(hit, "active").otherwise(F.col("status"))}).select(state.columns)


def mark_missing(state: DataFrame, seen: DataFrame, now: str, *, complete: bool, grace_s: int = GRACE_S) -> DataFrame:
    """State with `newly_missing`: unseen ids whose last sighting is older than the grace become missing.

    An incomplete scan or an empty one marks nothing.
    """
    if not complete:
        return state.withColumn("newly_missing", F.lit(False))
    some = seen.agg((F.count("*") > 0).alias("__some"))
    ids = seen.select(F.col("id").alias("__id")).filter("__id is not null").distinct()
    old = F.col("last_seen_at").isNull() | (F.col("last_seen_at") < S.before(now, grace_s))
    gone = F.col("__some") & F.col("__id").isNull() & ~F.col("status").eqNullSafe("missing") & old
    out = state.join(ids, state.id == F.col("__id"), "left").join(F.broadcast(some))  # some: one row
    return out.withColumn("newly_missing", F.coalesce(gone, F.lit(False))).withColumn("status", F.when(F.col("newly_missing"), "missing").otherwise(F.col("status"))).select(*state.columns, "newly_missing")


# failures and work lists


def count_failures(attempts: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Ledger (id, attempts, last_error, last_attempt_at) after attempts (id, error, at), each a failure."""
    new = attempts.groupBy("id").agg(F.count("*").alias("attempts"), F.max_by(F.substring("error", 1, 500), "at").alias("last_error"), F.max("at").alias("last_attempt_at"))
    if old is None:
        return new
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col("o.id") == F.col("n.id"), "full")
    return both.select(
        F.coalesce("n.id", "o.id").alias("id"), (F.coalesce("o.attempts", F.lit(0)) + F.coalesce("n.attempts", F.lit(0))).alias("attempts"),
        F.coalesce("n.last_error", "o.last_error").alias("last_error"), F.coalesce("n.last_attempt_at", "o.last_attempt_at").alias("last_attempt_at"),
    )


def clear_failures(failures: DataFrame, completed: DataFrame) -> DataFrame:
    return failures.join(completed.select("id"), "id", "left_anti")


def gave_up(failures: DataFrame, most: int = MAX_ATTEMPTS) -> DataFrame:
    return failures.filter(F.col("attempts") >= most).select("id")


def refetch_queue(state: DataFrame, failures: DataFrame, candidates: DataFrame | None = None, most: int = MAX_ATTEMPTS) -> DataFrame:
    """Incomplete ids with attempts left, among candidates if given."""
    open_rows = state.filter(~S.is_complete()).select("id").join(failures.select("id", "attempts"), "id", "left")
    out = open_rows.filter(F.coalesce("attempts", F.lit(0)) < most).select("id")
    return out if candidates is None else out.join(candidates.select("id"), "id", "left_semi")


def split_work(snapshot: DataFrame, state: DataFrame, failures: DataFrame) -> DataFrame:
    """(id, work): new, refetch or price_only for each id of a list snapshot."""
    known = state.select("id", F.lit(True).alias("known"))
    again = refetch_queue(state, failures).withColumn("again", F.lit(True))
    out = snapshot.select("id").join(known, "id", "left").join(again, "id", "left")
    return out.select("id", F.when(F.col("known").isNull(), "new").when(F.col("again"), "refetch").otherwise("price_only").alias("work"))


def stats(state: DataFrame) -> DataFrame:
    """One row of counts; the sums are null for an empty state."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return state.agg(F.count("*").alias("total"), one(F.col("status") == "active").alias("active"), one(F.col("status") == "missing").alias("missing"), one(S.is_complete()).alias("complete"))


# list snapshots


def merge_pages(rows: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot (the last page of an id wins) and its one-row meta from parsed rows and page outcomes (page_number, total_pages, ok, ended).

    total_pages is what a page itself says. A list ends at the count of its first page, or before it at an empty page that says there are fewer pages
    than its own number (ended, a column that may be absent). A scan is complete if every page before the end was read."""
    snapshot = latest_wins(rows, "id", F.col("page_number"))
    end = F.col("ended") if "ended" in pages.columns else F.lit(False)
    bounds = pages.agg(F.min_by("total_pages", F.when(F.col("total_pages").isNotNull(), F.col("page_number"))).alias("total_pages"), F.min(F.when(end, F.col("page_number"))).alias("__end"))
    inside = pages.drop("total_pages").join(F.broadcast(bounds)).withColumn("__in", F.col("__end").isNull() | (F.col("page_number") < F.col("__end")))
    bad = F.array_sort(F.collect_set(F.when(F.col("__in") & ~F.col("ok"), F.col("page_number"))))
    meta = inside.agg(F.max("total_pages").alias("total_pages"), F.count_distinct(F.when(F.col("ok") & F.col("__in"), F.col("page_number"))).alias("pages_read"), bad.alias("skipped_pages"), F.max("__end").alias("__end"))
    wanted = F.least(F.col("total_pages"), F.col("__end") - 1)
    return snapshot, meta.withColumn("complete", F.coalesce((F.size("skipped_pages") == 0) & (F.col("pages_read") >= wanted), F.lit(False))).drop("__end")


def is_fresh(complete: Column, finished_at: Column, now: str, most_s: int = 3 * 3600) -> Column:
    """A complete snapshot finished at most most_s before now."""
    age = F.lit(now).cast("timestamp").cast("long") - finished_at.try_cast("timestamp").cast("long")
    return F.coalesce(complete & (age <= most_s), F.lit(False))


def window_diff(window: DataFrame, known: DataFrame, complete_ids: DataFrame, *, warmup: bool = False, all_new: bool = False) -> DataFrame:
    """(id, reason, price, old_price): new ids without a complete record, and known ids that became cheaper.

    A warm-up, or a window before which nothing is known, is only remembered: no rows. all_new takes every id of the window for new, before either."""
    none = F.lit(None).cast(window.schema["price"].dataType)
    if all_new:
        return window.select("id", F.lit("new").alias("reason"), "price", none.alias("old_price"))
    some = known.agg((F.count("*") > 0).alias("__some"))  # one row
    old = known.select("id", F.col("price").alias("old_price"), F.lit(True).alias("known"))
    both = window.select("id", "price").join(old, "id", "left").join(complete_ids.select("id", F.lit(True).alias("have")), "id", "left").join(F.broadcast(some))
    reason = F.when(F.col("known").isNull() & F.col("have").isNull(), "new").when(F.col("known") & (F.col("price") < F.col("old_price")), "price_drop")
    out = both.withColumn("reason", F.when(F.col("__some") & F.lit(not warmup), reason)).filter("reason is not null")
    return out.select("id", "reason", "price", F.when(F.col("reason") == "price_drop", F.col("old_price")).alias("old_price"))


def window_state(window: DataFrame, known: DataFrame, failed: DataFrame, *, complete: bool) -> DataFrame:
    """Next (id, price): the window's, but failed ids keep their old state or stay out. An incomplete scan changes nothing."""
    if not complete:
        return known.select("id", "price")
    bad = failed.select("id")
    return window.select("id", "price").join(bad, "id", "left_anti").unionByName(known.select("id", "price").join(bad, "id", "left_semi").join(window.select("id"), "id", "left_semi"))


def enrich_drops(drops: DataFrame, state: DataFrame) -> DataFrame:
    """Events with the stored row where there is one; the event's price wins."""
    rest = [c for c in state.columns if c not in ("id", "price")]
    return drops.join(state.select("id", *rest), "id", "left")


def streaks(outcomes: DataFrame, key: str, order: list[str], good: str = "good", most_rows: int = MOST_ROWS) -> DataFrame:
    """(key, island, length) of each run of bad outcomes; a good one ends it."""
    return _runs(_islands(outcomes, key, order, good, most_rows), key, good)


def _islands(outcomes: DataFrame, key: str, order: list[str], good: str, most_rows: int) -> DataFrame:
    return running(outcomes, key, order, F.col(good).cast("int"), "sum", "island", most_rows)


def _runs(islands: DataFrame, key: str, good: str) -> DataFrame:
    return islands.filter(~F.col(good)).groupBy(key, "island").agg(F.count("*").alias("length"))


def counted_failures(outcomes: DataFrame, key: str, order: list[str], good: str = "good", most: int = MAX_BAD_STREAK, most_rows: int = MOST_ROWS) -> DataFrame:
    """The bad outcomes that count as failures of their ids. A bad card is pending until a good one follows or its run ends; a streak of `most` means that
    the site's layout changed, so none of that streak counts."""
    bad = cut(_islands(outcomes, key, order, good, most_rows).filter(~F.col(good)))
    # runs are counted before the shuffle; long ones, which alone could be many rows in one task, match nothing
    short = _runs(bad, key, good).filter(F.col("length") < most).select(F.col(key).alias("__k"), F.col("island").alias("__i"))
    return bad.join(cut(short), F.col(key).eqNullSafe(F.col("__k")) & F.col("island").eqNullSafe(F.col("__i")), "left_semi").drop("island")


def processed(outcomes: DataFrame, run: str, order: list[str], kind: str = "kind", *, breaker: int = BREAKER_FAILURES, trips: int = BREAKER_TRIPS, streak: int = MAX_BAD_STREAK, most_rows: int = MOST_ROWS) -> DataFrame:
    """The outcomes that a run gets to, with trip (the breaker's number at this row, else null) and ended (blocked, layout_changed, network or null).

    Kinds: ok (a complete card), bad (an answer without one), network (no answer), blocked. `breaker` network failures with no answer between them trip the breaker and are
    counted anew; at its `trips`-th trip the run gives up. `streak` bad cards with no good one between them, failures aside, mean a changed layout. The first
    of these ends the run; later rows weren't fetched. All by running sums, so a run of any length is dealt to many tasks."""
    one = lambda test: F.when(test, 1).otherwise(0)
    dealt = Dealt(outcomes, run, order, most_rows)
    dealt.add("__net", one(F.col(kind) == "network"), "sum").add("__net_before", F.when(F.col(kind) != "network", F.col("__net")), "last")
    dealt.add("__bad", one(F.col(kind) == "bad"), "sum").add("__bad_before", F.when(F.col(kind) == "ok", F.col("__bad")), "last")
    failures = F.col("__net") - F.coalesce("__net_before", F.lit(0))
    dealt.make("__tripped", one((F.col(kind) == "network") & (failures % breaker == 0)))
    out = dealt.add("__trips", F.col("__tripped"), "sum").rows()
    bad = F.col("__bad") - F.coalesce("__bad_before", F.lit(0))
    ended = F.when(F.col(kind) == "blocked", "blocked").when((F.col(kind) == "bad") & (bad >= streak), "layout_changed").when((F.col("__tripped") == 1) & (F.col("__trips") >= trips), "network")
    flagged = out.withColumns({"trip": F.when(F.col("__tripped") == 1, F.col("__trips")), "ended": ended})
    at = F.struct(*order)
    first = cut(flagged.filter("ended is not null").groupBy(F.col(run).alias("__run")).agg(F.min(at).alias("__end")))
    kept = flagged.join(first, F.col(run).eqNullSafe(F.col("__run")), "left").filter(F.col("__end").isNull() | (at <= F.col("__end")))
    return kept.select(*outcomes.columns, "trip", "ended")


def run_results(done: DataFrame, run: str, kind: str = "kind") -> DataFrame:
    """(run, done, failed, trips, ended, code) of processed outcomes: the result of each run, as the code that it exits with. Giving up on the network is no error."""
    count = lambda *kinds: F.count_if(F.col(kind).isin(*kinds))
    sums = done.groupBy(run).agg(count("ok").alias("done"), count("bad", "network").alias("failed"), F.count("trip").alias("trips"), F.max("ended").alias("ended"))
    code = F.when(F.col("ended") == "blocked", EXIT["blocked"]).when(F.col("ended") == "layout_changed", EXIT["layout_changed"]).otherwise(EXIT["ok"])
    return sums.withColumn("code", code)


def list_result(meta: DataFrame) -> DataFrame:
    """meta of merge_pages with the code of a list scan: no_pages if none was read."""
    return meta.withColumn("code", F.when(F.col("pages_read") > 0, EXIT["ok"]).otherwise(EXIT["no_pages"]))


def window_details(outcomes: DataFrame, details: DataFrame, run: str, order: list[str], kind: str = "kind", **how) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(complete rows, bad ids, results) of runs over detail cards: outcomes (run, id, kind and order), details (id and columns). Only what a run got to counts; failed
    connections are in neither, as they say nothing of an id. The window's runs have no breaker: give breaker a large number."""
    done = cut(processed(outcomes, run, order, kind, **how))
    rows = details.join(done.filter(F.col(kind) == "ok").select("id").distinct(), "id", "left_semi").filter(S.is_complete())
    return rows, done.filter(F.col(kind) == "bad").select("id").distinct(), run_results(done, run, kind)


def union_first(*frames: DataFrame, key: str = "id") -> DataFrame:
    """Union that keeps each key's row from the first frame that has it."""
    out = None
    for i, df in enumerate(frames):
        part = df.withColumn("__o", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return first_wins(out, key, F.col("__o")).drop("__o")
