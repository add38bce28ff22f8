"""Streams that stop and start again, repeat themselves, and come out of order."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rentlens import fixtures, schema
from rentlens.operators import history
from rentlens.sources import feed, keyed
from rentlens.streaming import feeds
from tests.oracle import SMALL


def run(stream, folder, sink):
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def put(df, folder, n):
    """One more input file, newer than those before."""
    df.coalesce(1).write.parquet(f"{folder}/tmp/{n}")
    os.makedirs(f"{folder}/in", exist_ok=True)
    part = next(f for f in os.listdir(f"{folder}/tmp/{n}") if f.endswith(".parquet"))
    os.rename(f"{folder}/tmp/{n}/{part}", f"{folder}/in/{n}.parquet")
    os.utime(f"{folder}/in/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))


def source(spark, folder, kind):
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_keys_of_earlier_batches_add_nothing(spark, tmp_path):
    folder, kind = str(tmp_path), "id string, at int, v int"
    make = lambda *r: spark.createDataFrame(list(r), kind)
    sink = feeds.append_new(f"{folder}/out", ["id", "at"], buckets=4)
    put(make(("a", 1, 1), ("a", 1, 1), (None, 1, 1), ("b", None, 1)), folder, 0)
    run(source(spark, folder, kind), folder, sink)
    put(make(("a", 1, 2), ("a", 2, 2), (None, 1, 2), ("b", None, 2), ("c", 1, 2)), folder, 1)
    put(make(("c", 1, 3)), folder, 2)
    put(make(("d", 1, 4), ("a", 2, 4)), folder, 3)
    run(source(spark, folder, kind), folder, sink)
    want = sorted([("a", 1, 1), (None, 1, 1), ("b", None, 1), ("a", 2, 2), ("c", 1, 2), ("d", 1, 4)], key=str)
    read = lambda: sorted((tuple(r[c] for c in ("id", "at", "v")) for r in spark.read.schema(f"{kind}, batch_id long, bucket int").parquet(f"{folder}/out").collect()), key=str)
    assert read() == want
    # a batch that is tried again finds what it found at first
    sink(make(("a", 1, 2), ("a", 2, 2), (None, 1, 2), ("b", None, 2), ("c", 1, 2)), 1)
    sink(make(("c", 1, 3)), 2)
    assert read() == want


@pytest.mark.parametrize("most", [3, 10**6])
def test_stored_changes(spark, tmp_path, most):
    """Files in order, a restart, a replay: the points are those of the whole table at once, also with hot ids in segments."""
    folder, obs = str(tmp_path), fixtures.observations(spark, SMALL).withColumn("id", F.concat(F.lit("u"), F.col("id") % 7))
    ordered = obs.orderBy("observed_at", "seq").toPandas()
    sink, parts = feeds.stored_changes(f"{folder}/store", buckets=4, most=most), 4
    cut = [spark.createDataFrame(ordered.iloc[i * len(ordered) // parts : (i + 1) * len(ordered) // parts], obs.schema) for i in range(parts)]
    for i in range(2):
        put(cut[i], folder, i)
    run(source(spark, folder, obs.schema), folder, sink)
    for i in range(2, parts):
        put(cut[i], folder, i)
    run(source(spark, folder, obs.schema), folder, sink)
    sink(cut[3], 3)  # a replay
    cols = ["id", "seq", "kind", "price", "old_price"]
    got = sorted(tuple(r[c] for c in cols) for r in feeds.read_changes(spark, f"{folder}/store").collect())
    assert got == sorted(tuple(r[c] for c in cols) for r in history.compress(obs, order=("observed_at", "seq")).collect())
    assert keyed.manifest(spark, f"{folder}/store")["note"] == 3


def test_timers_against_batch(spark, tmp_path):
    """Sightings up to an hour out of order, in six files and two runs: missing and revived as in the whole table; rows that are too late change nothing."""
    rng, folder, hour = random.Random(1), str(tmp_path), 3600
    rows = sorted((t + rng.uniform(-0.5, 0.5) * hour, f"u{i}", int(t * 1000) + rng.randint(0, 999)) for i in range(12) for t in sorted(rng.choices(range(0, 40 * hour, 60), k=rng.randint(1, 30))))
    parts = [rows[i * len(rows) // 6 : (i + 1) * len(rows) // 6] for i in range(6)]
    kind = "id string, seen_at timestamp"
    make = lambda part: spark.createDataFrame([(i, t) for _, i, t in part], "id string, ms long").select("id", F.timestamp_millis("ms").alias("seen_at"))
    late = [(0, "u1", 30 * hour * 1000), (0, "late", 5)]
    for n in range(4):
        put(make(parts[n]), folder, n)
    sink = feeds.append_once(f"{folder}/out", ["id", "reason", "at_ms"])
    for step in range(2):
        with feeds.timers(spark):
            run(feeds.missing_timeline(source(spark, folder, kind), "2 hours", 3 * hour), folder, sink)
        if not step:
            put(make(parts[4]), folder, 4)
            put(make([*parts[5], (0, "late", 5)]), folder, 5)
    seen = [(i, t) for _, i, t in rows]
    now, want = max(t for _, t in seen) - 2 * hour * 1000, []
    for i in {i for i, _ in seen}:
        mine = sorted(t for j, t in seen if j == i and t <= now)
        for a, b in zip(mine, [*mine[1:], None]):
            if b is None:
                want += [(i, "missing", a + 3 * hour * 1000)] if a + 3 * hour * 1000 <= now else []
            elif b - a > 3 * hour * 1000:
                want += [(i, "missing", a + 3 * hour * 1000), (i, "revived", b)]
    got = sorted((r["id"], r["reason"], r["at_ms"]) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == sorted(want) and len(want) > 20 and late


def test_only_what_can_matter_waits():
    s, rng = feeds.Sightings(100), random.Random(4)
    for _ in range(200):
        points = [rng.randint(0, 3000) for _ in range(rng.randint(0, 80))]
        kept = s._needed(s._needed(points[:40]) + points[40:])
        gaps = lambda xs: [(a, b) for a, b in zip(sorted(xs), sorted(xs)[1:]) if b - a > 100]
        assert gaps(kept) == gaps(points) and len(kept) <= 2 * (3000 // 100) + 4


def events(spark, *ids):
    return spark.createDataFrame([(i, "new", 1.0, None, "t") for i in ids], "id string, reason string, price double, old_price double, observed_at string")


def test_change_feed(spark, tmp_path):
    folder = str(tmp_path)
    assert feed.read(spark, folder).collect() == []
    assert feed.append(events(spark, *[f"{i:04d}" for i in range(500)]), folder, ["id"]) == 500
    assert feed.append(events(spark), folder, ["id"]) == 500
    assert feed.append(events(spark, *[f"{i:04d}" for i in range(500, 560)]), folder, [F.col("id").desc()]) == 560
    rows = feed.read(spark, folder, 490).orderBy("event_id").collect()
    assert [(r["event_id"], r["id"]) for r in rows] == [(i + 1, f"{i:04d}") for i in range(490, 500)] + [(501 + k, f"{559 - k:04d}") for k in range(60)]
    assert feed.read(spark, folder).schema == schema.EVENTS and feed.read(spark, folder, 560).count() == 0
    assert [r["event_id"] for r in history.changes_page(feed.read(spark, folder, 100), 100, 3).collect()] == [101, 102, 103]
    # files before the cursor aren't opened
    files = feed.index(spark, folder)["files"]
    opened = {p.path for p in feed.BatchReader({"path": folder, "since": 490}).partitions()}
    assert len(files) > 4 and opened == {f["path"] for f in files if f["last"] > 490} != {f["path"] for f in files}
    assert {p.path for p in feed.StreamReader({"path": folder}).partitions({"event_id": 3}, {"event_id": 9})} == {f["path"] for f in files if f["first"] <= 9 and f["last"] > 3}


def test_change_feed_as_a_stream(spark, tmp_path):
    folder = str(tmp_path)
    sink = feeds.append_once(f"{folder}/out", ["event_id"])
    got = lambda: sorted((r["event_id"], r["id"]) for r in spark.read.parquet(f"{folder}/out").collect())
    for n, ids in enumerate((["a", "b", "c"], ["d"], ["e", "f"])):
        feed.append(events(spark, *ids), f"{folder}/log", ["id"])
        run(feed.read_stream(spark, f"{folder}/log", 1), folder, sink)
    assert got() == [(2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]
