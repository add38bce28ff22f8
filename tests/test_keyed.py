"""Bucketed stores, numbering and digests."""

import os

import pytest
from pyspark.sql import functions as F

from rentlens import fixtures, schema
from rentlens.operators import digest, registry, segments
from rentlens.plans import ingest, publish, serve
from rentlens.session import cut
from rentlens.sources import keyed, sinks
from tests.oracle import SMALL
from tests.plans import plan, small_parts

KIND = "id string, v long"


def files(folder):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


@pytest.fixture()
def kind(spark):
    return spark.createDataFrame([], KIND).schema


def rows(spark, folder, kind, **how):
    return sorted(map(tuple, keyed.read(spark, folder, "t", kind, **how).collect()))


def test_small_batch_writes_little(spark, tmp_path, kind):
    folder = str(tmp_path)
    base = spark.range(20_000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 7).alias("v"))
    keyed.commit(spark, folder, {"t": base}, buckets=16)
    before = files(folder)
    keyed.commit(spark, folder, {"t": base.filter("v % 100 = 0").withColumn("v", F.lit(-1).cast("long"))}, buckets=16)
    new = {f: n for f, n in files(folder).items() if f not in before}
    assert before.items() <= files(folder).items() and sum(new.values()) < 0.1 * sum(before.values())
    assert rows(spark, folder, kind) == sorted((str(i), -1 if i * 7 % 100 == 0 else i * 7) for i in range(20_000))
    # few keys touch few buckets, and only these are compacted
    some = [str(i) for i in (1, 2, 3)]
    touched = {r[0] for r in spark.createDataFrame([(i,) for i in some], "id string").select(keyed.bucket_of("id", 16)).collect()}
    for _ in range(3):
        keyed.commit(spark, folder, {"t": spark.createDataFrame([(i, 5) for i in some], KIND)}, buckets=16)
    before = files(folder)
    assert keyed.compact(spark, folder, "t", kind, most_deltas=1) == sorted(touched)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files(folder) if f not in before} == touched
    want = sorted((str(i), 5 if str(i) in some else -1 if i * 7 % 100 == 0 else i * 7) for i in range(20_000))
    assert rows(spark, folder, kind) == want and keyed.compact(spark, folder, "t", kind, most_deltas=1) == []
    keyed.vacuum(spark, folder, keep=1)
    assert rows(spark, folder, kind) == want and len(files(folder)) < len(before)
    one = keyed.point(spark, folder, "t", kind, "2")
    assert [tuple(r) for r in one.collect()] == [("2", 5)] and len({f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1


def test_deletes_and_returns(spark, tmp_path, kind):
    folder, make = str(tmp_path), lambda *r: spark.createDataFrame(list(r), KIND)
    assert rows(spark, folder, kind) == []
    keyed.commit(spark, folder, {"t": make(("a", 1), ("b", 2), ("c", None))}, buckets=4)
    keyed.commit(spark, folder, {"t": make(("d", 4))}, {"t": make(("a", 0), ("x", 0))}, buckets=4)
    assert rows(spark, folder, kind) == [("b", 2), ("c", None), ("d", 4)]
    keyed.commit(spark, folder, {"t": make(("a", 9))}, buckets=4)
    assert rows(spark, folder, kind) == [("a", 9), ("b", 2), ("c", None), ("d", 4)]
    keyed.compact(spark, folder, "t", kind, most_deltas=0)
    assert rows(spark, folder, kind) == [("a", 9), ("b", 2), ("c", None), ("d", 4)]
    keyed.commit(spark, folder, {}, {"t": make(("a", 0), ("b", 0), ("c", 0), ("d", 0))}, buckets=4)
    keyed.compact(spark, folder, "t", kind, most_deltas=0)
    assert rows(spark, folder, kind) == []
    with pytest.raises(ValueError):
        keyed.commit(spark, folder, {"t": make(("a", 1))}, buckets=8)


def test_crash_leaves_the_old_generation(spark, tmp_path, kind, monkeypatch):
    folder = str(tmp_path)
    keyed.commit(spark, folder, {"t": spark.createDataFrame([("a", 1)], KIND)}, buckets=4)
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_text", lambda *_: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            keyed.commit(spark, folder, {"t": spark.createDataFrame([("a", 2)], KIND)}, buckets=4)
    assert rows(spark, folder, kind) == [("a", 1)]
    keyed.commit(spark, folder, {"t": spark.createDataFrame([("b", 3)], KIND)}, buckets=4)
    assert rows(spark, folder, kind) == [("a", 1), ("b", 3)]
    assert len(keyed.vacuum(spark, folder)) == 1 and rows(spark, folder, kind) == [("a", 1), ("b", 3)]


def test_runs_over_buckets(spark, tmp_path):
    """Runs committed to a bucketed store give the tables that whole rewrites give, and write only what changed."""
    folder = str(tmp_path)
    detail = lambda *rows: spark.createDataFrame(list(rows), "id string, price string, rooms string, square_m2 string, created_at string, street string")
    listed = lambda *rows: spark.createDataFrame(list(rows), "id string, price string")
    attempts = spark.createDataFrame([("9", "timeout", "t"), ("1", "x", "t")], "id string, error string, at string")
    t = [f"2024-03-0{d}T00:00:00+00:00" for d in (1, 2, 3)]
    runs = [
        (detail(("1", "100", "2", "50", "2024-03-01", "S"), ("2", "200", "2", "50", "2023-01-01", None)), listed(("1", "100"), ("2", "200")), t[0], {"attempts": attempts}),
        (detail(("1", "90", "2", "50", "2024-03-01", None)), listed(("1", "90")), t[1], {}),
        (detail(), listed(("2", None)), t[2], {}),
    ]
    whole = {n: spark.createDataFrame([], k) for n, k in ingest.TABLES.items()}
    for d, s, now, how in runs:
        whole = {n: cut(df) for n, df in ingest.apply_run(whole, d, s, now, complete=True, **how).items()}
        ingest.commit_run(spark, folder, d, s, now, buckets=2, most_deltas=1, complete=True, **how)
    got = ingest.load_buckets(spark, folder)
    for name in whole:
        assert sorted(map(str, got[name].collect())) == sorted(map(str, whole[name].select(got[name].columns).collect())), name
    assert keyed.manifest(spark, folder)["generation"] > len(runs)  # buckets were rewritten on the way


def test_numbers_without_gaps(spark):
    df = spark.range(5000).select((F.hash("id") % 100_000).alias("k"), "id").repartition(5)
    out = segments.numbered(df, [F.col("k").desc(), "id"], "n", 10, parts=7)
    assert "SinglePartition" not in plan(out)
    got = sorted(out.collect(), key=lambda r: r["n"])
    assert [r["n"] for r in got] == list(range(10, 5010)) and [(-r["k"], r["id"]) for r in got] == sorted((-r["k"], r["id"]) for r in got)
    assert segments.numbered(df.limit(0), ["k"], "n").count() == 0


def test_pages_read_a_range(spark, tmp_path):
    df = spark.range(20_000).select("id", F.concat(F.lit("x"), "id").alias("text"))
    segments.numbered(df, ["id"], "ordinal", parts=8).write.parquet(f"{tmp_path}/t")
    out = serve.page(spark.read.parquet(f"{tmp_path}/t"), 50, 7_010)
    assert [r["id"] for r in out.collect()] == list(range(7_010, 7_060))
    assert "GreaterThanOrEqual(ordinal,7010)" in plan(out) and "rangepartitioning" not in plan(out)
    held = [(r["lo"], r["hi"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/t").groupBy(F.input_file_name()).agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"), F.count("*").alias("n")).collect()]
    assert len(held) > 4 and all(hi - lo + 1 == n for lo, hi, n in held)


def test_digest_trees(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    old = digest.tree(df, "id")
    assert sorted(map(tuple, digest.tree(df.repartition(3).orderBy(F.desc("v")), "id").collect())) == sorted(map(tuple, old.collect()))
    assert digest.changed(old, old).count() == 0 and digest.root(old) != digest.root(digest.tree(df.unionByName(df.limit(1)), "id"))
    new = digest.tree(df.filter("id <> '7'").withColumn("v", F.when(F.col("id") == "9", -1).otherwise(F.col("v"))).unionByName(spark.createDataFrame([("new", 1)], KIND)), "id")
    import hashlib

    ranges = {hashlib.sha256(k.encode()).hexdigest()[:3] for k in ("7", "9", "new")}
    assert {r["prefix"] for r in digest.changed(old, new).collect()} == ranges
    none = digest.tree(df.limit(0), "id")
    assert none.count() == 1 and digest.changed(none, none).count() == 0
    assert digest.changed(none, old).agg(F.sum("n_new")).first()[0] == 3000
    # fields can't run into each other
    a, b = (spark.createDataFrame([x], "id string, v string") for x in (("1", "2-"), ("12", "-")))
    assert digest.tree(a, "v").first()["digest"] != digest.tree(b, "v").first()["digest"]


def test_versions_tell_what_changed(spark, tmp_path):
    listings = fixtures.listings(spark, SMALL, faults=True)
    first = publish.build(listings, fixtures.series(spark), str(tmp_path), "t1")
    kept = {r["id"] for r in spark.read.parquet(f"{first['path']}/baseline").collect()}
    one = sorted(kept)[3]
    second = publish.build(listings.withColumn("url", F.when(F.col("id") == one, "other").otherwise(F.col("url"))), fixtures.series(spark), str(tmp_path), "t2")
    out = publish.changed_ranges(spark, first["path"], second["path"]).collect()
    assert len(out) == 1 and out[0]["n_old"] == out[0]["n_new"] >= 1
    assert sorted(r["ordinal"] for r in spark.read.parquet(f"{second['path']}/baseline").collect()) == list(range(second["row_count"]))


def test_build_reads_its_source_once(spark, tmp_path):
    fixtures.listings(spark, SMALL, faults=True).write.parquet(f"{tmp_path}/source")
    done = lambda: [x for x in (e.apply(i) for e in [spark._jsparkSession.sharedState().statusStore().executionsList()] for i in range(e.size()))]
    before = max(e.executionId() for e in done())
    publish.build(spark.read.parquet(f"{tmp_path}/source"), fixtures.series(spark), f"{tmp_path}/out", "t")
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [e.physicalPlanDescription() for e in done() if e.executionId() > before]
    assert sum(f"{tmp_path}/source" in p.split("== Initial Plan ==")[0] for p in plans) == 1
